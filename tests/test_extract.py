from pyspark.sql import functions as F

from issuelens.functions import variant_path
from issuelens.operators.extract import collapse_strict, ensure_columns, hoist, hoist_all, numbered_columns


def _v(spark, docs):
    rows = [(i, d) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "i int, j string").select("i", F.parse_json("j").alias("v"))


def test_variant_path():
    assert variant_path(("content", 1, "content", 1, "text")) == "$.content[0].content[0].text"
    assert variant_path(("Request Type", "name")) == "$['Request Type'].name"
    assert variant_path(1) == "$[0]"


def test_hoist_missing_null_scalar(spark):
    df = _v(spark, ['{"name": "Open"}', '{"other": 1}', 'null', '"scalar"', '{"name": null}',
                    '{"requestType": {"name": "Move"}}'])
    out = hoist(df, "v", {"Status": "name", "RT": ("requestType", "name")})
    got = {r.i: (r.Status, r.RT) for r in out.collect()}
    assert got == {0: ("Open", None), 1: (None, None), 2: (None, None), 3: (None, None),
                   4: (None, None), 5: (None, "Move")}
    assert out.columns == ["i", "Status", "RT", "v"]


def test_hoist_same_name_replaces_and_scalar_column_gives_null(spark):
    df = _v(spark, ['{"name": "Open"}'])
    out = hoist(df, "v", {"v": "name"})
    assert out.columns == ["i", "v"] and out.first().v == "Open"
    plain = spark.createDataFrame([(1, "text")], "i int, s string")
    out2 = hoist(plain, "s", {"s": "name", "t": "x"})
    assert out2.first().s is None and out2.first().t is None


def test_hoist_index_paths(spark):
    df = _v(spark, ['[{"value": "A"}, {"value": "B"}]', '[]',
                    '{"content": [{"content": [{"text": "hi"}]}]}'])
    out = hoist(df, "v", {"first": (1, "value"), "txt": ("content", 1, "content", 1, "text")})
    got = {r.i: (r.first, r.txt) for r in out.collect()}
    assert got == {0: ("A", None), 1: (None, None), 2: (None, "hi")}


def test_hoist_all_contract(spark):
    docs = [
        '[{"displayName": "Ann"}, {"displayName": "Bob"}]',   # 0 joined
        '[]',                                                # 1 empty -> NULL
        '[{"displayName": "Ann"}, "x"]',                     # 2 non-record element -> NULL
        '[{"other": 1}, {"other": 2}]',                      # 3 nothing left -> NULL
        '"scalar"',                                          # 4 not a list -> NULL
        '[{"displayName": "Ann"}, {"other": 1}]',            # 5 missing dropped
        '[{"displayName": true}, {"displayName": 12}]',      # 6 as.character
        '[{"displayName": "Ann"}, null]',                    # 7 JSON null element -> NULL
        '{"a": {"displayName": "P"}, "b": {"displayName": "Q"}}',  # 8 named list of records
        '[{"displayName": ""}]',                             # 9 empty string kept
    ]
    out = hoist_all(_v(spark, docs), "v", ["displayName"])
    assert out.columns == ["i", "v", "v_displayName"]
    got = {r.i: r.v_displayName for r in out.collect()}
    assert got == {0: "Ann;Bob", 1: None, 2: None, 3: None, 4: None, 5: "Ann", 6: "TRUE;12", 7: None,
                   8: "P;Q", 9: ""}


def test_hoist_all_nested_path(spark):
    docs = ['[{"answers": [{"text": "a"}, {"text": "b"}]}]', '[]', '{"answers": 1}']
    out = hoist_all(_v(spark, docs), "v", [1, "answers", "text"], sep=" | ", remove=True)
    got = {r.i: r["v_1_answers_text"] for r in out.collect()}
    assert got == {0: "a | b", 1: None, 2: None}
    assert "v" not in out.columns


def test_strict_collapse_and_numbered(spark):
    df = _v(spark, ['[{"n": "a"}, {"n": "b"}]', '[{"n": "a"}, {"m": 1}]'])
    out = df.select("i", collapse_strict(F.col("v"), "n").alias("s"), *numbered_columns(df, "v", "n", "p"))
    assert out.columns == ["i", "s", "p_1_n", "p_2_n"]          # as wide as the longest list
    got = {r.i: (r.s, r.p_1_n, r.p_2_n) for r in out.collect()}
    assert got == {0: ("a;b", "a", "b"), 1: (None, "a", None)}


def test_ensure_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = ensure_columns(df, {"Parent": "string", "a": "string"})
    assert out.columns == ["a", "Parent"] and out.first().Parent is None


def test_a_list_is_read_once_a_value(spark):
    """Before, every use of a list's cells in an expression read them all again."""
    from issuelens.operators.extract import collapse_strict
    lists = ['[{"n":"a"},{"n":"b"}]', '[{"n":true},{"n":null}]', '[{"n":{"x":1}}]', '[]', '[{"m":1}]', '{"k":{"n":"z"}}', '["a"]', '"t"', None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i int, t string").select("i", F.try_parse_json("t").alias("v"))
    out = hoist_all(df, "v", ["n"]).withColumns({"own": collapse_strict(F.col("v"), "n"), "two": collapse_strict(F.col("v"), "n", width=2),
                                                  "none": collapse_strict(F.col("v"), "n", width=0)})
    got = [tuple(r) for r in out.orderBy("i").select("v_n", "own", "two", "none").collect()]
    assert got == [("a;b", "a;b", "a;b", ""), ("TRUE", None, None, ""), (None, '{"x":1}', None, ""), (None, "", None, ""), (None, None, None, ""),
                   ("z", None, None, ""), (None, None, None, ""), (None, None, None, ""), (None, None, None, "")]
    plan = out.select("v_n")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("to_json") + plan.count("structstojson") == 1
