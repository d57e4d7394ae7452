"""Hot-group splitting gives exactly the plain window's answers, NULL order values included."""

import datetime as dt

from pyspark.sql import functions as F

from issuelens.operators.sequence import SkewPolicy, lag_in_order, row_number_in_order

SPLIT = SkewPolicy(rows_per_task=3)


def _events(spark):
    base = dt.datetime(2025, 1, 1)
    rows = [("hot", base + dt.timedelta(hours=h), h) for h in range(40)]
    rows += [("hot", None, 100), ("hot", None, 101), ("hot", base + dt.timedelta(hours=5), 207)]   # NULLs and a tie
    rows += [("cold", base + dt.timedelta(days=1), 1), ("cold", base, 2)]
    return spark.createDataFrame(rows, "k string, t timestamp, pos int")


def test_lag_split_equals_plain_with_nulls_and_ties(spark):
    df = _events(spark)
    args = dict(keys=["k"], order_cols=["t", "pos"], value="pos", default=F.lit(-1), out="prev")
    plain = {(r.k, r.pos): r.prev for r in lag_in_order(df, policy=SkewPolicy(enabled=False), **args).collect()}
    split = {(r.k, r.pos): r.prev for r in lag_in_order(df, policy=SPLIT, **args).collect()}
    assert plain == split
    assert plain[("hot", 100)] == 39 and plain[("hot", 101)] == 100        # NULL times sort last
    assert plain[("cold", 2)] == -1 and plain[("cold", 1)] == 2


def test_row_number_split_equals_plain(spark):
    df = _events(spark)
    plain = {(r.k, r.pos): (r.rn, r.n) for r in
             row_number_in_order(df, ["k"], ["t", "pos"], "rn", "n", policy=SkewPolicy(enabled=False)).collect()}
    split = {(r.k, r.pos): (r.rn, r.n) for r in
             row_number_in_order(df, ["k"], ["t", "pos"], "rn", "n", policy=SPLIT).collect()}
    assert plain == split and plain[("hot", 39)] == (41, 43) and plain[("hot", 101)] == (43, 43)


def test_ranges_are_even_where_most_rows_share_one_time(spark):
    from issuelens.operators.sequence import split_groups, with_ranges
    same = dt.datetime(2025, 1, 1)
    rows = [("hot", same, i) for i in range(496)] + [("hot", same + dt.timedelta(days=i), 500 + i) for i in range(1, 5)]
    rows += [(None, same, i) for i in range(500)] + [("cold", same, 1)]
    df = spark.createDataFrame(rows, "k string, t timestamp, pos int")
    policy = SkewPolicy(rows_per_task=100)
    hot = split_groups(df, ["k"], ["t", "pos"], policy)
    assert {r.k for r in hot.collect()} == {"hot", None}          # a NULL key is a group like any other
    sizes = with_ranges(df, ["k"], ["t", "pos"], hot).groupBy("k", "_range").count().collect()
    assert max(r["count"] for r in sizes) <= 2 * policy.rows_per_task
    assert len([r for r in sizes if r.k is None]) > 2
    args = dict(keys=["k"], order_cols=["t", "pos"], value="pos", default=F.lit(-1), out="prev")
    plain = sorted(map(str, lag_in_order(df, policy=SkewPolicy(enabled=False), **args).collect()))
    assert plain == sorted(map(str, lag_in_order(df, policy=policy, **args).collect()))
    plain = sorted(map(str, row_number_in_order(df, ["k"], ["t", "pos"], "rn", "n", policy=SkewPolicy(enabled=False)).collect()))
    assert plain == sorted(map(str, row_number_in_order(df, ["k"], ["t", "pos"], "rn", "n", policy=policy).collect()))


def test_borders_are_found_by_halving(spark):
    from pyspark.sql import functions as F
    from issuelens.operators.sequence import borders_below
    for borders in ([], [3], [1, 3, 3, 7], list(range(0, 50, 5))):
        df = spark.range(-1, 52).select("id", F.lit(borders).cast("array<long>").alias("b"))
        got = {r.id: r.n for r in df.select("id", borders_below(F.col("b"), F.col("id")).alias("n")).collect()}
        assert got == {i: sum(b <= i for b in borders) for i in range(-1, 52)}


def test_a_row_meets_few_borders_and_ranges_are_written_once(spark):
    """Before, every row was joined with all borders of its group, and a helper's input was worked out again for each use (F16)."""
    from issuelens.operators.sequence import NODE, border_nodes, split_groups, with_ranges
    df = spark.range(6000).selectExpr("if(id % 3 = 0, null, id % 3) AS k", "if(id % 7 = 0, null, id div 40) AS t", "id AS pos").repartition(4)
    hot = split_groups(df, ["k"], ["t", "pos"], SkewPolicy(rows_per_task=10, sample_per_range=8))
    nodes = border_nodes(hot, ["k"])
    assert len(nodes) == 2 and max(n.agg(F.max(F.size("_borders"))).first()[0] for n in nodes) <= NODE
    borders = {r.k: [tuple(b) for b in r._borders] for r in hot.collect()}
    assert len(borders) == 3 and min(len(b) for b in borders.values()) > NODE

    def comparable(key):
        return [(null, 0 if value is None else value) for null, value in zip(key[::2], key[1::2])]

    ranged = with_ranges(df, ["k"], ["t", "pos"], hot)
    assert "Join" not in ranged._jdf.queryExecution().optimizedPlan().toString()
    rows = ranged.collect()
    assert len(rows) == 6000 and all(r._hot for r in rows)
    for r in rows:
        mine = comparable((r.t is None, r.t, r.pos is None, r.pos))
        assert r._range == sum(comparable(b) <= mine for b in borders[r.k])
