"""Quality rules on small fixtures; the whole query is compared with SQL in test_oracles."""

from pyspark.sql import functions as F

from issuelens.llm import quality

DDL = "doc_id long, text string, source string, kept string"
PROSE = " ".join(f"word{i}" for i in range(40))


def test_shared_lines_deplete_only_documents_that_live_on_them(spark):
    boiler = "Share  this PAGE with all your friends and more " + " ".join(f"b{i}" for i in range(30))
    rows = [(i, f"{boiler}\nfew own words {i}", "h", "") for i in range(30)]
    rows += [(100 + i, f"{boiler.lower()}\n" + " ".join(f"{w}{i}" for w in PROSE.split()), "h", "") for i in range(5)]
    rows += [(200, f"{boiler}\nfew own words", "other", "")]
    docs = spark.createDataFrame(rows, DDL)
    found = {r.doc_id: r for r in quality.judged(docs).collect()}
    assert all(not found[i].kept and not found[i].base_failed for i in range(30))
    assert all(found[100 + i].kept and found[100 + i].n_removed_words == 39 for i in range(5))
    assert found[200].kept and found[200].n_removed_words == 0
    shared = quality.shared_lines(quality.measured(docs).withColumn("host", quality.F.concat(quality.F.lit("="), "host")))
    clean = {r.doc_id: r.text for r in quality.cleaned(docs, shared).collect()}
    assert clean[3] == "few own words 3" and clean[200] == f"{boiler}\nfew own words"


def test_defined_results(spark):
    rows = [(1, None, None, ""), (2, "", "h", ""), (3, " \n\t\n", "h", ""), (None, PROSE, None, ""), (4, PROSE, "h", ""), (4, PROSE, "h", ""),
            (5, "ß é x # $", "h", ""), (6, "again " * 30000, "h", "")]
    found = quality.judged(spark.createDataFrame(rows, DDL)).collect()
    assert len(found) == len(rows)
    by = {r.doc_id: r for r in found}
    for i in (1, 2, 3):
        assert by[i].n_words == 0 and by[i].base_failed and not by[i].kept
    assert by[None].kept and by[4].kept and sum(r.doc_id == 4 for r in found) == 2
    assert (by[5].n_words, by[5].word_chars, by[5].n_symbols) == (4, 6, 2)
    assert by[6].n_repeat_words == 30000 and by[6].base_failed
    assert quality.judged(spark.createDataFrame([], DDL)).count() == 0


def test_the_limit_is_a_number_of_documents_whatever_the_host(spark):
    own = lambda i: " ".join(f"{w}{i}" for w in ("a", "b", "c", "d", "e"))
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(i, f"{shared if i < 21 else own(i) * 8}\n{own(i)}", "big", "") for i in range(3000)]
    rows += [(5000 + i, f"{shared}\n{own(i)}", "small", "") for i in range(20)]
    docs = spark.createDataFrame(rows, DDL)
    found = {r.doc_id: r.n_removed_words for r in quality.judged(docs).collect()}
    assert all(found[i] == 30 for i in range(21)) and not any(found[i] for i in found if i >= 21)


def test_cleaned_keeps_every_column_and_row(spark):
    rows = [(1, "Same line\nown", "h", "x", 7), (1, "same   LINE", "h", None, 8), (None, None, None, "x", 9), (2, "", "h", "x", 1), (3, "same line", None, "x", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, removed string, row_no long")
    key = quality.measured(docs.filter("doc_id = 3")).select(F.explode("line_keys").alias("line"))
    shared = key.select(F.lit("=h").alias("host"), "line", F.lit(3).cast("long").alias("n_left"))
    got = quality.cleaned(docs, shared)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(1, "own", "h", "x", 7), (1, "", "h", None, 8), (None, None, None, "x", 9), (2, "", "h", "x", 1), (3, "same line", None, "x", 2)], key=str)
    assert quality.cleaned(docs.limit(0), shared).count() == 0
