"""Preference pairs: prefix, masks, and the defined results."""

from issuelens.llm.preferences import op10_preferences, paired, reply_swaps

ddl = "pair_id long, turn long, role string, text string, prompt string"


def rows(spark, pairs):
    return spark.createDataFrame([(p, t, r, x, "clash") for p, t, r, x in pairs], ddl)


def test_prefix_masks_and_edges(spark):
    chosen = rows(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "and?"), (1, 3, "assistant", "yes"),
                          (2, 0, "user", None), (2, 1, None, "x"), (3, 0, "user", "only here"), (4, 0, "assistant", ""), (None, 0, "user", "x"),
                          (5, 0, "user", "a"), (5, 0, "user", "a")])
    rejected = rows(spark, [(1, 0, "user", "hi"), (1, 1, "assistant", "bad <|im_end|>"), (2, 0, "user", None), (2, 1, None, "x"),
                            (4, 0, "assistant", "long " * 20000), (5, 0, "user", "a")])
    got = {r.pair_id: r for r in paired(chosen, rejected).collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    one = got[1]
    assert one.n_prompt_turns == 1 and one.prompt == "<|im_start|>user\nhi<|im_end|>\n"
    assert [one.chosen[s.start:s.end] for s in one.chosen_mask] == ["good<|im_end|>", "yes<|im_end|>"]
    assert [one.rejected[s.start:s.end] for s in one.rejected_mask] == ["bad < |im_end|><|im_end|>"]
    assert got[2].n_prompt_turns == 2 and got[2].chosen == got[2].rejected == "" and got[2].chosen_mask == []
    assert got[2].prompt == "<|im_start|>user\n<|im_end|>\n<|im_start|>unknown\nx<|im_end|>\n"
    assert got[3].prompt == "" and "only here" in got[3].chosen and got[3].rejected == ""
    assert got[4].n_prompt_turns == 0 and got[4].chosen_mask[0].end - got[4].chosen_mask[0].start == 10
    assert got[5].n_prompt_turns == 1 and got[5].rejected == "" and got[5].chosen.count("a<|im_end|>") == 1


def test_empty_tables(spark):
    none = rows(spark, [])
    assert paired(none, none).count() == 0


def test_reply_swaps(spark):
    conv = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "user", "trailing"),
                                  (2, 0, "user", "p"), (2, 1, "assistant", "a2"), (9, 0, "user", "no reply"),
                                  (None, 0, "assistant", "x")], "conv_id long, turn long, role string, text string")
    chosen, rejected = reply_swaps(conv)
    assert sorted((r.pair_id, r.turn, r.text) for r in chosen.collect()) == [(1, 0, "q"), (1, 1, "a1"), (2, 0, "p"), (2, 1, "a2")]
    assert sorted((r.pair_id, r.turn, r.text) for r in rejected.collect()) == [(1, 0, "q"), (1, 1, "a2"), (2, 0, "p"), (2, 1, "a1")]


def test_partners_over_gaps_ranges_and_text_ids(spark):
    from issuelens.llm.preferences import following
    ids = [3 * i * i for i in range(50)]
    got = {r.i: r.next for r in following(spark.createDataFrame([(i,) for i in ids], "i long").repartition(3), "i").collect()}
    assert got == dict(zip(ids, ids[1:] + ids[:1]))
    one = spark.createDataFrame([("b", 0, "assistant", "only")], "conv_id string, turn long, role string, text string")
    assert reply_swaps(one)[1].count() == 0
    conv = spark.createDataFrame([(c, 0, "assistant", f"says {c}") for c in ("b", "a10", "a9")], one.schema)
    assert sorted((r.pair_id, r.text) for r in reply_swaps(conv)[1].collect()) == [("a10", "says a9"), ("a9", "says b"), ("b", "says a10")]


def test_plan_has_no_python_and_no_cross_join(spark):
    from conftest import SF_SMALL
    plan = op10_preferences(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
