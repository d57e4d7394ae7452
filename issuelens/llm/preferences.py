"""Preference formatting: pairs of conversations as one prompt and two masked completions.

The prompt is the longest common turn prefix (same roles and texts, turn by turn) of the chosen
and the rejected conversation, rendered once; what follows in each is its completion.  A mask
is the list of character spans of a completion that are trained on: the text and end marker of
assistant turns.  DataFrame functions only; all windows share one exchange by pair.

Defined results: turns are ordered by turn, role, text, NULLs first, so ties and repeated turns
have one order; a NULL role renders as ``unknown`` and a NULL text as empty, and NULL equals
NULL in the prefix.  Markers inside texts are taken apart (``<|`` becomes ``< |``).  Equal
conversations, or one that is a prefix of the other, leave an empty completion.  A pair that
has only one of its two sides has an empty prompt.  Rows without a pair_id are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from issuelens.llm.text import read_table, written

START, END = "<|im_start|>", "<|im_end|>"


def rendered(role: Column, text: Column) -> tuple[Column, Column, Column]:
    """Head, body and tail of a turn."""
    head = F.concat(F.lit(START), F.coalesce(role, F.lit("unknown")), F.lit("\n"))
    body = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return head, F.concat(body, F.lit(END)), F.lit("\n")


def paired(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Format two tables (pair_id, turn, role, text) into one row per pair.

    Columns: pair_id, n_prompt_turns, prompt, chosen, rejected (text), chosen_mask,
    rejected_mask (array of {start, end}, half-open, in characters of the completion).
    """
    columns = ["pair_id", "turn", "role", "text"]
    sides = chosen.select(*columns, F.lit("chosen").alias("side")) \
        .unionByName(rejected.select(*columns, F.lit("rejected").alias("side"))).filter("pair_id is not null").repartition("pair_id")
    in_side = Window.partitionBy("pair_id", "side").orderBy("turn", "role", "text")
    at_place, in_pair = Window.partitionBy("pair_id", "place"), Window.partitionBy("pair_id")
    said = F.struct("role", "text")
    differs = (F.count("*").over(at_place) < 2) | ~F.min(said).over(at_place).eqNullSafe(F.max(said).over(at_place))
    placed = sides.withColumn("place", F.row_number().over(in_side) - 1) \
        .withColumn("differs", differs) \
        .withColumn("n_prompt", F.coalesce(F.min(F.when(F.col("differs"), F.col("place"))).over(in_pair),
                                           F.max("place").over(in_pair) + 1))
    head, body, tail = rendered(F.col("role"), F.col("text"))
    rendered_turns = placed.withColumn("head", head).withColumn("body", body).withColumn("turn_text", F.concat("head", "body", tail))
    after = F.col("place") >= F.col("n_prompt")
    so_far = Window.partitionBy("pair_id", "side").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begun = rendered_turns.withColumn("begin", F.coalesce(
        F.sum(F.when(after, F.length("turn_text")).otherwise(0)).over(so_far), F.lit(0)) + F.length("head"))
    trained = after & (F.col("role") == "assistant")
    spans = F.struct("begin", (F.col("begin") + F.length("body")).alias("stop"))

    def text_of(which: Column) -> Column:
        turns = F.array_sort(F.collect_list(F.when(which, F.struct("place", "turn_text"))))
        return F.array_join(F.transform(turns, lambda x: x["turn_text"]), "")

    def mask_of(side: str) -> Column:
        found = F.array_sort(F.collect_list(F.when(trained & (F.col("side") == side), spans)))
        return F.transform(found, lambda x: F.struct(x["begin"].cast("long").alias("start"), x["stop"].cast("long").alias("end")))

    # The prompt is rendered from the chosen side only (both have the same turns there).
    return begun.groupBy("pair_id").agg(
        F.first("n_prompt").cast("long").alias("n_prompt_turns"),
        text_of(~after & (F.col("side") == "chosen")).alias("prompt"),
        text_of(after & (F.col("side") == "chosen")).alias("chosen"),
        text_of(after & (F.col("side") == "rejected")).alias("rejected"),
        mask_of("chosen").alias("chosen_mask"), mask_of("rejected").alias("rejected_mask"))


def following(ids: DataFrame, column: str) -> DataFrame:
    """(column, next): every value of ``column`` (distinct, not NULL) with the next one, the last with the first.

    Values are dealt to ranges, each of which is a window of its own; a table with one row per range
    carries the first value of the next range over.
    """
    dealt = written(ids.select(column).repartitionByRange(column).withColumn("at", F.spark_partition_id()), "ids")
    firsts = dealt.groupBy("at").agg(F.min(column).alias("first"))
    along = Window.orderBy("at")               # one row per range
    borders = firsts.select("at", F.coalesce(F.lead("first").over(along), F.first("first").over(along)).alias("over"))
    in_range = Window.partitionBy("at").orderBy(column)
    return dealt.withColumn("next", F.lead(column).over(in_range)).join(borders, "at") \
        .select(column, F.coalesce("next", "over").alias("next"))


def reply_swaps(conversations: DataFrame, conv_id: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns: a conversation up to its last assistant reply, and the same with
    that reply replaced by the last reply of the next conversation, in order of ids of any type, that has one
    (after the last conversation, the first; left away where there is no other).

    Conversations without an assistant turn, or without an id, make no pair.
    """
    turns = conversations.select(F.col(conv_id).alias("pair_id"), "turn", "role", "text").filter("pair_id is not null")
    last = turns.filter("role = 'assistant'").groupBy("pair_id").agg(F.max(F.struct("turn", "text")).alias("last"))
    chosen = turns.join(last.select("pair_id", F.col("last.turn").alias("end")), "pair_id")
    chosen = chosen.filter((F.col("turn") < F.col("end")) | ((F.col("turn") == F.col("end")) & (F.col("role") == "assistant"))
                           | F.col("turn").isNull())
    partner = following(last, "pair_id").filter(F.col("next") != F.col("pair_id"))
    other = partner.join(last.select(F.col("pair_id").alias("next"), F.col("last.text").alias("text")), "next").select("pair_id", "text")
    swapped = last.select("pair_id", F.col("last.turn").alias("turn"), F.lit("assistant").alias("role")).join(other, "pair_id")
    kept = chosen.filter((F.col("turn") < F.col("end")) | F.col("turn").isNull()).drop("end")
    return chosen.drop("end"), kept.unionByName(swapped)


def op10_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference rows of every conversation that has an assistant reply."""
    found = paired(*reply_swaps(read_table(spark, sf_dir, "conversations")))
    total = lambda spans: F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    starts = lambda c: F.array_join(F.transform(c, lambda x: x["start"].cast("string")), ",")
    return found.select(F.col("pair_id").alias("conv_id"), "n_prompt_turns", "prompt", "chosen", "rejected",
                        total(F.col("chosen_mask")).alias("chosen_trained"), total(F.col("rejected_mask")).alias("rejected_trained"),
                        starts("chosen_mask").alias("chosen_starts"), starts("rejected_mask").alias("rejected_starts"))


OP10_SQL = r"""
WITH turns AS (SELECT conv_id AS pair_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
last AS (
  SELECT pair_id, turn AS last_turn, text AS last_text FROM (
    SELECT *, row_number() OVER (PARTITION BY pair_id ORDER BY turn DESC, text DESC) AS rn FROM turns WHERE role = 'assistant')
  WHERE rn = 1),
partner AS (SELECT pair_id, coalesce(lead(pair_id) OVER (ORDER BY pair_id), min(pair_id) OVER ()) AS next_id FROM last),
chosen AS (SELECT t.* FROM turns t JOIN last l USING (pair_id) WHERE turn < last_turn OR (turn = last_turn AND role = 'assistant')),
rejected AS (
  SELECT t.* FROM turns t JOIN last l USING (pair_id) WHERE turn < last_turn
  UNION ALL SELECT l.pair_id, l.last_turn, 'assistant', n.last_text FROM partner p JOIN last l USING (pair_id)
  JOIN last n ON n.pair_id = p.next_id WHERE p.next_id <> p.pair_id),
sides AS (SELECT *, 'c' AS side FROM chosen UNION ALL SELECT *, 'r' FROM rejected),
placed AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) - 1 AS place,
                  replace(text, '<|', '< |') || '<|im_end|>' AS body, '<|im_start|>' || role || chr(10) AS head FROM sides),
same AS (SELECT pair_id, place FROM placed GROUP BY 1, 2
         HAVING count(*) = 2 AND count(DISTINCT role) = 1 AND count(DISTINCT text) = 1),
cut AS (SELECT p.pair_id, coalesce(min(CASE WHEN s.place IS NULL THEN p.place END), max(p.place) + 1) AS n_prompt
        FROM placed p LEFT JOIN same s ON p.pair_id = s.pair_id AND p.place = s.place GROUP BY 1),
full_turns AS (SELECT p.*, n_prompt, head || body || chr(10) AS t FROM placed p JOIN cut USING (pair_id)),
offsets AS (SELECT *, coalesce(sum(CASE WHEN place >= n_prompt THEN length(t) ELSE 0 END)
              OVER (PARTITION BY pair_id, side ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS b
            FROM full_turns)
SELECT pair_id AS conv_id, max(n_prompt)::BIGINT AS n_prompt_turns,
  coalesce(string_agg(CASE WHEN side = 'c' AND place < n_prompt THEN t END, '' ORDER BY place), '') AS prompt,
  coalesce(string_agg(CASE WHEN side = 'c' AND place >= n_prompt THEN t END, '' ORDER BY place), '') AS chosen,
  coalesce(string_agg(CASE WHEN side = 'r' AND place >= n_prompt THEN t END, '' ORDER BY place), '') AS rejected,
  coalesce(sum(CASE WHEN side = 'c' AND place >= n_prompt AND role = 'assistant' THEN length(body) END), 0)::BIGINT AS chosen_trained,
  coalesce(sum(CASE WHEN side = 'r' AND place >= n_prompt AND role = 'assistant' THEN length(body) END), 0)::BIGINT AS rejected_trained,
  coalesce(string_agg(CAST(b::BIGINT AS VARCHAR), ',' ORDER BY place) FILTER (side = 'c' AND place >= n_prompt AND role = 'assistant'), '') AS chosen_starts,
  coalesce(string_agg(CAST(b::BIGINT AS VARCHAR), ',' ORDER BY place) FILTER (side = 'r' AND place >= n_prompt AND role = 'assistant'), '') AS rejected_starts
FROM offsets GROUP BY 1
"""
