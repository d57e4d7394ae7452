"""Latest issues, kept up to date batch by batch (J1 over overlapping pulls).

The reference appends every pull to what it has with a full join; a plain append would leave each
re-pulled issue several times, and every report would have to shuffle the table for the latest copies.
Here the table holds one row per issue at any time.  Issues are dealt to a fixed number of
*buckets* by a hash of (project, id); a batch rewrites only the buckets that it touches, as
``v=<version>/bucket=<k>`` folders, and then publishes which version of each bucket is live.  Readers
open the live folders: no shuffle, and never a half-written batch.  A version is named by its batch,
so a batch that is run again after a failure writes the same folders and the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from issuelens.session import as_table, remove_folder, shared_dir, small_methods, unsorted_writes
from issuelens.sources.pages import explode_issues
from issuelens.streaming.ingest import stream_pages

BUCKETS = 256                  # of a new table; a bucket should fit a task (some 100 MB to 1 GB)
LIVE = "version long, buckets int, live map<int,long>"
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}        # VARIANTs repeat their field ids in every issue


def published(spark: SparkSession, table: str, before: int | None = None) -> tuple[int, dict[int, int]] | None:
    """(number of buckets, live version of each) as last published, or as before a version; None for a new table."""
    try:
        log = spark.read.schema(LIVE).parquet(f"{table}/live")
    except Exception as e:      # no such folder yet
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    rows = log if before is None else log.where(F.col("version") < before)
    last = rows.orderBy(F.col("version").desc()).first()
    return (last["buckets"], dict(last["live"])) if last else None


def folders(table: str, live: dict[int, int], wanted: list[int] | None = None) -> list[str]:
    return [f"{table}/v={live[b]:012d}/bucket={b}" for b in sorted(live if wanted is None else set(wanted) & set(live))]


OLDER_AT_ONCE = 500_000        # keys of replaced copies that tasks hold at once: whole buckets, one at least


def groups_of(buckets: list[int], sizes: dict[int, int], most: int) -> list[list[int]]:
    """The buckets in groups of at most ``most`` rows together, or of one bucket."""
    groups, n = [], most + 1
    for b in sorted(buckets):
        n += sizes.get(b, 0)
        if n > most:
            groups.append([])
            n = sizes.get(b, 0)
        groups[-1].append(b)
    return groups


def compact_batch(issues: DataFrame, table: str, version: int, buckets: int = BUCKETS) -> None:
    """Merge ``issues`` (of ``explode_issues`` with ``keep_names``) into the table as ``version`` (ascending).

    Reads the batch and the touched buckets only.  An issue's latest copy is that of the latest pull, then page,
    then position, as in ``latest_issue_version``.  Older copies are found among the copies' keys, which alone are
    shuffled; issues go from the batch and from the live folders straight to their new folders, but for those
    copies.  Which fields have values is read off ``fields``, not stored.
    """
    spark = issues.sparkSession
    before = published(spark, table, version)
    buckets, live = before if before else (buckets, {})
    rows = issues.drop("present").withColumn("bucket", F.pmod(F.xxhash64("project", "id"), F.lit(buckets)).cast("int")) \
        .withColumn("_row", F.monotonically_increasing_id())
    batch, folder = shared_dir(spark, "batch"), f"{table}/v={version:012d}"
    with small_methods(spark), unsorted_writes(spark, buckets):
        rows.write.options(**PACKED).partitionBy("bucket").parquet(batch)
    new = spark.read.option("basePath", batch).schema(rows.schema).parquet(batch)
    touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]      # at most ``buckets``
    if not touched:
        return

    def copies(wanted: list[int]) -> DataFrame:
        found = new.where(F.col("bucket").isin(wanted))
        old = folders(table, live, wanted)
        if not old:
            return found
        names = [c for c in rows.columns if c != "_row"]
        held = spark.read.option("basePath", table).schema(rows.select(*names).schema).parquet(*old).select(*names)
        return found.unionByName(held.withColumn("_row", F.lit(-1).cast("long")))     # an issue is there once

    newest = Window.partitionBy("bucket", "project", "id").orderBy(
        F.coalesce("pull", F.lit("")).desc(), F.coalesce("page_no", F.lit(-1)).desc(), F.col("issue_pos").desc(), F.col("_row").desc())
    keys = copies(touched).select("bucket", "project", "id", "pull", "page_no", "issue_pos", "_row")
    older = as_table(keys.withColumn("_nth", F.row_number().over(newest)).where("_nth > 1").select("bucket", "project", "id", "_row"), "older-copies")
    n_older = dict(older.groupBy("bucket").count().collect())
    replace = "overwrite"
    for some in groups_of(touched, n_older, OLDER_AT_ONCE):
        merged = copies(some)
        if any(b in n_older for b in some):
            out = older.where(F.col("bucket").isin(some)).select(*[F.col(c).alias(f"_{c}") for c in ("bucket", "project", "id")], F.col("_row").alias("_older"))
            merged = merged.join(F.broadcast(out), (F.col("bucket") == F.col("_bucket")) & F.col("project").eqNullSafe(F.col("_project"))
                                 & F.col("id").eqNullSafe(F.col("_id")) & (F.col("_row") == F.col("_older")), "left_anti")
        with small_methods(spark), unsorted_writes(spark, buckets):
            merged.drop("_row").write.options(**PACKED).partitionBy("bucket").mode(replace).parquet(folder)
        replace = "append"
    remove_folder(spark, batch)
    live = {**live, **{b: version for b in touched}}
    spark.createDataFrame([(version, buckets, live)], LIVE).coalesce(1).write.mode("overwrite").parquet(f"{table}/live/n={version:012d}")


def read_compacted(spark: SparkSession, table: str) -> DataFrame:
    """One row per issue, its latest copy; the plan is a scan."""
    state = published(spark, table)
    if state is None:
        raise ValueError(f"nothing is published in {table}")
    return spark.read.option("basePath", table).parquet(*folders(table, state[1])).drop("v", "bucket")


def ingest_latest(spark: SparkSession, landing: str, table: str, checkpoint: str, buckets: int = BUCKETS,
                  available_now: bool = True, one_page_per_line: bool = False) -> StreamingQuery:
    """Merge the issues of newly landed pages into the table, batch by batch."""
    issues = explode_issues(stream_pages(spark, landing, one_page_per_line=one_page_per_line), keep_names=True)
    writer = issues.writeStream.foreachBatch(lambda batch, n: compact_batch(batch, table, n, buckets)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
