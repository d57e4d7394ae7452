"""Time spent in each status per issue (Q5; W1-W5, P10, P12, F3, F7, F8, A1, R3).

Input is a flat table of change-history items, one row per item:
``key, ticket_created, changed_at, field, from_status, to_status`` plus the positions that
order items with equal timestamps (history position, item position).

Semantics kept from the reference:
* an issue whose items contain no ``status`` item (and no item without a field name) gets
  one synthetic ``Open -> No-Change`` transition at ``as_of``;
* only ``status`` items count; the time between consecutive transitions (the first one
  from ticket creation) is charged to the status being *left*;
* status names are title-cased and stripped of spaces before summing, so spellings that
  differ only by case merge;
* the result is one row per issue and one fractional-day column per status; a status the
  issue never left is NULL; time in the current status is not counted (unless asked).

Plan: the synthetic rows come from a per-issue aggregate (partial aggregation, no window),
the lag is one window partitioned by issue (hot issues split by time range, see
``sequence.py``), and the sum by (issue, status) and the pivot reuse the window's
partitioning, so an ordinary run has one exchange of the items.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from issuelens.functions.scalars import as_of_literal, days_between, r_timestamp
from issuelens.functions.titlecase import status_name
from issuelens.operators.sequence import DEFAULT_POLICY, SkewPolicy, lag_in_order
from issuelens.operators.tables import spread
from issuelens.session import settle

STATUS_FIELD = "status"
OPEN = "Open"
NO_CHANGE = "No-Change"


def _ts(df: DataFrame, c: str) -> Column:
    dt = df.schema[c].dataType
    if isinstance(dt, StringType):
        return r_timestamp(F.col(c))
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.col(c).cast("timestamp")
    return F.col(c).cast("timestamp")


def status_transitions(items: DataFrame, key: str = "IssueKey", field: str = "item_field",
                       changed_at: str = "created", from_col: str = "item_fromString",
                       to_col: str = "item_toString", ticket_created: str = "TicketCreated",
                       order: Sequence[str] = ("history_pos", "item_pos"),
                       as_of: str | None = None) -> DataFrame:
    """Status items plus the synthetic ``Open -> No-Change`` row.

    R decides per issue with ``!any(item_field == "status")``; that is TRUE only when no
    item is a status item *and* no item lacks a field name (a missing name makes ``any``
    NA).  Computed as an aggregate per issue, so a hot issue is combined map-side instead
    of being gathered into one window task.
    """
    base = items.select(
        F.col(key).alias(key),
        _ts(items, ticket_created).alias("ticket_created"),
        _ts(items, changed_at).alias("changed_at"),
        F.col(field).alias("field"),
        F.col(from_col).cast("string").alias("from_status"),
        F.col(to_col).cast("string").alias("to_status"),
        *[F.col(c).cast("long").alias(f"_o{i}") for i, c in enumerate(order)],
    )
    status_rows = base.where(F.col("field") == F.lit(STATUS_FIELD))
    flags = (base.groupBy(key)
             .agg(F.max(F.col("field") == F.lit(STATUS_FIELD)).alias("_has_status"),
                  F.count_if(F.col("field").isNull()).alias("_unnamed"),
                  F.min("ticket_created").alias("ticket_created")))
    synthetic = (flags.where(~F.coalesce(F.col("_has_status"), F.lit(False)) & (F.col("_unnamed") == 0))
                 .select(F.col(key), F.col("ticket_created"),
                         as_of_literal(as_of).alias("changed_at"),
                         F.lit(STATUS_FIELD).alias("field"),
                         F.lit(OPEN).alias("from_status"),
                         F.lit(NO_CHANGE).alias("to_status"),
                         *[F.lit(-1).cast("long").alias(f"_o{i}") for i in range(len(order))]))
    return status_rows.unionByName(synthetic)


def with_status_names(transitions: DataFrame, normalize: bool = True) -> DataFrame:
    """Add ``status``: the normalised name of ``from_status`` (title case, no spaces)."""
    name = status_name(F.col("from_status")) if normalize else F.coalesce(F.col("from_status"), F.lit("NA"))
    return transitions.withColumn("status", name)


def elapsed_by_status(transitions: DataFrame, key: str, normalize: bool = True,
                      policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Long result: (key, status, days) with days summed per status left."""
    order_cols = [c for c in transitions.columns if c.startswith("_o")]
    t = lag_in_order(transitions, [key], ["changed_at", *order_cols], value="changed_at", default="ticket_created",
                     out="_prev", policy=policy)
    return (with_status_names(t, normalize)
            .withColumn("_days", days_between(F.col("changed_at"), F.col("_prev")))
            .groupBy(key, "status")
            .agg(F.coalesce(F.sum("_days"), F.lit(0.0)).alias("days")))


def open_time(transitions: DataFrame, key: str, as_of: str | None, normalize: bool = True) -> DataFrame:
    """Optional: (key, status, days) for the status an issue is in now, from its last
    transition to ``as_of`` -- time the reference does not count.  One partial aggregate
    per issue (the last transition by ``max_by``)."""
    order_cols = [c for c in transitions.columns if c.startswith("_o")]
    last = F.max_by(F.struct("changed_at", "to_status"),
                    F.struct(*[x for c in ["changed_at", *order_cols] for x in (F.col(c).isNull(), F.col(c))]))
    cur = transitions.groupBy(key).agg(last.alias("_last"))
    named = cur.select(key, F.col("_last.to_status").alias("from_status"),
                       days_between(as_of_literal(as_of), F.col("_last.changed_at")).alias("days"))
    return with_status_names(named, normalize).select(key, "status", "days")


def status_durations(transitions: DataFrame, key: str = "IssueKey", statuses: Sequence[str] | None = None,
                     normalize: bool = True, policy: SkewPolicy = DEFAULT_POLICY,
                     include_open: bool = False, as_of: str | None = None) -> DataFrame:
    """Wide result: one row per issue, one day-count column per status (R3 pivot).

    The status columns come from the data; passing ``statuses`` skips the job that finds
    them, and a status it does not list is an error.
    When the hot-issue check is on, the transitions are checkpointed first (into the
    shared checkpoint folder): the size statistics and the durations then read one narrow
    table instead of walking the change history twice.  ``include_open`` also charges
    the time from the last transition to ``as_of`` to the current status.
    """
    if policy.enabled:
        transitions = settle(transitions)
    long = elapsed_by_status(transitions, key, normalize, policy)
    if include_open:
        long = (long.unionByName(open_time(transitions, key, as_of, normalize))
                .groupBy(key, "status").agg(F.sum("days").alias("days")))
    return spread(long, key, "status", F.col("days"), statuses)


def time_in_status(items: DataFrame, key: str = "IssueKey", as_of: str | None = None,
                   statuses: Sequence[str] | None = None, policy: SkewPolicy = DEFAULT_POLICY,
                   include_open: bool = False, **columns) -> DataFrame:
    """History items -> per-issue status durations (the whole Q5 chain)."""
    as_of = as_of or now_text()
    return status_durations(status_transitions(items, key=key, as_of=as_of, **columns), key=key,
                            statuses=statuses, policy=policy, include_open=include_open, as_of=as_of)


def now_text() -> str:
    """The present instant as text, so that one run uses one "now" (F11)."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")


def days_by_status(histories: Column, ticket_created: Column, as_of: str, normalize: bool = True,
                   include_open: bool = False) -> Column:
    """Q5 inside the row: a change log (array of VARIANT histories) -> map of status -> days.

    The log of an issue sits in its row, so nothing is exploded, shuffled or joined: the items
    are flattened with their positions, the status items sorted by (time, NULL last,
    position), and each charged the time since the one before it (the first: since ticket
    creation).  The rules are those of :func:`status_transitions` and :func:`elapsed_by_status`.
    An issue without items has no map (NULL).
    """
    def once(value: Column, use) -> Column:
        # binds a value to a lambda variable, so that it is evaluated once, not per element
        return F.element_at(F.transform(F.array(value), use), 1)

    def items_of(h: Column, pos: Column) -> Column:
        created = r_timestamp(F.try_variant_get(h, "$.created", "string"))
        items = F.coalesce(F.try_variant_get(h, "$.items", "array<variant>"), F.array().cast("array<variant>"))
        return F.transform(items, lambda i, k: F.struct(
            created.isNull().alias("undated"), created.alias("at"), pos.alias("history"), k.alias("item"),
            F.try_variant_get(i, "$.field", "string").alias("field"),
            F.try_variant_get(i, "$.fromString", "string").alias("left"),
            F.try_variant_get(i, "$.toString", "string").alias("entered")))

    def name(c: Column) -> Column:
        return status_name(c) if normalize else F.coalesce(c, F.lit("NA"))

    now = as_of_literal(as_of)

    def of_items(items: Column) -> Column:
        status = F.filter(items, lambda x: x["field"] == STATUS_FIELD)
        silent = ~F.exists(items, lambda x: x["field"].isNull() | (x["field"] == STATUS_FIELD))
        synthetic = F.array(F.struct(F.lit(False).alias("undated"), now.alias("at"), F.lit(-1).alias("history"), F.lit(-1).alias("item"),
                                     F.lit(STATUS_FIELD).alias("field"), F.lit(OPEN).alias("left"), F.lit(NO_CHANGE).alias("entered")))
        return F.when(F.size(items) > 0, once(F.array_sort(F.when(silent, synthetic).otherwise(status)), of_moves))

    def of_moves(moves: Column) -> Column:
        since = F.concat(F.array(ticket_created), F.transform(moves, lambda x: x["at"]))
        spent = F.zip_with(moves, F.slice(since, F.lit(1), F.size(moves)),
                           lambda x, before: F.struct(name(x["left"]).alias("status"), days_between(x["at"], before).alias("days")))
        if include_open:
            last = F.try_element_at(moves, F.lit(-1))
            still = F.struct(name(last["entered"]).alias("status"), days_between(now, last["at"]).alias("days"))
            spent = F.concat(spent, F.when(F.size(moves) > 0, F.array(still)).otherwise(F.slice(F.array(still), 1, 0)))
        return once(spent, summed)

    def summed(spent: Column) -> Column:
        names = F.array_distinct(F.transform(spent, lambda x: x["status"]))
        return F.map_from_arrays(names, F.transform(names, lambda n: F.aggregate(
            spent, F.lit(0.0), lambda total, x: total + F.when(x["status"] == n, F.coalesce(x["days"], F.lit(0.0))).otherwise(0.0))))

    flat = F.flatten(F.transform(F.coalesce(histories, F.array().cast("array<variant>")), items_of))
    return once(flat, of_items)
