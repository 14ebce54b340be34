"""Publishing: validate, enrich, partition, judge the batch, submit, retry.

Events to publish have ``batch_id``, ``pos`` (place in the batch, from 0), and a
``metadata`` struct. A step that turns an event down sets ``step`` and ``detail``; an
event that was turned down keeps the first reason.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidelog.model import ABORTED, FAILED, SUBMITTED
from tidelog.operators.envelope import decode_events
from tidelog.operators.joins import join_small
from tidelog.operators.partitioning import assign_by_strategy
from tidelog.session import stored


def _turn_down(df: DataFrame, step: str, detail: Column) -> DataFrame:
    """Record ``detail`` as the reason where it is not NULL and none was recorded yet."""
    open_ = F.col("step").isNull() & detail.isNotNull()
    return df.withColumns(
        {
            "step": F.when(open_, F.lit(step)).otherwise(F.col("step")),
            "detail": F.when(open_, detail).otherwise(F.col("detail")),
        }
    )


def submit(events: DataFrame) -> DataFrame:
    """Events with empty verdict columns, ready for the steps below."""
    none = F.lit(None).cast("string")
    return events.withColumns({"step": none, "detail": none})


def validate(
    events: DataFrame,
    event_type: str | Column,
    schema: T.StructType,
    required: Sequence[str] = (),
    max_bytes: int | None = None,
    event: str = "event",
) -> DataFrame:
    """Check each event text against its schema, required fields, size and target type.

    An event type given in the metadata must be the target.
    """
    decoded = decode_events(events, schema, required, event)
    detail = F.col("error")
    if max_bytes is not None:
        too_long = F.octet_length(event) > max_bytes
        detail = F.coalesce(detail, F.when(too_long, F.lit("event too large")))
    given = F.col("metadata.event_type")
    target = F.lit(event_type) if isinstance(event_type, str) else event_type
    detail = F.coalesce(detail, F.when(given.isNotNull() & (given != target), F.lit("event type is not the target")))
    return _turn_down(decoded, "validating", detail).select(*events.columns)


def enrich(
    events: DataFrame, event_type: str | Column, received_at: Column, version: str = "1.0.0"
) -> DataFrame:
    """Fill received_at, event_type and version where they are missing.

    received_at and version are the broker's to set: an event that brings one of them
    is turned down.
    """
    meta = F.col("metadata")
    taken = F.array_compact(
        F.array(*[F.when(meta[n].isNotNull(), F.lit(n)) for n in ("received_at", "version")])
    )
    detail = F.when(F.size(taken) > 0, F.concat(F.lit("may not overwrite "), F.array_join(taken, ",")))
    target = F.lit(event_type) if isinstance(event_type, str) else event_type
    filled = (
        meta.withField("event_type", F.coalesce(meta["event_type"], target))
        .withField("received_at", F.coalesce(meta["received_at"], received_at))
        .withField("version", F.coalesce(meta["version"], F.lit(version)))
    )
    judged = _turn_down(events, "enriching", detail)
    return judged.withColumn("metadata", filled)


def partition(events: DataFrame, strategy: str, partitions: Sequence[str], **options) -> DataFrame:
    """Set ``metadata.partition`` by the strategy; see :func:`assign_by_strategy`."""
    flat = events.withColumn("_given", F.col("metadata.partition")).withColumn("_eid", F.col("metadata.eid"))
    assigned = assign_by_strategy(flat, strategy, partitions, eid="_eid", given="_given", **options)
    judged = _turn_down(assigned, "partitioning", F.col("rejection"))
    return judged.withColumn(
        "metadata", F.col("metadata").withField("partition", F.col("assigned"))
    ).select(*events.columns)


def verdict(events: DataFrame, write_failed: Column | None = None) -> DataFrame:
    """Publishing status of every event and the status code of its batch.

    An event turned down before writing fails and the rest of its batch is aborted
    (422). Otherwise only events for which the write failed fail (207); a batch
    without failures is 200. What was judged so far is stored, as it is read twice. Only batches
    with a failure are aggregated and joined back: few, as a rule, so that the events themselves
    need no shuffle.
    """
    lost = F.coalesce(write_failed, F.lit(False)) if write_failed is not None else F.lit(False)
    rows = stored(events.withColumn("_lost", lost), "judged")
    flags = (
        rows.filter(F.col("step").isNotNull() | F.col("_lost"))
        .groupBy("batch_id")
        .agg(F.bool_or(F.col("step").isNotNull()).alias("_bad"), F.lit(True).alias("_some_lost"))
    )
    turned_down = F.col("step").isNotNull()
    status = (
        F.when(turned_down, F.lit(FAILED))
        .when(F.col("_bad"), F.lit(ABORTED))
        .when(F.col("_lost"), F.lit(FAILED))
        .otherwise(F.lit(SUBMITTED))
    )
    code = F.when(F.col("_bad"), 422).when(F.col("_some_lost"), 207).otherwise(200)
    write_error = ~F.col("_bad") & F.col("_lost")
    return (
        join_small(rows, flags, ["batch_id"], "left")
        .withColumn("_bad", F.coalesce("_bad", F.lit(False)))
        .withColumns(
            {
                "publishing_status": status,
                "code": code,
                "step": F.when(turned_down, F.col("step"))
                .when(F.col("_bad"), F.lit("none"))
                .otherwise(F.lit("publishing")),
                "detail": F.when(write_error, F.lit("write failed")).otherwise(F.col("detail")),
            }
        )
        .drop("_lost", "_bad", "_some_lost")
    )


def with_status(responses: DataFrame, *status: str) -> DataFrame:
    return responses.filter(F.col("publishing_status").isin(*status))


def not_submitted(responses: DataFrame) -> DataFrame:
    return responses.filter(F.col("publishing_status") != SUBMITTED)


def batch_stats(responses: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Counts per status; not submitted are the failed and the aborted ones."""
    status = F.col("publishing_status")
    return responses.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(status == SUBMITTED).alias("n_submitted"),
        F.count_if(status == FAILED).alias("n_failed"),
        F.count_if(status == ABORTED).alias("n_aborted"),
        F.count_if(status.isin(FAILED, ABORTED)).alias("n_not_submitted"),
    )


def retry_set(
    events: DataFrame,
    responses: DataFrame,
    strategy: str = "retry_not_submitted",
) -> DataFrame:
    """Events to send again, with ``error`` set where a batch cannot be paired.

    ``events`` and ``responses`` share (batch_id, pos); ``responses`` has
    publishing_status and the batch's code. Unprocessable batches (422) and fully
    submitted ones (200) are not retried. A batch without any response, or with one that
    has no code, failed on the way: nothing is known of its events, so both retry
    strategies send all of them again. ``retry_not_submitted`` pairs by position and
    needs as many responses as events; where the counts differ every event of the batch
    comes back with the error, none to be sent again.
    """
    if strategy not in ("abort", "retry_all", "retry_not_submitted"):
        raise ValueError(f"unknown strategy: {strategy}")
    error = F.lit(None).cast("string")
    if strategy == "abort":
        return events.limit(0).withColumn("error", error)
    answered = responses.groupBy("batch_id").agg(
        F.max("code").alias("_code"),
        F.count_if(F.col("code").isNull()).alias("_n_unknown"),
        F.count(F.lit(1)).alias("_n_responses"),
    )
    sizes = events.groupBy("batch_id").agg(F.count(F.lit(1)).alias("_n_events"))
    batches = sizes.join(answered, "batch_id", "left")
    failed = F.col("_n_responses").isNull() | (F.col("_n_unknown") > 0)
    partial = ~failed & (F.col("_code") == 207)
    whole = events.join(batches.filter(failed).select("batch_id"), "batch_id", "left_semi").withColumn("error", error)
    if strategy == "retry_all":
        again = events.join(batches.filter(partial).select("batch_id"), "batch_id", "left_semi")
        return whole.unionByName(again.withColumn("error", error))
    paired = F.col("_n_events") == F.col("_n_responses")
    again = (
        events.join(not_submitted(responses).select("batch_id", "pos"), ["batch_id", "pos"], "left_semi")
        .join(batches.filter(partial & paired).select("batch_id"), "batch_id", "left_semi")
        .withColumn("error", error)
    )
    reason = F.concat(F.col("_n_events"), F.lit(" events but "), F.col("_n_responses"), F.lit(" responses"))
    odd = batches.filter(partial & ~paired).select("batch_id", reason.alias("error"))
    return whole.unionByName(again).unionByName(events.join(odd, "batch_id").select(*events.columns, "error"))


def publish_rounds(
    events: DataFrame,
    attempt: Callable[[DataFrame, int], DataFrame],
    strategy: str = "retry_not_submitted",
    max_attempts: int = 3,
) -> DataFrame:
    """Publish, then send the retry set again until it is empty or attempts run out.

    ``attempt(events, n)`` returns the responses (batch_id, pos, publishing_status,
    code, …) of attempt ``n``. The result is all responses with their ``attempt``.
    Each round's rows are written to the shared folder, so a round is neither repeated
    nor does its plan grow with the rounds before. An event keeps its ``pos``.
    """
    return _rounds(events, attempt, strategy, max_attempts)[0]


def _rounds(
    events: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], strategy: str, max_attempts: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All responses; the events of batches that couldn't be paired; what was still to be sent at the end."""
    responses, unpaired = None, None
    todo = stored(events, "to-publish")
    for n in range(1, max_attempts + 1):
        answered = stored(attempt(todo, n).withColumn("attempt", F.lit(n)), "responses")
        responses = answered if responses is None else responses.unionByName(answered)
        again = stored(retry_set(todo, answered, strategy), "retry")
        odd = again.filter(F.col("error").isNotNull())
        unpaired = odd if unpaired is None else unpaired.unionByName(odd)
        todo = again.filter(F.col("error").isNull()).drop("error")
        if todo.isEmpty():
            break
    return responses, unpaired, todo


def publish_accounts(
    events: DataFrame,
    attempt: Callable[[DataFrame, int], DataFrame],
    strategy: str = "retry_not_submitted",
    max_attempts: int = 3,
) -> DataFrame:
    """What became of every event: one row (batch_id, pos, outcome, attempts, error) each.

    ``submitted``: a response of a batch with a code says so, or the batch's code is 200.
    ``unpaired``: its batch came back with another number of responses than events.
    ``given_up``: all others, whether turned down, not to be retried, or still failing
    after the last attempt; ``error`` is then the detail of the last response, or that
    there was none.
    """
    responses, unpaired, _ = _rounds(events, attempt, strategy, max_attempts)
    detail = F.col("detail") if "detail" in responses.columns else F.lit(None).cast("string")
    said = F.col("code").isNotNull() & (F.col("publishing_status") == SUBMITTED)
    last = responses.groupBy("batch_id", "pos").agg(
        F.bool_or(said).alias("_submitted"),
        F.max("attempt").alias("_attempts"),
        F.max_by(detail, "attempt").alias("_detail"),
    )
    whole = responses.groupBy("batch_id").agg(F.bool_or(F.col("code") == 200).alias("_whole"))
    odd = unpaired.select("batch_id", "pos", F.col("error").alias("_odd"))
    key = ["batch_id", "pos"]
    no = F.lit(False)
    submitted = F.coalesce("_submitted", no) | F.coalesce("_whole", no)
    return (
        events.select(*key)
        .join(last, key, "left")
        .join(whole, "batch_id", "left")
        .join(odd, key, "left")
        .select(
            *key,
            F.when(F.col("_odd").isNotNull(), "unpaired").when(submitted, "submitted").otherwise("given_up").alias("outcome"),
            F.coalesce("_attempts", F.lit(0)).alias("attempts"),
            F.when(F.col("_odd").isNotNull(), F.col("_odd"))
            .when(~submitted & F.col("_attempts").isNull(), F.lit("no response"))
            .when(~submitted, F.col("_detail"))
            .alias("error"),
        )
    )
