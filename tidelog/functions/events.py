"""Event metadata expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidelog.model import DATA_OPS


def data_op_name(code: Column) -> Column:
    """``C``/``U``/``D``/``S`` → name; NULL for anything else."""
    names = F.create_map(*[F.lit(x) for pair in DATA_OPS.items() for x in pair])
    return F.try_element_at(names, code)


def checked_data_op_name(code: Column) -> Column:
    """As :func:`data_op_name`, but an unknown code raises."""
    name = data_op_name(code)
    return F.when(name.isNotNull(), name).otherwise(
        F.raise_error(F.concat(F.lit("unknown data_op: "), F.coalesce(code, F.lit("NULL"))))
    )


def metadata_to_publish(metadata: Column) -> Column:
    """What a read event's metadata keeps when the event is published again.

    The broker sets partition, received_at and version anew.
    """
    return F.struct(
        metadata["eid"].alias("eid"),
        metadata["event_type"].alias("event_type"),
        metadata["occurred_at"].alias("occurred_at"),
        F.coalesce(metadata["parent_eids"], F.array().cast("array<string>")).alias("parent_eids"),
        F.lit(None).cast("string").alias("partition"),
        metadata["flow_id"].alias("flow_id"),
    )


def new_metadata(eid: Column | None = None, occurred_at: Column | None = None) -> Column:
    """Metadata of a new event.

    Without ``eid`` a random one is drawn, which differs on re-computation: give an
    ``eid`` column, or store the rows, where a job may be replayed.
    """
    return F.struct(
        (F.uuid() if eid is None else eid).alias("eid"),
        F.lit(None).cast("string").alias("event_type"),
        (F.current_timestamp() if occurred_at is None else occurred_at).alias("occurred_at"),
        F.array().cast("array<string>").alias("parent_eids"),
        F.lit(None).cast("string").alias("partition"),
        F.lit(None).cast("string").alias("flow_id"),
    )
