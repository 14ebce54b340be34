"""Batch-line files as frames, and frames as decoded events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidelog.operators.envelope import decode_events, event_batches, explode_events, parse_lines, valid_lines
from tidelog.operators.segments import segmented_scan


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-empty lines of newline-delimited files, numbered from 0.

    Columns: file, frame_id, value, and stream_id for the folders of :func:`write_lines`.
    Those are numbered along each stream, whose files continue each other in the order of
    their names; other files each for itself. A split of a file is a segment of the order,
    so numbering shuffles lines by split, not by file.
    """
    lines = spark.read.text(path, lineSep="\n")
    stream = ["stream_id"] if "stream_id" in lines.columns else []
    lines = lines.select(
        *[F.col(c).cast("string").alias(c) for c in stream],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_place"),
        "value",
    ).filter(F.length("value") > 0)
    order = ["file", "_split", "_place"] if stream else ["_split", "_place"]
    segment = F.struct("file", "_split") if stream else F.col("_split")
    numbered = segmented_scan(lines, stream or ["file"], order, segment, row_number="_rn")
    return numbered.select(*stream, "file", (F.col("_rn") - 1).alias("frame_id"), "value")


def write_lines(frames: DataFrame, path: str) -> None:
    """Write the lines of frames, one folder per stream.

    Tasks take ranges of (stream_id, frame_id), so the files of a stream, in the order of
    their names, hold its lines in order, and :func:`read_lines` gives back their numbers.
    """
    frames.repartitionByRange("stream_id", "frame_id").sortWithinPartitions("stream_id", "frame_id").select(
        "stream_id", "value"
    ).write.partitionBy("stream_id").text(path)


def stream_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same files as a stream of non-empty lines, without numbers."""
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).filter(F.length("value") > 0)


def read_events(
    frames: DataFrame,
    schema: T.StructType | None = None,
    required: Sequence[str] = (),
    mode: str = "quarantine",
) -> DataFrame:
    """Frames → events with their cursor, in one call; decoded if a schema is given."""
    rows = explode_events(event_batches(valid_lines(parse_lines(frames), mode)))
    return rows if schema is None else decode_events(rows, schema, required)
