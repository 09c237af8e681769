"""Transcripts: the gate for silent media and the projection of what a model returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import strip
from tessera.schemas import SEGMENT


def gated(media: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silent, to transcribe): silent only where audio is known to be absent (FLT1)."""
    silent = F.col("audio_present").eqNullSafe(F.lit(False))
    return media.where(silent), media.where(~silent)


def result(raw: DataFrame, model: str) -> DataFrame:
    """What a model returned (text, language, segments) as a transcript (PRJ4)."""
    empty = F.expr(f"cast(array() as array<{SEGMENT}>)")
    return raw.select("source", F.lit(model).alias("model"), F.bround("duration_seconds", 3).alias("duration_seconds"), "audio_present", "language", F.coalesce(strip(F.col("text")), F.lit("")).alias("text"), F.coalesce("segments", empty).alias("segments"))


def silent_result(media: DataFrame, model: str) -> DataFrame:
    none = lambda kind: F.lit(None).cast(kind)
    return result(media.withColumns({"text": none("string"), "language": none("string"), "segments": none(f"array<{SEGMENT}>")}), model)


def transcribed(media: DataFrame, model: str, infer) -> DataFrame:
    """All media as transcripts; ``infer`` is called for those that aren't known to be silent."""
    silent, rest = gated(media)
    return silent_result(silent, model).unionByName(result(infer(rest), model))


def stamped(rows: DataFrame) -> DataFrame:
    """The time of the run, for a JSON sink only (DAT1)."""
    return rows.withColumn("generated_at", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"))


def json_text(row: Column) -> Column:
    """A document as JSON with nulls kept (PRJ3)."""
    return F.to_json(row, {"ignoreNullFields": "false"})
