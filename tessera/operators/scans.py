"""Windows over keys of any size: a prefix scan in two passes over ranges of the order.

A window by key brings all rows of a key to one task.  Here rows are dealt out by ranges of (key,
order), so that one key fills as many ranges as it needs; each range makes its own numbers, sums,
rows before and rows behind, and what a key had in the ranges before comes from a table of one row
for each key and range.  A range's rows are bounded by the range, that table's rows of a key by the
number of ranges.

The order must tell the rows of a key apart where the result depends on it, as for a window.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the folder that driver and executors share, and read back: computed once, whatever follows."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranges(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def placed(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Rows with ``_part``, the number of their range; a key's ranges are in the order of their numbers."""
    by = [*keys, *order]
    return kept(df.repartitionByRange(parts or ranges(df.sparkSession), *by).withColumn("_part", F.spark_partition_id()), "ranges")


def scanned(rows: DataFrame, keys: list[str], order: list[str], number: str | None = None, sums: dict[str, Column] | None = None, lags: dict[str, str] | None = None, leads: dict[str, str] | None = None) -> DataFrame:
    """``placed`` rows with a row number, running sums up to and with a row, and values of the row before or behind."""
    sums, lags, leads = sums or {}, lags or {}, leads or {}
    own = [*keys, "_part"]
    w = Window.partitionBy(*own).orderBy(*order)
    whole = F.struct(*dict.fromkeys([*order, *lags.values(), *leads.values()]))
    inside = rows.withColumns({f"_sum_{n}": e for n, e in sums.items()})
    total = inside.groupBy(*own).agg(F.count("*").alias("_rows"), F.min(whole).alias("_first"), F.max(whole).alias("_last"), *[F.sum(f"_sum_{n}").alias(f"_total_{n}") for n in sums])
    across = Window.partitionBy(*keys).orderBy("_part")  # a row for each of a key's ranges
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = total.select(
        *[F.col(c).alias(f"_own_{k}") for k, c in enumerate(own)], F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows"), F.lag("_last").over(across).alias("_last"), F.lead("_first").over(across).alias("_first"),
        *[F.coalesce(F.sum(f"_total_{n}").over(before), F.lit(0)).alias(f"_total_{n}") for n in sums],
    )
    local = inside.withColumn("_n", F.row_number().over(w)).withColumn("_more", F.lead(F.lit(True)).over(w))
    local = local.withColumns({f"_sum_{n}": F.sum(f"_sum_{n}").over(w.rowsBetween(Window.unboundedPreceding, 0)) for n in sums})
    local = local.withColumns({f"_lag_{n}": F.lag(c).over(w) for n, c in lags.items()} | {f"_lead_{n}": F.lead(c).over(w) for n, c in leads.items()})
    both = local.join(carried, [F.col(c).eqNullSafe(F.col(f"_own_{k}")) for k, c in enumerate(own)], "left")
    made = {n: F.coalesce(F.col(f"_sum_{n}"), F.lit(0)) + F.col(f"_total_{n}") for n in sums}
    made |= {n: F.when(F.col("_n") == 1, F.col("_last")[c]).otherwise(F.col(f"_lag_{n}")) for n, c in lags.items()}
    made |= {n: F.when(F.col("_more").isNull(), F.col("_first")[c]).otherwise(F.col(f"_lead_{n}")) for n, c in leads.items()}
    if number:
        made[number] = F.col("_rows") + F.col("_n")
    return both.select(*rows.columns, *[e.alias(n) for n, e in made.items()])


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "index", parts: int | None = None) -> DataFrame:
    """Row numbers of keys of any size (WIN1)."""
    return scanned(placed(df, keys, order, parts), keys, order, number=name).drop("_part")


def segmented(df: DataFrame, track: list[str], frame: str = "frame_index", max_gap: int = 30, parts: int | None = None) -> DataFrame:
    """``tracks.segmented`` for tracks of any length (WIN3): a new segment where over ``max_gap`` frames are missing."""
    return _segments(df, track, frame, max_gap, parts).drop("_part")


def _segments(df: DataFrame, track: list[str], frame: str, max_gap: int, parts: int | None) -> DataFrame:
    rows = scanned(placed(df, track, [frame], parts), track, [frame], lags={"_before": frame})
    started = F.when(F.col(frame) - F.col("_before") > max_gap + 1, 1).otherwise(0)
    return scanned(rows, track, [frame], sums={"segment_id": started}).drop("_before").withColumn("segment_id", F.col("segment_id").cast("long"))


def interpolated(df: DataFrame, track: list[str], values: list[str], frame: str = "frame_index", score: str | None = None, max_gap: int = 30, parts: int | None = None) -> DataFrame:
    """Segments with a row on every frame, values straight in between, for tracks of any length (WIN3, WIN4, JOIN7)."""
    rows = _segments(df, track, frame, max_gap, parts)
    rows = scanned(rows, track, [frame], leads={"_next": frame, "_next_segment": "segment_id"} | {f"_{v}": v for v in values})
    goes_on = F.col("_next_segment") == F.col("segment_id")
    last = F.when(goes_on, F.col("_next") - 1).otherwise(F.col(frame))
    span = rows.withColumn("_at", F.explode(F.sequence(F.col(frame), last)))
    seen = F.col("_at") == F.col(frame)
    line = lambda v: F.when(seen, F.col(v).cast("double")).otherwise(F.col(v) + (F.col(f"_{v}") - F.col(v)) / (F.col("_next") - F.col(frame)) * (F.col("_at") - F.col(frame)))
    out = [*track, "segment_id", F.col("_at").alias(frame), *[line(v).alias(v) for v in values], seen.alias("detected")]
    return span.select(*out, *([F.when(seen, F.col(score)).alias(score)] if score else []))
