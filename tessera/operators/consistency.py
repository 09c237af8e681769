"""Image-text consistency: cosines, softmax over the texts of an image, best match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scalars import cosine

SCALE = 100.0


def pairs(images: DataFrame, texts: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Images with their texts: by key, or the texts of one request with every image (JOIN3).

    A request's texts are a handful of arguments; they are counted before they are broadcast.
    """
    if on:
        return images.join(texts, on)
    if texts.limit(10_001).count() > 10_000:
        raise ValueError("texts of a request are few; key them by image instead")
    return images.crossJoin(F.broadcast(texts))


def softmax(value: Column, by: list[str], scale: float = SCALE) -> Column:
    """exp(scale v) over its sum in the group, stable, null for null (WIN8, AGG10)."""
    w = Window.partitionBy(*by)
    e = F.exp(scale * (value - F.max(value).over(w)))
    return e / F.sum(e).over(w)


def scored(pairs_: DataFrame, image: str = "image_id", a: str = "image_embedding", b: str = "text_embedding") -> DataFrame:
    """Add cosine_similarity and consistency_score, six places (MTH1, MTH2)."""
    c = pairs_.withColumn("_c", cosine(F.col(a), F.col(b)))
    return c.withColumn("consistency_score", F.bround(softmax(F.col("_c"), [image]), 6)).withColumn("cosine_similarity", F.bround("_c", 6)).drop("_c")


def best_match(scores: DataFrame, image: str = "image_id", pos: str = "pos") -> DataFrame:
    """The text with the greatest rounded score, of equals the first; null is never best (AGG8)."""
    w = Window.partitionBy(image).orderBy(F.col("consistency_score").desc_nulls_last(), pos)
    return scores.where(F.col("consistency_score").isNotNull()).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
