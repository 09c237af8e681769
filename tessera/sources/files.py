"""File sources: listings without contents, filtered by kind before anything is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalars import png_size, suffix

IMAGES = (".jpg", ".jpeg", ".png", ".webp", ".bmp", ".tiff")  # fixed; .tif is not among them
DOCUMENTS = (*IMAGES, ".pdf")


def listing(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """(path, length, modification_time[, content]) of the files below a path (SRC1, SRC5).

    Without ``content`` the scan reads names only.  Hidden files and folders are skipped.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    cols = ["path", "length", F.col("modificationTime").alias("modification_time")]
    return df.select(*cols, *(["content"] if content else []))


def of_kind(files: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return files.where(suffix(F.col("path")).isin(*kinds))


def documents(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Page images and PDFs (SRC2)."""
    return of_kind(listing(spark, path, content), DOCUMENTS)


def pdfs(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    return of_kind(listing(spark, path, content), (".pdf",))


def images(spark: SparkSession, path: str, content: bool = False) -> DataFrame:
    """Images, without PDFs (SRC4)."""
    return of_kind(listing(spark, path, content), IMAGES)


def dispatched(files: DataFrame) -> DataFrame:
    """Whether a file is rendered first (PDF) or is its own page image (SRC16)."""
    pdf = suffix(F.col("path")) == ".pdf"
    return files.withColumn("needs_render", pdf).withColumn("image", F.when(~pdf, F.col("path")))


def png_headers(files: DataFrame) -> DataFrame:
    """Sizes of PNG files from their headers (SRC22); null where a header isn't one."""
    return files.select("path", png_size(F.col("content")).alias("size")).select("path", "size.width", "size.height")


def outside_cache(path: Column) -> Column:
    """No part of the path is ``.cache`` (SRC12)."""
    return ~F.array_contains(F.split(path, "/"), ".cache")
