"""Shared plumbing: the shared folder, exchanges by bucket, keyed lists and components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The pattern of a word in SQL: what Spark's regular expressions call it.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``).

    Only where a session on one machine has none, as in tests, a temporary folder is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = jdir.get() if jdir.isDefined() else None
    if not base:
        if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_RESIDENT: dict = {}


def resident(key, make):
    """A Python worker's model with what it remembers, kept from task to task; one at a time, so
    that a worker which serves several operators holds the memory of one."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        trim()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def release() -> None:
    """Give freed memory back: what one piece of work has freed, the allocators else keep beside what the next takes."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def trim() -> None:
    """Give freed memory back at the end of a task: idle workers then leave room for what runs next."""
    gc.collect()
    release()


def exchange(df: DataFrame, n: int, bucket: str = "bucket") -> DataFrame:
    """Send each row to the partition that its bucket numbers."""
    return df.repartitionById(n, F.col(bucket))


def fold_components(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node it reaches) over the links given, by repeated halving of paths."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    root = np.arange(len(nodes))
    while True:
        rx, ry = root[x], root[y]
        low, high = np.minimum(rx, ry), np.maximum(rx, ry)
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while True:
            nxt = root[root]
            if (nxt == root).all():
                break
            root = nxt


def apart(docs: DataFrame, key: str, content: str) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """Rows that share a key but not their content become documents of their own.

    Returns ``docs`` with a long key and a function that gives columns of its result their keys
    back.  Where no key repeats nothing is changed.  Else every distinct (key, content) gets a
    number, in the order of keys and then of hashes of the content; equal rows share it.
    """
    docs = docs.withColumn(key, F.col(key).cast("long"))
    n, different = docs.agg(F.count(key), F.count_distinct(key)).first()
    if n == different:
        return docs, lambda df, *_: df
    mark = [F.xxhash64(content).alias("_ts_m1"), F.xxhash64(F.lit(7), F.col(content)).alias("_ts_m2")]
    own = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("_ts_name"), *mark).distinct().orderBy("_ts_name", "_ts_m1", "_ts_m2")
    names = stored(own.withColumn("_ts_key", F.monotonically_increasing_id()), "keys")
    marked = docs.select("*", *mark)
    same = (F.col(key) == F.col("_ts_name")) & (marked["_ts_m1"] == names["_ts_m1"]) & (marked["_ts_m2"] == names["_ts_m2"])
    told = marked.join(names, same, "left").select(*[F.col("_ts_key").alias(c) if c == key else docs[c] for c in docs.columns])

    def back(df: DataFrame, *columns: str) -> DataFrame:
        order = df.columns
        for c in columns:
            df = df.join(names.select(F.col("_ts_key").alias(c), F.col("_ts_name").alias(f"_ts_{c}")), c, "left").drop(c).withColumnRenamed(f"_ts_{c}", c)
        return df.select(*order)

    return told, back


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) from (a, b) links: the least node that each linked node can reach.

    Alternating large-star and small-star rounds over DataFrames: each round is two grouped
    minima, combined before the shuffle, and the number of links never grows.  A hot node only
    ever sends partial minima, so no task holds a whole group.  A link may come to repeat, which
    changes no minimum, so no round has to make links distinct.  Rounds are logarithmic in the
    longest chain.  Lineage is cut in the shared folder each round.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    last = None
    for _ in range(rounds):
        # large star: every greater neighbour of a node is linked to the node's least one
        both = e.select("u", "v").union(e.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its lesser neighbours are linked to the least of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        e = stored(large.join(down, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")), "links")
        total = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if total == last:
            break
        last = total
    else:
        raise RuntimeError(f"components are unfinished after {rounds} rounds")
    return e.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def rows(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], type=pa.binary())


def joined(values, dtype) -> np.ndarray:
    """One array of the binary values of a column or list."""
    data = b"".join(v for v in values if v)
    return np.frombuffer(data, dtype)


