"""Embedding near-dedup: sign hashing in several tables, exact cosines, components (operator 3).

Vectors that are equal in every component form a class, kept as one representative and a number of
copies.  Representatives are hashed by the signs of random hyperplanes in several tables; width
and number of tables follow from the number of vectors, so that a pair at the threshold is missed
with probability ``MISS`` at most and buckets stay small.  Within a bucket cosines are exact, in
doubles; a pair that shares several buckets counts in the first of them only, which both see from
their hashes, so no list of pairs is ever written: a bucket returns numbers of links and a
spanning forest.  Buckets over a bound are dealt out as pairs of blocks.

Defined results: null vectors and ids, zero vectors and vectors with null or non-finite components
link with nothing and are their own component; vectors of different length don't link; a repeated
row is a vector of its own that shares its id's component; different vectors under one id are told
apart, in the order of a hash; an empty table gives no rows; other columns are ignored.  Vectors
are equal by two independent 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

THRESHOLD = 0.95
MISS = 1e-5
#: Vectors that a bucket has on average, and at most before it is dealt out in blocks.
BUCKET = 128
BLOCK = 2048
SEED = 97

_KEYED = "t int, key long, rep long, copies long, vec binary, sig binary"
_MADE = pa.schema([("rep", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def shape(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bits of a table, tables) for n vectors."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = max(4, round(math.log2(max(1, n) / BUCKET)))
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree**bits))


def _hash(bits: int, tables: int, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            reps, copies = b.column(0).to_numpy(), b.column(1).to_numpy()
            vectors = b.column(2).to_pylist()
            size = np.array([len(v) for v in vectors])
            for dims in np.unique(size).tolist():
                if dims not in planes:
                    planes[dims] = np.random.Generator(np.random.PCG64(SEED + dims)).standard_normal((dims, bits * tables))
                own = np.flatnonzero(size == dims)
                x = np.array([vectors[k] for k in own], np.float64)
                if kind is np.float64:  # by a power of two, which no cosine depends on: squares neither overflow nor vanish
                    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
                sign = (x @ planes[dims] > 0).reshape(len(own), tables, bits)
                sig = (sign * (1 << np.arange(bits, dtype=np.int64))).sum(axis=2)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(own), t, np.int32)), pa.array(sig[:, t] * 65536 + dims % 65536), pa.array(reps[own]), pa.array(copies[own]), pa.array([v.tobytes() for v in x.astype(kind)], pa.binary()), pa.array([s[:t].astype(np.int32).tobytes() for s in sig], pa.binary())],
                        ["t", "key", "rep", "copies", "vec", "sig"],
                    )

    return run


def _links(threshold: float, kind: type):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        group = None
        for b in batches:  # sorted by bucket and pair of blocks
            for r in b.to_pylist():
                g = (r["t"], r["key"], r["i"], r["j"])
                if g != group and held:
                    yield from judged(held, threshold, kind)
                    held = []
                group = g
                held.append(r)
        if held:
            yield from judged(held, threshold, kind)

    return run


def judged(members: list[dict], threshold: float, kind: type) -> Iterator[pa.RecordBatch]:
    """Links and a spanning forest of one bucket, or of one pair of its blocks."""
    if len(members) < 2:
        return
    rep, copies = np.array([m["rep"] for m in members]), np.array([m["copies"] for m in members])
    x = np.array([np.frombuffer(m["vec"], kind) for m in members]).astype(np.float64)
    sig = np.array([np.frombuffer(m["sig"], np.int32) for m in members])
    block, i, j = np.array([m["block"] for m in members]), members[0]["i"], members[0]["j"]
    norm = np.sqrt((x * x).sum(axis=1))
    links, a, b = np.zeros(len(members), np.int64), [], []
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    for at in range(0, len(left), 512):
        rows = left[at : at + 512]
        cos = (x[rows] @ x[right].T) / (norm[rows][:, None] * norm[right][None, :])
        p, q = np.nonzero(cos >= threshold)
        p, q = rows[p], right[q]
        if i == j:
            p, q = p[p < q], q[p < q]
        for step in range(0, len(p), 1 << 18):  # those that met in an earlier table were counted there
            ps, qs = p[step : step + (1 << 18)], q[step : step + (1 << 18)]
            new = ~(sig[ps] == sig[qs]).any(axis=1) if sig.shape[1] else np.ones(len(ps), bool)
            ps, qs = ps[new], qs[new]
            np.add.at(links, ps, copies[qs])
            np.add.at(links, qs, copies[ps])
            if len(ps):
                nodes, root = common.fold_components(rep[ps], rep[qs])
                a.append(nodes)
                b.append(root)
    if not a:
        return
    nodes, root = common.fold_components(np.concatenate(a), np.concatenate(b))
    where = np.searchsorted(nodes, rep)
    where = np.minimum(where, len(nodes) - 1)
    yield common.rows(_MADE, rep, links, np.where(nodes[where] == rep, root[where], rep))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector of (vec_id, embedding)."""
    n_parts = common.partitions(vectors.sparkSession)
    v, back = common.apart(vectors.select("vec_id", "embedding"), "vec_id", "embedding")
    e = F.col("embedding")
    good = F.col("vec_id").isNotNull() & e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    key = [F.xxhash64(e).alias("k1"), F.xxhash64(F.lit(7), e).alias("k2")]
    usable = v.where(good)
    classes = common.stored(usable.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first(e).alias("embedding")), "vector-classes")
    kind = np.float64 if vectors.schema["embedding"].dataType.elementType.typeName() == "double" else np.float32
    bits, tables = shape(classes.count(), threshold)
    keyed = common.stored(classes.select("rep", "copies", "embedding").mapInArrow(_hash(bits, tables, kind), _KEYED), "vector-keys")
    # a bucket over the bound is split in s blocks; each member goes to the pairs that its block has
    full = keyed.groupBy("t", "key").count().where(F.col("count") > 1)
    s = F.ceil(F.col("count") / BLOCK).cast("int")
    dealt = keyed.join(full, ["t", "key"]).withColumn("s", s).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("s")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("s") - 1))).withColumn("i", F.least("o", "block")).withColumn("j", F.greatest("o", "block"))
    dealt = dealt.select("t", "key", "i", "j", "block", "rep", "copies", "vec", "sig").repartition(n_parts, "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    found = common.stored(dealt.mapInArrow(_links(threshold, kind), "rep long, links long, root long"), "vector-links")
    comp = common.components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    per = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = classes.join(per, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    known = known.select("k1", "k2", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = v.select("vec_id", good.alias("good"), *key).join(known.hint("merge"), ["k1", "k2"], "left")
    ok = F.coalesce("good", F.lit(False)) & F.col("rep").isNotNull()
    comp_id = F.when(ok, F.col("component_id")).otherwise(F.col("vec_id"))
    out = out.select("vec_id", F.when(ok, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"), comp_id.alias("component_id"))
    return back(out, "vec_id", "component_id").withColumn("kept", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))


OP3_SQL = r"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), fit AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM vectors
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.95
), reach AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id) JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) USING (vec_id)
"""
