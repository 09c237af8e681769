"""Exact top-k search by no-random-access aggregation (operator 2).

Candidates lie in blocks.  A block keeps, for every dimension, its vectors sorted by that
component.  A query reads the lists front to back, each from the end at which the product with
its own component is greatest, a stretch of all lists at a time.  What was read gives each
candidate a lower bound (unread products at their least) and an upper bound (unread products at
what their list has reached).  Reading stops when no candidate outside the k best lower bounds
can qualify any more; the lists are then read on for those that can, until each has shown them all,
so that every score is a sum of products read from lists.

The queries are a stated part of the rows: blocks of them are sent once to every block of
candidates, one partition a block.  Each pair returns k rows a query, and a limited window keeps k.

Vectors that are null or hold null or non-finite components take no part, neither do null ids;
shorter vectors count as followed by zeros; a repeated row is a candidate again, but a query is
never its own candidate, by id; ties go to the smaller id; an empty table gives no rows; other
columns are ignored.  All sums are of 64-bit integers; where a score might not fit them an error says
so.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm import common

TOP = 10
SCALE = 1024
BLOCK = 2048
QUERY_BLOCK = 512
#: Depths, as parts of the lists, at which bounds are compared.
STOPS = (1 / 4, 1 / 2, 3 / 4, 1)


class SortedLists:
    """The lists of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.n, self.dims = x.shape
        up = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        self.order = [up, np.ascontiguousarray(up[:, ::-1])]  # by direction: least first, greatest first
        self.value = [np.take_along_axis(x.T, o, axis=1) for o in self.order]
        place = np.empty(x.shape, np.int32)
        np.put_along_axis(place, up.T, np.arange(self.n, dtype=np.int32)[:, None], axis=0)
        self.place = place  # at what depth a list, least first, shows a candidate

    def search(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(positions, scores, depth at which outsiders were out) of the k best candidates."""
        if self.n and np.abs(q.astype(float)) @ np.abs(self.x.astype(float)).max(axis=0) >= 2.0**63:
            raise OverflowError("scores of these vectors do not fit 64 bits")
        down = q > 0
        sides = [(side, np.flatnonzero(down == side)) for side in (0, 1)]
        at = lambda column: np.where(down, self.value[1][:, column], self.value[0][:, column])
        worst = q * at(-1)
        # a list that is read from its other end has shown what stands from n - depth on
        known = np.zeros(self.n, np.int64)  # sums of products that were read
        alive = np.flatnonzero(self.ids != own)
        depth = 0
        for part in STOPS:
            to = max(depth, int(np.ceil(self.n * part)))
            if to == depth or len(alive) <= k:
                continue
            for side, dims in sides:
                for d in dims.tolist():
                    known[self.order[side][d, depth:to]] += q[d] * self.value[side][d, depth:to]
            depth = to
            if depth == self.n:
                break
            # unread products lie between their list's end and what it has reached: sums of both
            # by the bits of the lists that haven't shown a candidate, a table for each byte
            place = self.place[alive]
            unread = np.packbits((place < np.where(down, self.n - depth, depth).astype(np.int32)) ^ ~down, axis=1, bitorder="little").T
            reached = q * at(depth - 1)
            lower, upper = known[alive], known[alive]
            for b, bits in enumerate(unread):
                on = _BITS[:, : len(worst[b * 8 : b * 8 + 8])]
                lower += (on @ worst[b * 8 : b * 8 + 8])[bits]
                upper += (on @ reached[b * 8 : b * 8 + 8])[bits]
            kth = np.partition(lower, len(lower) - k)[len(lower) - k]
            alive = alive[upper >= kth]  # an equal score may still win by its id
            if len(alive) <= 4 * k:
                break
        if depth < self.n:  # resolve: the rest of each list, of which only the candidates count
            wanted = np.zeros(self.n, bool)
            wanted[alive] = True
            for side, dims in sides:
                for d in dims.tolist():
                    order = self.order[side][d, depth:]
                    shown = np.flatnonzero(wanted[order])
                    known[order[shown]] += q[d] * self.value[side][d, depth:][shown]
        score = known[alive]
        best = np.lexsort((self.ids[alive], -score))[:k]
        return alive[best], score[best], depth


#: The bits of each byte, least first.
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def scaled(column: pa.Array, dims: int | None = None) -> np.ndarray:
    rows = column.to_pylist()
    dims = max([len(r) for r in rows], default=0) if dims is None else dims
    x = np.zeros((len(rows), dims))
    for k, r in enumerate(rows):
        x[k, : len(r)] = r
    x = np.floor(SCALE * x)
    if (np.abs(x) >= 2.0**62).any():
        raise OverflowError("scaled components do not fit 64 bits")
    return x.astype(np.int64)


_PACKED = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("x", pa.binary())])


def _pack(dims: int):
    """One row for each block number of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}
        for b in batches:
            block, ids, x = b.column(0).to_numpy(), b.column(1).to_numpy(), scaled(b.column(2), dims)
            for k in np.unique(block):
                parts.setdefault(int(k), []).append((ids[block == k], x[block == k]))
        for k, own in parts.items():
            ids, x = np.concatenate([o[0] for o in own]), np.concatenate([o[1] for o in own])
            yield common.rows(_PACKED, [k], [len(ids)], [ids.astype(np.int64).tobytes()], [x.tobytes()])

    return run


def usable(vectors: DataFrame) -> DataFrame:
    e = F.col("embedding")
    good = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & e.isNotNull() & good)


def top_k(vectors: DataFrame, is_query, k: int = TOP, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) for the vectors (vec_id, embedding) that ``is_query`` picks."""
    v = usable(vectors)
    n, dims, queries = v.agg(F.count("*"), F.max(F.size("embedding")), F.count_if(is_query)).first()
    blocks, q_blocks = max(1, -(-n // block)), max(1, -(-(queries or 0) // query_block))
    pack = lambda d, m: common.exchange(d.select(F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int").alias("block"), "vec_id", "embedding"), m, "block").mapInArrow(_pack(dims or 0), "block int, n int, ids binary, x binary")
    c = pack(v, blocks).withColumn("query", F.lit(0))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    q = pack(v.where(is_query), q_blocks).select(every.alias("block"), "n", "ids", "x", F.lit(1).alias("query"))
    made = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = None
        for b in batches:
            for r in b.to_pylist():
                ids, x = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["x"], np.int64).reshape(r["n"], -1)
                if not r["query"]:  # the block's candidates come first
                    block, lists = r["block"], SortedLists(ids, x)
                elif lists is not None and block == r["block"]:
                    out: list[list] = [[], [], []]
                    for own, y in zip(ids.tolist(), x, strict=True):
                        at, score, _ = lists.search(y, own, k)
                        out[0] += [own] * len(at)
                        out[1] += lists.ids[at].tolist()
                        out[2] += score.tolist()
                    yield common.rows(made, *out)

    found = common.exchange(c.unionByName(q), blocks, "block").sortWithinPartitions("block", "query").select("block", "n", "ids", "x", "query")
    found = found.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
