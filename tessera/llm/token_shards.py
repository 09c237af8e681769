"""Token-ID / binary output: shards of raw ids with a minimal perfect hash index (operator 9).

Shard files, all little-endian, in one folder of any file system that Arrow opens:

``shard-NNNNN.ids``    raw ids, ``width`` bytes each, documents one after another
``shard-NNNNN.idx``    header (magic, version, width, documents, keys, levels), then the keys
                       in order, their null flags, document starts (n + 1), the bit arrays of
                       the hash function, and per slot a 32-bit fingerprint and the ordinal
``manifest.json``      per shard: documents, ids, ids before it

Documents stand in ascending key order, over all shards.  A key is found in constant time: the
levels of the hash function give a slot, the fingerprint turns away strangers, the ordinal gives
the place of the ids.

A manifest's line also has the first and last key of its shard, so that a lookup asks one shard.

Defined results: a null text is an empty document; a null key comes last and is read by ordinal
only; rows that repeat a key stand in the order of a hash of their texts, all are stored, and the
first in a shard is the keyed one.  Other columns, whatever their names, are ignored.  An empty
table gives no shard with documents.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, kernels

MAGIC, VERSION = b"TSRS", 1
HEADER = struct.Struct("<4sIIQQI")
#: Bits of a level for each key that is left, as BBHash has it.
GAMMA = 2
#: Ids of that many units are remembered by a worker; beyond it starts afresh.
REMEMBERED = 3_000_000


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys by levels of bit arrays (Limasset et al. 2017)."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.rank = []
        base = 0
        for bits in levels:
            r = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)]) + base
            self.rank.append(r)
            base = int(r[-1])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        return (kernels.mix(keys.astype(np.uint64) ^ seed) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left):
            size = max(8, GAMMA * len(left))
            at = cls._place(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level takes it."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            at = self._place(keys[left], k, len(bits))
            hit = bits[at]
            out[left[hit]] = self.rank[k][at[hit]]
            left = left[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (kernels.mix(keys.astype(np.uint64) ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32)


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def _put(fs, path: str, data: bytes) -> None:
    """Written under another name and moved, so that a repeated task never leaves half a file."""
    ctx = TaskContext.get()
    tmp = f"{path}.{ctx.taskAttemptId() if ctx else os.getpid()}.tmp"
    with fs.open_output_stream(tmp) as out:
        out.write(data)
    fs.move(tmp, path)


class Encoder:
    """Ids of texts by a tokenizers file, one distinct unit at a time.

    A unit is a word between white space or, in words that have nothing but ASCII (no apostrophe,
    no "<") and Latin-1 letters, a run of letters or of other characters in it, for there the
    pre-tokenizer cuts too.  It suits tokenizers whose pre-tokenizer drops white space and cuts
    letters from other characters and whose normalizer lowers case, as ``word_bpe_49k.json``;
    then the ids of a text are those of its units, one after another.  Ids of units that were met
    are kept in sorted arrays, some 30 bytes a unit.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        self.roll = kernels.Rolling(901)
        self.keys, self.begin, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.flat = np.zeros(0, f"<u{self.width}")
        letter = np.zeros(256, bool)
        letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
        self.ascii_letter = letter
        self.odd = np.zeros(256, bool)
        self.odd[[0x27, 0x3C, *range(0x80, 0x100)]] = True

    def units(self, off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, row, whether it is a run of letters) of each unit."""
        start, end, row = kernels.words(off, raw)
        if not len(start):
            return start, end, row, np.zeros(0, bool)
        odd = self.odd[raw]
        lead = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] < 0xC0) & ((raw[1:] & 0xDF) != 0x97) if len(raw) > 1 else np.zeros(0, bool))
        letter = self.ascii_letter[raw]
        odd[lead] = odd[lead + 1] = False
        letter[lead] = letter[lead + 1] = True
        sums = np.concatenate([[0], np.cumsum(odd, dtype=np.int32)])
        plain = sums[end] == sums[start]
        inside = np.zeros(len(raw) + 1, np.int8)  # of a plain word, behind its first byte
        inside[start[plain] + 1] += 1
        inside[end[plain]] -= 1
        change = np.flatnonzero((np.cumsum(inside[:-1]) > 0) & (letter != np.concatenate([letter[:1], letter[:-1]])))
        starts = np.sort(np.concatenate([start, change]))
        at = np.searchsorted(start, starts, side="right") - 1
        ends = np.append(starts[1:], end[-1])
        ends = np.minimum(ends, end[at])
        return starts, ends, row[at], plain[at] & letter[starts]

    def _encode_new(self, data: bytes, s: np.ndarray, e: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, where each unit's begin, how many it has)."""
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        runs, rest = np.flatnonzero(letters), np.flatnonzero(~letters)
        flat, sizes = [], []
        for at in range(0, len(runs), 64 * 100):  # many runs as one text: each ends in one id that ends a word
            part = runs[at : at + 64 * 100].tolist()
            lines = [" ".join([texts[k] for k in part[i : i + 64]]) for i in range(0, len(part), 64)]
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(lines, add_special_tokens=False)])
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(part):
                raise ValueError("this tokenizer doesn't end each run of letters by one id")
            flat.append(ids)
            sizes.append(np.diff(cut, prepend=0))
        for at in range(0, len(rest), 10_000):
            got = [x.ids for x in self.tokenizer.encode_batch_fast([texts[k] for k in rest[at : at + 10_000].tolist()], add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in got], np.int64))
            flat.append(np.fromiter(chain.from_iterable(got), np.uint32, int(sizes[-1].sum())))
        size = np.concatenate(sizes)
        begin, length = np.empty(len(s), np.int64), np.empty(len(s), np.int32)
        order = np.concatenate([runs, rest])
        begin[order], length[order] = np.cumsum(size) - size, size
        return np.concatenate(flat), begin, length

    def encode(self, off: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids by document)."""
        start, end, row, letters = self.units(off, raw)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(off) - 1, np.int64)
        low = kernels.ASCII_LOWER[raw]
        h = self.roll.spans(self.roll.prefix(low), start, end)
        uniq, first, inv = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        if not known.all():
            if len(self.keys) > REMEMBERED:
                self.keys, self.begin, self.length, self.flat = self.keys[:0], self.begin[:0], self.length[:0], self.flat[:0]
                known[:] = False
            new = np.flatnonzero(~known)
            ids, begin, length = self._encode_new(raw.tobytes(), start[first[new]], end[first[new]], letters[first[new]])
            begin += len(self.flat)
            self.flat = np.concatenate([self.flat, ids.astype(self.flat.dtype)])
            where = np.searchsorted(self.keys, uniq[new])
            self.keys, self.begin, self.length = np.insert(self.keys, where, uniq[new]), np.insert(self.begin, where, begin), np.insert(self.length, where, length)
            at = np.searchsorted(self.keys, uniq)
        length = self.length[at].astype(np.int64)
        ids = self.flat[kernels.ragged(self.begin[at][inv], length[inv])].astype(np.uint32)
        return ids, np.bincount(row, weights=length[inv], minlength=len(off) - 1).astype(np.int64)


def encoder(path: str) -> Encoder:
    return common.resident(("encoder", path), lambda: Encoder(path))


def _write_shard(fs, path: str, shard: int, keys: np.ndarray, null: np.ndarray, counts: np.ndarray, width: int) -> None:
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    distinct, ordinal = np.unique(keys[~null], return_index=True)
    ordinal = np.flatnonzero(~null)[ordinal]
    h = PerfectHash.build(distinct)
    slot = h.slots(distinct)
    prints, ordinals = np.zeros(len(distinct), np.uint32), np.zeros(len(distinct), np.int64)
    prints[slot], ordinals[slot] = fingerprint(distinct), ordinal
    sizes = np.array([len(x) for x in h.levels], np.int64)
    parts = [HEADER.pack(MAGIC, VERSION, width, len(keys), len(distinct), len(h.levels)), keys.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(), starts.tobytes(), sizes.tobytes()]
    parts += [np.packbits(x).tobytes() for x in h.levels] + [prints.tobytes(), ordinals.tobytes()]
    _put(fs, f"{path}/shard-{shard:05d}.idx", b"".join(parts))


class Shard:
    """Keyed access to one shard; ids are read where they are asked for."""

    def __init__(self, uri: str, shard: int):
        fs, path = _open(uri)
        with fs.open_input_file(f"{path}/shard-{shard:05d}.idx") as f:
            data = f.read()
        magic, version, self.width, n, m, levels = HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError(f"not a shard index: {uri} {shard}")
        at = HEADER.size

        def take(dtype, count):
            nonlocal at
            out = np.frombuffer(data, dtype, count, at)
            at += out.nbytes
            return out

        self.keys, self.null, self.starts = take("<i8", n), take(np.uint8, n).astype(bool), take("<i8", n + 1)
        sizes = take("<i8", levels)
        self.hash = PerfectHash([np.unpackbits(take(np.uint8, (s + 7) // 8), count=s).astype(bool) for s in sizes.tolist()])
        self.prints, self.ordinals = take("<u4", m), take("<i8", m)
        self.payload = fs.open_input_file(f"{path}/shard-{shard:05d}.ids")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ordinal of each key, -1 for a key that isn't there."""
        keys = np.asarray(keys, np.int64)
        slot = self.hash.slots(keys)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == fingerprint(keys[ok])
        out = np.full(len(keys), -1, np.int64)
        out[ok] = self.ordinals[slot[ok]]
        ok[ok] = self.keys[out[ok]] == keys[ok]
        out[~ok] = -1
        return out

    def read(self, ordinal: int) -> np.ndarray:
        a, b = int(self.starts[ordinal]), int(self.starts[ordinal + 1])
        return np.frombuffer(self.payload.read_at((b - a) * self.width, a * self.width), f"<u{self.width}")

    def get(self, key: int) -> np.ndarray | None:
        o = int(self.find(np.array([key]))[0])
        return None if o < 0 else self.read(o)


def write_token_shards(docs: DataFrame, uri: str, tokenizer: str, end_id: int = 1, n_shards: int | None = None, key: str = "doc_id", text: str = "text") -> list[dict]:
    """Encode every whole text, end each with ``end_id`` and write shards in ascending key order.

    One range exchange orders the documents; each task streams its part into one shard.  What
    comes back to the driver is a line per shard, written as the manifest.
    """
    spark = docs.sparkSession
    n = n_shards or common.partitions(spark)
    fs, path = _open(uri)
    fs.create_dir(path, recursive=True)
    order = [F.col("k").asc_nulls_last(), F.xxhash64("t")]  # documents without a key, or of one key, go to several shards
    ordered = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).repartitionByRange(n, *order).sortWithinPartitions(*order)
    made = pa.schema([("shard", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        shard, fs, path, enc = ctx.partitionId(), *_open(uri), None
        keys, nulls, counts = [], [], []
        tmp, out = f"{path}/shard-{shard:05d}.ids.{ctx.taskAttemptId()}.tmp", None
        for batch in batches:
            if not batch.num_rows:
                continue
            if enc is None:
                enc, out = encoder(tokenizer), fs.open_output_stream(tmp)
            k = batch.column(0)
            nulls.append(k.is_null().to_numpy(zero_copy_only=False))
            keys.append(k.fill_null(0).to_numpy(zero_copy_only=False))
            for _, _, off, raw in kernels.pieces(batch.column(1)):
                ids, count = enc.encode(off, raw)
                whole = np.full(len(ids) + len(count), end_id, np.uint32)
                ends = np.cumsum(count + 1) - 1
                rest = np.ones(len(whole), bool)
                rest[ends] = False
                whole[rest] = ids
                out.write(whole.astype(f"<u{enc.width}").tobytes())
                counts.append(count + 1)
        if out is not None:
            out.close()
            fs.move(tmp, f"{path}/shard-{shard:05d}.ids")
            count, key, null = np.concatenate(counts), np.concatenate(keys), np.concatenate(nulls)
            _write_shard(fs, path, shard, key, null, count, enc.width)
            keyed = key[~null]
            yield common.rows(made, [shard], [len(count)], [int(count.sum())], [int(keyed[0]) if len(keyed) else None], [int(keyed[-1]) if len(keyed) else None])

    lines = sorted((r.asDict() for r in ordered.mapInArrow(run, "shard long, docs long, ids long, first long, last long").collect()), key=lambda r: r["shard"])
    base = 0
    for r in lines:
        r["base"], base = base, base + r["ids"]
    _put(fs, f"{path}/manifest.json", json.dumps(lines).encode())
    return lines


def manifest(uri: str) -> list[dict]:
    fs, path = _open(uri)
    with fs.open_input_file(f"{path}/manifest.json") as f:
        return json.loads(f.read())


def read_token_shards(spark: SparkSession, uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files by keyed access.

    Every key goes through the hash function, its fingerprint and the ordinal in its slot; a key that
    is not found that way is an error.  Documents without a key, and further ones of a key, have no
    slot and are read by their place.
    """
    lines = manifest(uri)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    todo = spark.createDataFrame([(r["shard"], r["base"]) for r in lines], "shard long, base long")
    made = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = Shard(uri, shard)
                keyed = ~s.null
                keyed[1:] &= (s.keys[1:] != s.keys[:-1]) | s.null[:-1]
                ordinal = np.arange(len(s.keys))
                ordinal[keyed] = s.find(s.keys[keyed])
                if (ordinal < 0).any():
                    raise ValueError(f"the index of shard {shard} doesn't find {int((ordinal < 0).sum())} of its keys")
                crc = [zlib.crc32(s.read(o).astype("<u4").tobytes()) for o in ordinal.tolist()]
                yield common.rows(made, pa.array(s.keys, mask=s.null), s.starts[ordinal] + base, s.starts[ordinal + 1] - s.starts[ordinal], crc)

    return todo.repartition(max(1, len(lines)), "shard").mapInArrow(run, schema)


def lookup(keys: DataFrame, uri: str, key: str = "doc_id") -> DataFrame:
    """(key, ids) of the keys that the shards have; others, and null, give no row.

    Keys are sent to the shard whose range holds them, by a manifest of a line a shard, in slices of
    a shard's keys; equal keys meet once.
    """
    lines = [r for r in manifest(uri) if r["first"] is not None]
    spark = keys.sparkSession
    if not lines:
        return spark.createDataFrame([], f"`{key}` long, ids array<long>")
    # of shards that begin with the same key the first has the keyed document
    firsts = F.array(*[F.lit(r["first"]).cast("long") for r in lines])
    at = F.size(F.filter(firsts, lambda x: x < F.col("k")))
    wanted = keys.select(F.col(key).cast("long").alias("k")).where("k is not null").distinct().withColumn("at", at)
    tries = wanted.select("k", F.explode(F.array("at", F.col("at") + 1)).alias("line")).where((F.col("line") >= 1) & (F.col("line") <= len(lines)))
    shards = [r["shard"] for r in lines]
    made = pa.schema([("k", pa.int64()), ("line", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Shard] = {}
        for batch in batches:
            k, line = (batch.column(c).to_numpy() for c in (0, 1))
            for one in np.unique(line).tolist():
                if one not in held:
                    held = {one: Shard(uri, shards[one - 1])}
                mine = k[line == one]
                found = held[one].find(mine)
                ids = [held[one].read(o).astype(np.int64) for o in found[found >= 0].tolist()]
                yield common.rows(made, mine[found >= 0], np.full(len(ids), one), pa.array(ids, pa.list_(pa.int64())))

    slices = tries.repartition(common.partitions(spark), "line", F.pmod(F.xxhash64("k"), F.lit(8))).sortWithinPartitions("line")
    found = slices.select("k", F.col("line").cast("long").alias("line")).mapInArrow(run, "k long, line long, ids array<long>")
    return found.groupBy("k").agg(F.min_by("ids", "line").alias("ids")).withColumnRenamed("k", key)


def op9_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    uri = common.shared_dir(spark, "token-shards")
    write_token_shards(common.table(spark, sf_dir, "documents"), uri, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_shards(spark, uri)
