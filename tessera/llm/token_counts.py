"""Token counts by a digest cache (operator 13).

The cache is a folder of Parquet runs, one sub-folder for each tokenizer version.  A run holds
(digest of normalised content, number of tokens).  Counting joins the digests of a batch with the
runs of its version, encodes each distinct content that is missing once, appends those counts as a
run, and reads every count of the batch back from the cache.  A version is a digest of the
tokenizer's file, its library and that library's release, so that another file or release never
meets counts that it didn't make.

A run is committed as a whole by Spark's writer: a job that fails leaves none, and a repeated one
encodes what is still missing.  Two jobs that append the same content at once leave it twice, which
changes no result.

Defined results: a null text is an empty one, with 0 bytes and tokens; a null key stays, and rows
that repeat a key or a text each get their row; a text of any length is encoded whole; other
columns, whatever their names, are ignored; an empty table gives no rows and leaves the cache as it is.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from importlib.metadata import version as release

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

CACHE = "digest binary, n_tokens long, version string"
#: Fewer missing digests than this (32 bytes each, so 3 MB) are broadcast, and texts that the cache knows are never shuffled.
BROADCAST = 100_000
#: Texts over this many characters are encoded in parts, cut where the pre-tokenizer cuts anyway.
LONG = 1 << 20
#: A byte-level pre-tokenizer ends a piece between a letter and one space with a letter behind it.
BYTE_LEVEL_CUT = r"(?<=[A-Za-z])(?= [A-Za-z])"


def tokenizer_version(path: str) -> str:
    """Digest of the file, its library and the release of that."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    h = hashlib.sha256(f"{library} {release(library)}\n".encode())
    with open(path, "rb") as f:
        for part in iter(lambda: f.read(1 << 20), b""):
            h.update(part)
    return h.hexdigest()


class Counter:
    """Numbers of tokens, without begin, end or added special tokens, by the library of the file."""

    def __init__(self, path: str):
        self.cut = None
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=path)
            self.sizes = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer, normalizers, pre_tokenizers

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.sizes = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
            pre, spaced = model.pre_tokenizer, any(" " in t.content for t in model.get_added_tokens_decoder().values())
            if isinstance(pre, pre_tokenizers.ByteLevel) and pre.use_regex and not isinstance(model.normalizer, normalizers.Normalizer) and not spaced:
                self.cut = re.compile(BYTE_LEVEL_CUT)

    def parts(self, text: str) -> list[str]:
        """A long text in parts whose counts add up to its own; one part where nothing is sure to."""
        if self.cut is None or len(text) <= LONG:
            return [text]
        out, begin = [], 0
        while len(text) - begin > LONG and (m := self.cut.search(text, begin + LONG)):
            out.append(text[begin : m.start()])
            begin = m.start()
        return [*out, text[begin:]]

    def count(self, texts: list[str]) -> list[int]:
        out, at = [0] * len(texts), 0
        while at < len(texts):  # about a million characters at a time: encodings are large
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= LONG):
                size += len(texts[end])
                end += 1
            if end == at + 1:
                out[at] = sum(self.sizes([p])[0] for p in self.parts(texts[at]))
            else:
                out[at:end] = self.sizes(texts[at:end])
            at = end
        return out


def open_cache(spark: SparkSession, uri: str) -> DataFrame:
    """The rows of a cache, which begins empty."""
    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(uri)
    return spark.read.schema(CACHE).parquet(uri)


def _encoded(texts: DataFrame, tokenizer: str) -> DataFrame:
    made = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = common.resident(("counter", tokenizer), lambda: Counter(tokenizer))
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield common.rows(made, part.column(0).cast(pa.binary()), counter.count(part.column(1).to_pylist()))
        common.trim()

    return texts.mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, cache: str, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 1024, normalise: Callable[[Column], Column] | None = None) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of each row, the counts through the cache in ``cache``.

    ``normalise`` makes texts alike that the tokenizer's own normaliser makes alike; the count is
    that of what it returns, the bytes those of the text itself.

    Digests of a batch are grouped with partial sums, so that copies meet as partial rows.  Of every
    missing content one text is shuffled, after each task has dropped its own repeats.  The counts go
    back by a join of narrow rows, both sides read from files, which Spark splits where a digest is hot.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    whole = F.coalesce(F.col(text), F.lit(""))
    content = whole if normalise is None else normalise(whole)
    digest = F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest")
    marks = common.stored(docs.select(F.col(key).alias("k"), F.octet_length(whole).cast("long").alias("n_bytes"), digest), "digests")
    distinct = marks.select("digest").distinct()
    known = open_cache(spark, cache).where(F.col("version") == version)
    missing = common.stored(distinct.join(known, "digest", "left_anti"), "missing")
    n = missing.count()
    if n:
        texts = docs.select(digest, content.alias("content"))
        if n <= BROADCAST:
            texts = texts.join(F.broadcast(missing), "digest", "left_semi")
        texts = texts.groupBy("digest").agg(F.first("content").alias("content"))
        if n > BROADCAST:
            texts = texts.join(missing, "digest", "left_semi")
        _encoded(texts, tokenizer).withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(cache)
    known = open_cache(spark, cache).where(F.col("version") == version)
    counts = common.stored(distinct.join(known, "digest").groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")), "counts")
    out = marks.join(counts, "digest", "left")
    return out.select(F.col("k").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(common.table(spark, sf_dir, "documents"), common.shared_dir(spark, "token-counts"), public_tokenizers.path("byte_bpe_50k.json"))
