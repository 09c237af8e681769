"""Token counts through the digest cache against the libraries themselves."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import common, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, digest string, n_tokens string, version int, k string, content string"


def docs(spark, rows):
    return spark.createDataFrame([(k, t, "d", "n", 1, "k", "c") for k, t in rows], SCHEMA).repartition(3)


def texts(seed=3):
    rng = random.Random(seed)
    w = ["the", "Engine", "naïve", "x1", "'s", "…", "日本語", " ", "<|endoftext|>", "a,b", "12.5", "  "]
    return [" ".join(rng.choice(w) for _ in range(rng.choice([1, 7, 300, 2000]))) for _ in range(60)]


def wanted(rows):
    model = Tokenizer.from_file(PATH)
    return sorted((str(k), len((t or "").encode()), (n := len(model.encode(t or "", add_special_tokens=False).ids)), n > 1024) for k, t in rows)


def found(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


def runs(spark, cache):
    return token_counts.open_cache(spark, cache).count()


def test_counts_and_cache(spark):
    cache = common.shared_dir(spark, "cache")
    some = texts()
    rows = list(enumerate([*some, some[0], some[0], None, "", " ", "tokens<|endoftext|>inside", "\r\n\t x"]))
    rows += [(5, some[1]), (5, "another text under that key"), (None, "no key"), (None, None)] + [(900, "hot copy")] * 200
    assert found(token_counts.count_tokens(docs(spark, rows), cache, PATH)) == wanted(rows)
    distinct = len({t or "" for _, t in rows})
    assert runs(spark, cache) == distinct
    # what is known is taken from the cache, whatever it says; what is new is appended
    assert found(token_counts.count_tokens(docs(spark, rows), cache, PATH)) == wanted(rows)
    assert runs(spark, cache) == distinct
    more = [*rows[10:40], (7000, "a text that the cache has never met")]
    assert found(token_counts.count_tokens(docs(spark, more), cache, PATH)) == wanted(more)
    assert runs(spark, cache) == distinct + 1
    # a content that stands there twice changes no row
    again = token_counts.open_cache(spark, cache).where(F.col("digest").isNotNull()).limit(9)
    common.stored(again, "again").write.mode("append").partitionBy("version").parquet(cache)
    assert found(token_counts.count_tokens(docs(spark, more), cache, PATH)) == wanted(more)


def test_results_come_from_the_cache_of_their_version(spark):
    cache = common.shared_dir(spark, "cache")
    rows = [(1, "one text"), (2, "another text")]
    false = spark.createDataFrame([(bytes.fromhex(h), 77, token_counts.tokenizer_version(PATH)) for (h,) in docs(spark, rows).select(F.sha2("text", 256)).collect()], token_counts.CACHE)
    token_counts.open_cache(spark, cache)
    false.write.mode("append").partitionBy("version").parquet(cache)
    assert [r[2] for r in found(token_counts.count_tokens(docs(spark, rows), cache, PATH))] == [77, 77]
    model = public_tokenizers.path("piece_bpe_32k.model")
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=model)
    got = token_counts.count_tokens(docs(spark, rows), cache, model)
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {k: len(own.encode(t)) for k, t in rows}


def test_both_ways_of_finding_missing_texts_agree(spark, monkeypatch):
    rows = list(enumerate(texts(9))) + [(1, "twice"), (2, "twice")]
    cache = common.shared_dir(spark, "cache")
    token_counts.count_tokens(docs(spark, rows[:20]), cache, PATH)
    monkeypatch.setattr(token_counts, "BROADCAST", 0)
    assert found(token_counts.count_tokens(docs(spark, rows), cache, PATH)) == wanted(rows)
    assert runs(spark, cache) == len({t for _, t in rows})


@pytest.mark.parametrize("seed", range(4))
def test_long_texts_in_parts(seed, monkeypatch):
    monkeypatch.setattr(token_counts, "LONG", 150)
    counter, model = token_counts.Counter(PATH), Tokenizer.from_file(PATH)
    some = [*texts(seed), "x" * 5000, "a  b" * 900, "it's  a's " * 300, "wörd bé " * 400]
    assert counter.count(some) == [len(model.encode(t, add_special_tokens=False).ids) for t in some]
    assert max(len(counter.parts(t)) for t in some) > 5


def test_normalised_content_meets_one_count(spark):
    word = public_tokenizers.path("word_bpe_49k.json")
    cache = common.shared_dir(spark, "cache")
    rows = [(1, "Some Words"), (2, "some words"), (3, "SOME WORDS")]
    got = token_counts.count_tokens(docs(spark, rows), cache, word, normalise=F.lower).collect()
    assert len({r.n_tokens for r in got}) == 1 and runs(spark, cache) == 1


def test_empty_table(spark):
    cache = common.shared_dir(spark, "cache")
    got = token_counts.count_tokens(spark.createDataFrame([], SCHEMA), cache, PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and got.count() == 0 and runs(spark, cache) == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(token_counts.op13_token_counts(spark, "/root/testdata/sf0.001")) == wanted(rows)
