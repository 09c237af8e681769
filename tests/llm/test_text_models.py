"""Tokens, pieces, languages, search, mixing and the pipeline."""

import random
import zlib
from collections import Counter

import duckdb
import heapq
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from tessera.llm import common, kernels, language_id, lattice, mixing, queries, sentencepiece_nbest, token_shards, topk_nra  # noqa: E402

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "don't stop's 'tis it's", "a<|endoftext|>b <|startoftext|>", "É≠ x́y naïve×3÷4 ²½ …—- a—-b", "　abc\xa0def 日本語 текст", "x" * 3000, "A1b2,c.d", "ÀÉ ÿþ ß\x0bq\x1cz\x85t", "🙂a🙂,b",
    "\x00\x01 \x7f", "  two  spaces \n\n and\tmore\n", "▁literal mark", "word " * 2000,
]


def docs(spark, texts, keys=None, extra="ids string, score double, start long, size long"):
    keys = list(range(len(texts))) if keys is None else keys
    return spark.createDataFrame([(k, t, "x", 0.5, 1, 2) for k, t in zip(keys, texts, strict=True)], f"doc_id long, text string, {extra}").repartition(3)


# ---- token shards


def plain_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_token_shards(spark):
    keys = [7 * k - 40 for k in range(len(ODD))]
    uri = common.shared_dir(spark, "test-shards")
    lines = token_shards.write_token_shards(docs(spark, ODD, keys), uri, public_tokenizers.path("word_bpe_49k.json"), n_shards=3)
    got = {r.doc_id: r for r in token_shards.read_token_shards(spark, uri).collect()}
    start = 0
    for k, t in zip(keys, ODD, strict=True):
        ids = plain_ids(t)
        assert (got[k].start, got[k].n_tokens, got[k].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t
        start += len(ids)
    found = {}
    for line in lines:
        s = token_shards.Shard(uri, line["shard"])
        found |= {k: s.get(k).tolist() for k in keys if s.get(k) is not None}
        assert s.get(10**12) is None
    assert found == {k: plain_ids(t) for k, t in zip(keys, ODD, strict=True)}


def test_token_shards_with_null_and_repeated_keys(spark):
    uri = common.shared_dir(spark, "test-shards")
    token_shards.write_token_shards(docs(spark, ["a", "b c", "b c", "d"], [5, 1, 1, None]), uri, public_tokenizers.path("word_bpe_49k.json"), n_shards=1)
    assert [(r.doc_id, r.start, r.n_tokens) for r in token_shards.read_token_shards(spark, uri).orderBy("start").collect()] == [(1, 0, 3), (1, 3, 3), (5, 6, 2), (None, 8, 2)]
    uri = common.shared_dir(spark, "test-shards")
    assert token_shards.write_token_shards(docs(spark, []), uri, public_tokenizers.path("word_bpe_49k.json")) == [] and token_shards.read_token_shards(spark, uri).count() == 0


def test_token_shards_of_one_key_with_different_texts(spark):
    """The order within a key doesn't hang on how the rows come in; copies of it may fill several shards."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["one", "one two", "one two three", None, "one", "", "four five"] * 3
    keys = [9] * 12 + [None] * 5 + [3, 4, 10, 9]
    tables = []
    for order in (1, -1):
        uri = common.shared_dir(spark, "test-shards")
        token_shards.write_token_shards(docs(spark, texts[::order], keys[::order]), uri, path, n_shards=5)
        tables.append([tuple(r) for r in token_shards.read_token_shards(spark, uri).orderBy("start").collect()])
    assert tables[0] == tables[1] and len(tables[0]) == len(keys)
    assert [r[0] for r in tables[0]] == sorted((k for k in keys if k is not None)) + [None] * 5
    found = {r.doc_id: r.ids for r in token_shards.lookup(spark.createDataFrame([(k,) for k in (3, 4, 9, 10, 11, -5, 9, None)], "doc_id long"), uri).collect()}
    assert set(found) == {3, 4, 9, 10} and all(found[k] == plain_ids(texts[keys.index(k)]) for k in (3, 4, 10))
    assert zlib.crc32(np.array(found[9], "<u4").tobytes()) == next(r[3] for r in tables[1] if r[0] == 9)


@pytest.mark.parametrize("part", ["prints", "ordinals", "hash"])
def test_a_spoiled_index_is_an_error(spark, part):
    """What comes out comes through the hash function, its fingerprints and its ordinals."""
    import pathlib

    uri = common.shared_dir(spark, "test-shards")
    token_shards.write_token_shards(docs(spark, ["a", "b c", "d e f"], [5, 1, 3]), uri, public_tokenizers.path("word_bpe_49k.json"), n_shards=1)
    assert token_shards.read_token_shards(spark, uri).count() == 3
    s = token_shards.Shard(uri, 0)
    file = pathlib.Path(uri.removeprefix("file://")) / "shard-00000.idx"
    data = bytearray(file.read_bytes())
    tail = len(s.prints) * 12
    bits = sum((len(x) + 7) // 8 for x in s.hash.levels)
    begin, end = {"prints": (tail, tail - 4 * len(s.prints)), "ordinals": (tail - 4 * len(s.prints), 0), "hash": (tail + bits, tail)}[part]
    if part == "ordinals":
        data[len(data) - begin :] = data[len(data) - 8 :] + data[len(data) - begin : len(data) - 8]  # turned by one
    else:
        for k in range(len(data) - begin, len(data) - end):
            data[k] = 0 if part == "hash" else data[k] ^ 0xFF
    file.write_bytes(bytes(data))
    with pytest.raises(Exception, match="doesn't find|index"):
        token_shards.read_token_shards(spark, uri).collect()


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 5000))
    h = token_shards.PerfectHash.build(keys)
    assert sorted(h.slots(keys).tolist()) == list(range(len(keys)))


# ---- pieces


def plain_nbest(s, text, n):
    """The n best scores of the whole text's lattice, by a table of the n best of each prefix."""
    b, v = text.encode(), s.v
    best = [[] for _ in range(len(b) + 1)]
    best[0] = [0.0]
    for j in range(1, len(b) + 1):
        got = []
        for k in range(max(0, j - v.longest), j):
            piece = s.table.get(b[k:j], -1)
            if piece < 0 and j - k == 1:
                piece = int(v.byte_ids[b[k]])
            if piece >= 0:
                got += [x + float(v.score[piece]) for x in best[k]]
        best[j] = heapq.nlargest(n, got)
    return best[-1]


def test_sentencepiece_nbest_against_a_whole_lattice(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    s = sentencepiece_nbest.Segmenter(path)
    texts = [t for t in ODD if t is None or len(t) < 2500]
    got = {r.doc_id: r for r in sentencepiece_nbest.decode(sentencepiece_nbest.encode(docs(spark, texts).drop("ids"), path, 4), path).collect()}
    for k, t in enumerate(texts):
        assert got[k].decoded == t
        if t is None:
            assert got[k].ids is None
            continue
        assert got[k].nbest_scores == plain_nbest(s, t, 4), t
        ways = [got[k].ids, *got[k].nbest_ids]
        assert [sum(float(s.v.score[i]) for i in w) for w in ways] == got[k].nbest_scores and len({tuple(w) for w in ways}) == len(ways)
        assert all(s.decode(np.array(w, np.int32)).decode() == t for w in ways)
    assert sentencepiece_nbest.encode(docs(spark, []), path).count() == 0


def test_sentencepiece_uses_pieces_that_cross_words():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    of = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            of[model.id_to_piece(i).replace("▁", " ").encode()] = model.get_score(i)
    longest, least = max(map(len, of)), min(of.values()) - 10
    s = sentencepiece_nbest.Segmenter(path)
    texts = ["if x:\n    y", "x = 1;\r\n  return x", "a" + " " * 40 + "b  c", "f();\r\n\r\n}\r", "   ", " \r\t\t x", "", "\x01 \x02", "y  ", "  z"]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    off, ids, scores, others = s.encode(np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]), raw, 3)
    for k, t in enumerate(texts):
        b, best = t.encode(), [[0.0]]
        for j in range(1, len(b) + 1):
            pieces = [(a, of.get(b[a:j], least if j - a == 1 else None)) for a in range(max(0, j - longest), j)]
            best.append(heapq.nlargest(3, [x + w for a, w in pieces if w is not None for x in best[a]]))
        assert scores[k] == best[-1], t
        ways = [ids[off[k] : off[k + 1]], *others[k]]
        assert [sum(float(s.v.score[i]) for i in w) for w in ways] == scores[k] and all(s.decode(np.asarray(w)) == b for w in ways)


def test_sentencepiece_digest(spark):
    got = queries.QUERIES["op4_sentencepiece"](spark, SF)
    assert got.where("round_trip").count() == got.count() == 200 and got.where("n_best < 2").count() < 5


def test_sentencepiece_digest_and_pipeline_have_the_other_segmentations(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    d = common.table(spark, SF, "documents").where("doc_id < 20")
    want = {r.doc_id: r for r in sentencepiece_nbest.encode(d, path).collect()}
    for r in sentencepiece_nbest.digest(d, path).collect():
        assert r.nbest_ids_crc32 == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in want[r.doc_id].nbest_ids] and len(r.nbest_ids_crc32) == r.n_best - 1
    assert {r.doc_id: r.nbest_ids for r in corpus_pipeline.pieces(spark, d, SF).collect()} == {k: r.nbest_ids for k, r in want.items()}


# ---- languages


def test_language_id_on_held_out_documents(spark):
    d = common.table(spark, SF, "documents").select("doc_id", "lang")
    got = queries.QUERIES["op5_language_id"](spark, SF).join(d, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_scores_sum_all_segmentations():
    path = public_tokenizers.path("piece_bpe_32k.model")
    m = language_id.fit(["the cat and the hat", "le chat et la main"], ["en", "fr"], path)
    s = language_id.Scorer(m)
    v = s.v
    for text in ("thehat", "the chat", "zq"):
        want = np.zeros(2)
        for word in text.split():
            b = b" " + word.encode()
            total = np.zeros((len(b) + 1, 2))
            total[0] = 1
            for j in range(1, len(b) + 1):
                for k in range(j):
                    ids = [i for i in range(v.size) if v.texts[i] == b[k:j]] if j - k > 1 else [i for i in range(v.size) if v.texts[i] == b[k:j] and i not in v.byte_ids.tolist()] or [int(v.byte_ids[b[k]])]
                    for i in ids[:1]:
                        total[j] += total[k] * m.probability[i]
            want += np.log(total[-1])
        off, raw = kernels.buffers(pa.array([text]))
        assert np.allclose(s.score(off, raw)[0], want)
    assert np.allclose(m.probability.sum(axis=0), 1)


def test_language_of_odd_texts(spark):
    d = docs(spark, ODD).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    got = {r.doc_id: r for r in language_id.identify(d, language_id.train(d, public_tokenizers.path("piece_bpe_32k.model"), 5)).collect()}
    for k, t in enumerate(ODD):
        assert (got[k].lang_pred == "und") == (not any(c.isalpha() for c in t or "")) and got[k].ids == "x"
    none = language_id.train(d.withColumn("lang", F.lit(None).cast("string")), public_tokenizers.path("piece_bpe_32k.model"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(d, none).collect()} == {("und", 0.0)}
    assert language_id.identify(d.where("1 = 0"), none).count() == 0


# ---- search


def test_top_k_against_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.sql(topk_nra.OP2_SQL).fetchall())
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in queries.QUERIES["op2_topk"](spark, SF).select("query_id", "rank", "vec_id", "score").collect())
    assert got == sorted((q, r, v, s) for q, r, v, s in want)


def test_top_k_with_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [list(map(float, rng.integers(-2, 3, 5) / 4)) for _ in range(300)] + [None, [float("nan")] * 5, [None] * 5, [], [0.5, 0.25]]
    df = spark.createDataFrame([(k, r, "x") for k, r in enumerate(rows)] + [(None, rows[0], "x")], "vec_id long, embedding array<float>, block string").repartition(4)
    x = {k: np.floor(1024 * np.array(r + [0.0] * (5 - len(r)))).astype(int) for k, r in enumerate(rows) if r is not None and None not in r and np.isfinite(r).all()}
    got = topk_nra.top_k(df, F.col("vec_id") % 50 == 0, 7, block=40, query_block=2).collect()
    want = {(q, n + 1, k, s) for q in x if q % 50 == 0 for n, (s, k) in enumerate(sorted(((int(x[q] @ x[k]), k) for k in x if k != q), key=lambda p: (-p[0], p[1]))[:7])}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want
    assert topk_nra.top_k(df.where("1 = 0"), F.col("vec_id") % 50 == 0).count() == 0
    assert topk_nra.top_k(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 2


def test_nra_stops_early_where_it_can():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-50, 50, (4000, 8)), rng.integers(900, 1000, (12, 8))])
    got, score, depth = topk_nra.SortedLists(np.arange(len(x)), x).search(np.full(8, 1000), -1, 10)
    assert depth < len(x) and set(got) <= set(range(4000, 4012)) and (score == np.sort(x @ np.full(8, 1000))[::-1][:10]).all()


# ---- mixing


def plain_targets(sizes, weights=(1, 2, 3)):
    names = sorted(k for k in sizes if k is not None) + [k for k in sizes if k is None]
    w = {k: weights[i % 3] for i, k in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [k for k in names if k not in capped]
        left = total - sum(capped.values())
        share = {k: left * w[k] / sum(w[j] for j in rest) for k in rest}
        over = [k for k in rest if share[k] > 3 * sizes[k]]
        if not over:
            return {k: float(v) for k, v in (capped | share).items()}
        capped |= {k: 3 * sizes[k] for k in over}


def test_mixing(spark):
    rng = random.Random(4)
    rows = []
    for source, n in (("hot", 900), ("a", 60), ("é", 40), (None, 50), ("z", 3), ("empty", 2)):
        rows += [(len(rows) + i, " ".join(["w"] * (0 if source == "empty" else rng.randint(0, 300))), source, 1) for i in range(n)]
    rows += [(10_000, None, "a", 1), (None, "w " * 40, "a", 1), (10_001, "w " * 9000, "hot", 1), (10_002, "same words", "z", 1), (10_002, "same words", "z", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(5)
    plan = lambda: mixing.plan(df).select("doc_id", "source", "size", "source_size", "target", mixing.taken().alias("taken")).collect()
    got = plan()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, plan()))
    sizes = Counter()
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split())
    want = plain_targets(sizes)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 2 * mixing.BLOCK_WORDS + 0.03 * t for s, t in want.items()), (taken, want)
    mixed = mixing.mix(df).withColumn("w", mixing.n_words(F.col("text")))
    assert {r.source: r.w for r in mixed.groupBy("source").agg(F.sum("w").alias("w")).collect()} == {s: t for s, t in taken.items() if t}
    assert mixed.drop("w").columns == df.columns and mixing.plan(df.where("1 = 0")).count() == 0 and mixing.plan(df.where("source = 'empty'")).agg(F.sum("target")).first()[0] == 0


def test_sainte_lague_against_the_highest_quotients(spark):
    rng = random.Random(9)
    rows = [(g, k, rng.choice([0.0, 1.0, rng.random() * 100])) for g in range(4) for k in range(12)]
    df = spark.createDataFrame(rows, "g int, k int, v double").withColumn("seats", F.lit(37))
    got = {(r.g, r.k): r.quota for r in mixing.sainte_lague(df, ["g"], ["k"], F.col("v"), F.col("seats"), F.lit(1000)).collect()}
    for g in range(4):
        quota = Counter()
        for _ in range(37):
            best = max((r for r in rows if r[0] == g), key=lambda r: (r[2] / (2 * quota[r[1]] + 1), -r[1]))
            quota[best[1]] += 1
        assert {k: q for (h, k), q in got.items() if h == g} == {k: quota[k] for k in range(12)}


# ---- pipeline


def test_pipeline(spark):
    docs_ = common.table(spark, SF, "documents")
    kept = docs_
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = common.stored(stage(spark, kept, SF), f"test-{name}")
        assert kept.columns == docs_.columns, name
        assert kept.count() > 100, name
    out = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert out.count() == kept.count()
    run = corpus_pipeline.run(spark, SF)
    assert sorted(r.ids for r in run.select("ids").collect()) == sorted(r.ids for r in out.select("ids").collect())


def test_pipeline_of_an_empty_table_and_of_nulls(spark):
    empty = common.table(spark, SF, "documents").where("1 = 0")
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "a text of words", "en", None, 3), (2, "", "en", "s", 0), (3, "the words of a text", "en", "s", 9)], "doc_id long, text string, lang string, source string, n_chars long")
    for table in (empty, odd):
        for name, stage in corpus_pipeline.STAGES:
            table = common.stored(stage(spark, table, SF), f"test-{name}")
        assert table.count() <= 4


def test_top_k_of_large_components(spark):
    rows = [(0, [1.0, 0.0]), (1, [3e6, 0.0]), (2, [2.0, 5.0]), (3, [-3e6, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_nra.top_k(df, F.col("vec_id") == 0, 3).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 3_000_000 * 1024 * 1024), (2, 2 * 1024 * 1024), (3, -3_000_000 * 1024 * 1024)]
    with pytest.raises(Exception, match="64 bits"):
        topk_nra.top_k(spark.createDataFrame([(0, [1e15]), (1, [1e15])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    with pytest.raises(OverflowError):
        topk_nra.SortedLists(np.arange(2), np.full((2, 1), 2**40)).search(np.array([2**40]), 0, 1)


def test_scores_are_resolved_from_the_lists():
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.integers(-50, 50, (400, 8)), rng.integers(4000, 5000, (30, 8))])
    q = rng.integers(200, 900, 8)
    lists = topk_nra.SortedLists(np.arange(len(x)), x)
    lists.x = np.zeros_like(lists.x)  # nothing is looked up beside the lists
    got, score, depth = lists.search(q, -1, 10)
    assert depth < len(x) and score.tolist() == np.sort(x @ q)[::-1][:10].tolist()


def test_language_id_learns_scripts_without_spaces(spark):
    rng = random.Random(21)
    alphabets = {"ja": "日本語文章東京大学生活", "zh": "这是一个简体中文网页内容", "th": "กขคงจฉชซฌญ", "en": None}
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    make = lambda k: " ".join(word() for _ in range(60)) if alphabets[k] is None else "".join(rng.choice(alphabets[k]) for _ in range(400))
    rows = [(i, make(k), k if i < 160 else None) for i, k in enumerate(list(alphabets) * 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.train(df, public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r.lang_pred for r in language_id.identify(df.drop("lang"), model).collect()}
    right = [got[i] == k for i, k in enumerate(list(alphabets) * 60)]
    assert np.mean(right) > 0.98
    raw = np.frombuffer(("é" * 300 + "x" * 10).encode(), np.uint8)
    a, b, of = language_id.in_parts(raw, np.array([0, 600]), np.array([600, 610]), 181)
    assert a.tolist() == [0, 180, 360, 540, 600] and b.tolist() == [180, 360, 540, 600, 610] and of.tolist() == [0, 0, 0, 0, 1]


def test_text_without_spaces(spark):
    """Segments of many lengths share few rectangles, and come out as those of a whole lattice."""
    from tessera.llm import lattice

    rng = random.Random(31)
    letters = [chr(0x4E00 + k) for k in range(400)] + list("abcdefghij")
    texts = ["\n".join("".join(rng.choice(letters) for _ in range(rng.randint(5, 130))) for _ in range(40)) for _ in range(4)] + ["".join(rng.choice("ab") for _ in range(900))]
    s = sentencepiece_nbest.Segmenter(public_tokenizers.path("piece_bpe_32k.model"))
    got = s.encode(*kernels.buffers(pa.array(texts)), 3)
    for k, t in enumerate(texts):
        assert got[2][k] == pytest.approx(plain_nbest(s, t, 3), rel=1e-9)
    length = np.arange(1, 400)
    parts = list(lattice.rectangles(np.zeros(399, np.int64), length))
    assert len(parts) <= 32 + 15 and sorted(np.concatenate([p for _, p in parts]).tolist()) == list(range(399))
    assert all(size == length[p].max() and size <= max(32, 1.2 * length[p].min() + 1) for size, p in parts)


def test_many_equal_segmentations_are_not_all_looked_at():
    """Ties of a long word without spaces: a best path is gone down to its end before others are begun."""
    import heapq as h

    s = sentencepiece_nbest.Segmenter(public_tokenizers.path("piece_bpe_32k.model"))
    rng, pushed = random.Random(1), []
    word = "".join(rng.choice("abcdefghij") for _ in range(5000)).encode()
    push = h.heappush
    try:
        sentencepiece_nbest.heapq.heappush = lambda heap, x: pushed.append(1) or push(heap, x)
        found = s.nbest(word, 3)
    finally:
        sentencepiece_nbest.heapq.heappush = push
    assert len(pushed) < 30 * len(word) and len(found) == 3 and found[0][0] >= found[1][0] >= found[2][0]


def test_language_model_learns_from_one_row_an_id(spark, monkeypatch):
    """Copies of an id and very long texts don't make the sample larger than its bounds."""
    monkeypatch.setattr(language_id, "SAMPLE_CHARS", 5000)
    seen = []
    fit = language_id.fit
    monkeypatch.setattr(language_id, "fit", lambda texts, labels, path: seen.append((texts, labels)) or fit(texts, labels, path))
    rows = [(1, "eine kleine frage", "de")] * 300 + [(1, "noch eine andere frage", "de"), (2, "wort " * 4000, "de"), (3, "the word", "en"), (4, None, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.train(df, public_tokenizers.path("piece_bpe_32k.model"))
    texts, labels = seen[0]
    assert sorted(labels) == ["de", "en"] and model.languages == ["de", "en"] and sum(map(len, texts)) <= 10_000


def test_words_of_a_rectangle_are_bounded_by_their_bytes():
    length = np.array([180] * 5000 + [7] * 20_000 + [200_000])
    got = list(lattice.rectangles(np.zeros(len(length), np.int64), length))
    assert all(size * len(part) <= lattice.CELLS or len(part) == 1 for size, part in got)
    assert sorted(np.concatenate([part for _, part in got]).tolist()) == list(range(len(length)))


def test_a_workers_last_model_leaves_no_memory_behind(monkeypatch):
    order = []
    monkeypatch.setattr(common, "_RESIDENT", {"old": bytearray(10)})
    monkeypatch.setattr(common, "trim", lambda: order.append(("trim", dict(common._RESIDENT))))
    assert common.resident("new", lambda: order.append("made") or 5) == common.resident("new", None) == 5
    assert order == [("trim", {}), "made"]
