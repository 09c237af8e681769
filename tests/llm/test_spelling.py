"""Spelling variants against brute force over all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, h string, short string, k string, t string"


def docs(spark, rows):
    return spark.createDataFrame([(k, t, "w", 1, "h", "s", "k", "t") for k, t in rows], SCHEMA).repartition(3)


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def brute_pairs(words):
    """Pairs by words less one letter, each checked."""
    by = defaultdict(set)
    for w in words:
        for key in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            by[key].add(w)
    return {tuple(sorted(p, key=lambda w: (len(w), w))) for group in by.values() for p in itertools.combinations(group, 2) if one_edit(*p)}


def brute(rows, damage=97, least=3):
    counts = Counter()
    for k, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}
    near = defaultdict(list)
    for a, b in brute_pairs(counts):
        near[a].append(b)
        near[b].append(a)
    form = {}
    for w in counts:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def found(df):
    got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("seed", range(30))
def test_tries(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 3 else "abcdé"
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(0, 7))) for _ in range(rng.choice([2, 9, 120]))})
    assert {(words[a], words[b]) for a, b in spelling.near(words)} == {tuple(sorted(p)) for p in itertools.combinations(words, 2) if one_edit(*p)}


def test_tries_of_long_words():
    long = "abcdefghij" * 4000
    words = [long, long[:20000] + long[20001:], long[:7] + "z" + long[8:], long + "q", "abc"]
    assert spelling.near(words) == {(0, 1), (0, 2), (0, 3)}


@pytest.mark.parametrize("group", [spelling.GROUP, 3])
def test_pairs_once_each(spark, monkeypatch, group):
    """Also where nearly every group is dealt out again; a common beginning is in every word."""
    monkeypatch.setattr(spelling, "GROUP", group)
    monkeypatch.setattr(spelling, "BROADCAST", 0 if group == 3 else 10)
    rng = random.Random(group)
    words = sorted({rng.choice(["", "common", "prefixed"]) + "".join(rng.choice("abc") for _ in range(rng.randint(5, 9))) for _ in range(700)})
    got = [tuple(r) for r in spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string").repartition(3)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(words)


def corpus(seed, n=120):
    rng = random.Random(seed)
    w = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    w += [x[:-1] for x in w] + [x.upper() for x in w[:20]] + [x[:2] + "z" + x[2:] for x in w[:30]] + ["Straße", "straße", "strasse", "ÉTUDE", "étude", "x×÷y"]
    texts = [" ".join(rng.choice(w) for _ in range(rng.choice([1, 30, 200]))) for _ in range(n)]
    rows = list(enumerate(texts)) + [(3, texts[3])] * 40 + [(None, "nokey nokey nokey nokeys"), (4, None), (5, ""), (6, "Ωmega日本語words words'words words-words")]
    return [*rows, (7, "long" * 30000), (8, "long" * 30000), (9, "long" * 30000), (10, "many words " * 200000)]


@pytest.mark.parametrize("damage", [97, 3])
def test_variants(spark, damage):
    rows = corpus(damage)
    assert found(spelling.variants(docs(spark, rows), damage=damage)) == brute(rows, damage)


def test_chains(spark):
    """A chain of forms that doubles at each step; ties go to the lesser word."""
    chain = ["wordsabcde"[: 5] + "a" * k for k in range(9)]
    rows = [(k, " ".join([w] * 3 * 2**k)) for k, w in enumerate(chain)] + [(100, "tieda " * 20 + "tiedb " * 20 + "tiedc " * 5)]
    got = found(spelling.variants(docs(spark, rows), damage=10**12))
    assert got == brute(rows, 10**12) and (chain[0], chain[1], chain[-1], 3, 1, 6) in got
    assert {r[1] for r in got if r[0] == "tiedc"} == {"tieda"}


def test_empty_table(spark):
    got = spelling.variants(docs(spark, []))
    assert sorted(got.columns) == ["form", "form_n", "n", "n_near", "root", "word"] and got.count() == 0


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(spelling.op11_spelling_variants(spark, "/root/testdata/sf0.001")) == brute(rows)


def test_query_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    want = con.sql(spelling.OP11_SQL)
    rows = {tuple(dict(zip(want.columns, r))[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in want.fetchall()}
    assert found(spelling.op11_spelling_variants(spark, "/root/testdata/sf0.01")) == rows
