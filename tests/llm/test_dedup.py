"""Substring, suffix, line and near-duplicate operators against brute force on small tables."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import common, embedding_dedup, jaccard_join, kernels, line_dedup, substring, suffix_array

#: Extra columns whose names the operators use themselves.
SCHEMA = "doc_id long, text string, at string, bucket string, h string, drop int, component string, n long, id string"


def docs(spark, texts, keys=None):
    keys = range(len(texts)) if keys is None else keys
    return spark.createDataFrame([(k, t, "x", "y", "z", 1, "c", 2, "i") for k, t in zip(keys, texts, strict=True)], SCHEMA).repartition(3)


def vocabulary(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def corpus(seed=7):
    rng = random.Random(seed)
    w = vocabulary(4000)
    text = lambda n: " ".join(rng.choice(w) for _ in range(n))
    passage, line = text(60), text(25)
    out = [text(rng.choice([5, 19, 20, 21, 80, 300])) for _ in range(40)]
    out += [f"{text(30)} {passage} {text(10)}\n{line}\n{text(40)}" for _ in range(25)]  # a hot passage and line
    out += [out[3], out[4], out[4], out[5]] + [passage] * 8  # copies
    out += [out[6].replace(" ", "\t", 3), f"{line}\n{line}\n{line}"]
    out += [text(200) + " " + (w[0] + " ") * 90, (w[1] + " ") * 70, text(20000)]  # repeats within, very long
    out += [None, "", " \n\t ", "x", "Ünïcödé 日本語 " * 12, "Ünïcödé 日本語 " * 12]
    return out


@pytest.mark.parametrize("limit", [60, 61, 97])
def test_anchors_of_long_sequences(monkeypatch, limit):
    """In parts, every window has the anchor that it has at once."""
    rng = np.random.default_rng(limit)
    gram = rng.integers(0, 2**63, 700).astype(np.uint64)
    off = np.array([0, 0, 150, 160, 161, 400, 708])

    def by_window(found):
        pairs = [(w, a) for a, first, last in zip(*(x.tolist() for x in found), strict=True) for w in range(first, last + 1)]
        assert len(pairs) == len(set(pairs))
        return dict(pairs)

    want = by_window(kernels.anchors(gram, off, 20, 9))
    monkeypatch.setattr(kernels, "LIMIT", limit)
    assert by_window(kernels.anchors(gram, off, 20, 9)) == want and len(want) > 500


def test_external_files_go_when_a_task_fails(tmp_path):
    import pathlib

    work = suffix_array._construct(2, f"file://{tmp_path}/columns")
    with pytest.raises(AttributeError):
        list(work(iter(["not a batch"])))
    assert list(pathlib.Path(tmp_path, "columns").iterdir()) == []


def test_kernels():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 500).astype(np.uint64)
    for width in (1, 2, 3, 7, 8, 31):
        assert (kernels.sliding_min(x, width) == [x[i : i + width].min() for i in range(len(x) - width + 1)]).all()
    data = rng.integers(0, 3, 400).astype(np.uint8)
    r = kernels.Rolling(3)
    h = r.windows(r.prefix(data), 9)
    same = defaultdict(set)
    for i in range(len(h)):
        same[data[i : i + 9].tobytes()].add(int(h[i]))
    assert all(len(v) == 1 for v in same.values()) and len({v for s in same.values() for v in s}) == len(same)
    off = np.array([0, 0, 150, 160, 400])
    at, a, b = kernels.anchors(h, off, 20, 9)
    covered = {i for s, e in zip(a, b, strict=True) for i in range(s, e + 1)}
    assert covered == {i for s, e in zip(off[:-1], off[1:], strict=True) for i in range(s, e - 19)}
    assert all(s <= p and p + 9 <= e + 20 and all(i <= p <= i + 11 for i in range(s, e + 1)) for p, s, e in zip(at, a, b, strict=True))
    words = kernels.words(np.array([0, 3, 3, 8]), np.frombuffer(b"a bcd\x0be ", np.uint8))
    assert [x.tolist() for x in words] == [[0, 2, 3, 6], [1, 3, 5, 7], [0, 0, 2, 2]]


def brute_words(rows):
    seen, out = set(), {}
    for k, t in sorted(rows, key=lambda r: r[0]):
        w = (t or "").encode().split()
        drop = [False] * len(w)
        for a in range(len(w) - 19):
            x = tuple(w[a : a + 20])
            if x in seen:
                drop[a : a + 20] = [True] * 20
            seen.add(x)
        out[k] = (len(w), sum(drop), hashlib.sha256(b" ".join(x for x, d in zip(w, drop, strict=True) if not d)).hexdigest())
    return out


def test_substring_dedup(spark):
    texts = corpus()
    got = substring.remove_repeats(docs(spark, texts)).collect()
    want = brute_words(list(enumerate(texts)))
    assert {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got} == want
    assert all(sum(s.end - s.start for s in r.removed) == r.n_removed for r in got) and sum(r.n_removed for r in got) > 1000


def test_substring_index_is_incremental(spark):
    w = vocabulary(500)
    rng = random.Random(2)
    same = " ".join(rng.choice(w) for _ in range(50))
    index = substring.FingerprintIndex(spark, common.shared_dir(spark, "test-index"), 4, fanout=2)
    for k in range(5):
        own = docs(spark, [" ".join(rng.choice(w) for _ in range(50)), same], [2 * k, 2 * k + 1]).select("doc_id", "text")
        hit = {r.doc_id for r in substring.by_document(index.add(own), 4).collect()}
        assert hit == (set() if k == 0 else {1, 2 * k + 1})
    assert sorted(level for level, _ in index.runs) == [0, 2]  # runs of five batches, compacted by two


def test_substring_index_of_two_sessions_equals_one(spark):
    w = vocabulary(400)
    rng = random.Random(3)
    same = " ".join(rng.choice(w) for _ in range(60))
    batches = [docs(spark, [" ".join(rng.choice(w) for _ in range(50)) + " " + same * (k % 2), same], [2 * k, 2 * k + 1]).select("doc_id", "text") for k in range(6)]
    hits = lambda index, k: sorted((r.doc_id, r["at"]) for r in substring.by_document(index.add(batches[k]), 4).collect())
    one, uri = substring.FingerprintIndex(spark, common.shared_dir(spark, "one"), 4, fanout=2), common.shared_dir(spark, "two")
    want = [hits(one, k) for k in range(6)]
    got = []
    for part in ((0, 1, 2), (3,), (4, 5)):
        index = substring.FingerprintIndex(spark, uri, fanout=2)  # opened from its manifest
        index.buckets = 4 if not index.runs else index.buckets
        got += [hits(index, k) for k in part]
    assert got == want and [level for level, _ in index.runs] == [level for level, _ in one.runs]
    with pytest.raises(ValueError):
        substring.FingerprintIndex(spark, uri, 5)


def brute_bytes(rows):
    seen, out = {}, {}
    for k, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        own = [b[a : a + 50] for a in range(len(b) - 49)]
        drop = np.zeros(len(b), bool)
        for a, x in enumerate(own):
            if x in seen:
                drop[a : a + 50] = True
        seen.update(dict.fromkeys(own))
        out[k] = (len(b), int(drop.sum()), int((np.diff(np.concatenate([[0], drop.astype(int)])) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~drop].tobytes()).hexdigest())
    return out


def test_suffix_dedup(spark):
    texts = corpus()
    got = suffix_array.remove_shared(docs(spark, texts)).collect()
    assert {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), hashlib.sha256(r.kept).hexdigest()) for r in got} == brute_bytes(list(enumerate(texts)))


def test_column_bwt_sorts_all_suffixes(tmp_path):
    rng = np.random.default_rng(4)
    strings = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (5, 0, 30, 31, 1, 30)]
    strings.append(strings[2])
    data, off = np.frombuffer(b"".join(strings), np.uint8), np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    bwt, start, string = suffix_array.column_bwt(data, off, suffix_array.Columns(f"file://{tmp_path}"))
    suffixes = [(strings[k][s - off[k] :], k) for s, k in zip(start, string, strict=True)]
    assert suffixes == sorted(((s[i:], k) for k, s in enumerate(strings) for i in range(len(s) + 1)))
    before = [strings[k][s - off[k] - 1] if s > off[k] else None for s, k in zip(start, string, strict=True)]
    assert [b == 0 for b in bwt] == [x is None for x in before] and len({(b, x) for b, x in zip(bwt.tolist(), before, strict=True)}) == 4


@pytest.mark.parametrize("operator", [substring.remove_repeats, suffix_array.remove_shared])
def test_keys_that_repeat_or_are_null(spark, operator):
    w = vocabulary(300)
    same = " ".join(w[:60])
    got = operator(docs(spark, [same, same, same, same], [1, 1, None, 2])).collect()
    removed = sorted((r.doc_id is None, r.doc_id or 0, len(r.removed)) for r in got)
    assert removed == [(False, 1, 0), (False, 1, 0), (False, 2, 1), (True, 0, 0)]
    assert operator(docs(spark, [], [])).count() == 0


def runs_of_16(line):
    u = ("\n" * 15 + line + "\n" * 15).encode("utf-16-be")
    return {u[a : a + 32] for a in range(0, len(u) - 31, 2)}


def brute_lines(rows):
    first, occ = {}, []
    for k, t in sorted(rows, key=lambda r: r[0]):
        for p, line in enumerate((t or "").split("\n")):
            key = line.strip(" \t\n\x0b\x0c\r").lower()
            if key:
                occ.append((k, p, key))
                first.setdefault(key, (k, p))
    sets = {k: runs_of_16(k) for k in first}
    parent = {k: k for k in first}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    keys = list(first)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            n = len(sets[a] & sets[b])
            if n >= 0.8 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((find(a), find(b)), key=first.get)
                parent[y] = x
    return Counter(k for k, p, key in occ if first[find(key)] != (k, p))


def test_line_dedup(spark):
    rng = random.Random(3)
    w = vocabulary(3000)
    base = [rng.choice(w) for _ in range(80)]
    near = lambda: " ".join(rng.choice(w) if rng.random() < 0.01 else x for x in base)
    texts = ["\n".join([" ".join(rng.choice(w) for _ in range(30)), near(), "", "Short line", " short LINE\t"]) for _ in range(30)] + [None, "", "\n\n", "a\na\nb", "日本語の行です。" * 9 + "\n" + "日本語の行です。" * 9]
    got = line_dedup.dedup_lines(docs(spark, texts)).collect()
    want = brute_lines(list(enumerate(texts)))
    gone = {r.doc_id: r.n_removed for r in got}
    assert sum(gone.values()) >= 0.97 * want.total() and all(n <= want[k] for k, n in gone.items())  # bands may miss a pair near the threshold
    assert all(r.text is None if texts[r.doc_id] is None else len(r.text.split("\n")) == r.n_lines - r.n_removed or r.text == "" for r in got)
    assert got[0].bucket == "y" and line_dedup.dedup_lines(docs(spark, [], [])).count() == 0


def test_line_dedup_with_null_and_repeated_keys(spark):
    got = line_dedup.dedup_lines(docs(spark, ["one line\nother"] * 4, [None, 1, 1, 2])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in got) == [(False, 1, 0), (False, 1, 0), (False, 2, 2), (True, 0, 0)]


def brute_components(sets, linked):
    keys = sorted(sets)
    parent = {k: k for k in keys}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(sets[a], sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in keys}


def test_jaccard_join(spark):
    rng = random.Random(5)
    w = [f"w{i}" for i in range(3000)]
    some = lambda n, of=w: [rng.choice(of) for _ in range(n)]
    base, other, hot = some(120), some(90), some(50)

    def edit(b, k):
        b = list(b)
        for _ in range(k):
            b[rng.randrange(len(b))] = rng.choice(w)
        return b

    rows = [edit(base, rng.choice([0, 1, 1, 2, 3, 4])) for _ in range(90)] + [edit(other, rng.choice([1, 2]))[: rng.choice([90, 88, 85, 80])] for _ in range(50)]
    rows += [some(rng.choice([5, 20, 60])) + hot for _ in range(60)] + [hot[: rng.choice([45, 50, 49])] + some(rng.choice([0, 1, 2, 3])) for _ in range(40)]
    rows += [some(rng.choice([1, 2, 3, 4, 5, 6]), w[:3]) for _ in range(30)] + [["A", "b", "C"], ["a", "B", "c"]]
    rng.shuffle(rows)
    texts = [" ".join(r) for r in rows] + [None, "", " \n"]
    sets = {}
    for k, t in enumerate(texts):
        x = re.sub("[A-Z]", lambda m: m[0].lower(), t or "").split()
        sets[k] = frozenset(tuple(x[a : a + 4]) for a in range(len(x) - 3)) if len(x) >= 4 else frozenset([tuple(x)] if x else [])
    want = brute_components(sets, lambda a, b: bool(a) and bool(b) and 100 * len(a & b) >= 85 * len(a | b))
    got = {r.doc_id: r for r in jaccard_join.link_components(docs(spark, texts)).collect()}
    assert {k: r.component_id for k, r in got.items()} == want and {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    kept = jaccard_join.one_of_each(docs(spark, texts))
    assert {r.doc_id for r in kept.collect()} == set(want.values()) and kept.columns == docs(spark, []).columns


def test_near_copies_of_the_pipeline(spark):
    import corpus_pipeline

    rng = random.Random(12)
    w = [f"w{i}" for i in range(4000)]
    texts = []
    for _ in range(25):  # one edited block each, of sizes around both rules' bounds
        x = [rng.choice(w) for _ in range(300)]
        texts.append(" ".join(x))
        for k in (18, 24, 27, 40):
            texts.append(" ".join(x[:100] + [rng.choice(w) for _ in range(k)] + x[100 + k :]))
    sets = {k: {tuple(t.split()[a : a + 5]) for a in range(296)} for k, t in enumerate(texts)}
    want = set(brute_components(sets, lambda a, b: 100 * len(a & b) >= 80 * len(a | b)).values())
    assert {r.doc_id for r in corpus_pipeline.near_copies(spark, docs(spark, texts), "").collect()} == want
    assert len(jaccard_join.one_of_each(docs(spark, texts)).collect()) > len(want)


def test_jaccard_join_edges(spark):
    got = jaccard_join.link_components(docs(spark, ["a b c d e"] * 4, [None, 3, 3, 7])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (3, 3), (3, 3), (7, 3)]
    assert jaccard_join.link_components(docs(spark, [], [])).count() == 0


def test_embedding_dedup(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((40, 16))
    rows = [list(map(float, b)) for b in base] + [list(map(float, base[0] + rng.standard_normal(16) * s)) for s in rng.choice([0.02, 0.1, 0.25, 0.3], 120)]
    rows += [rows[1]] * 5 + [rows[41], [x * 3 for x in rows[2]], None, [], [0.0] * 16, [float("nan")] * 16, [None] * 16, [float("inf")] + [1.0] * 15, rows[3][:8]]
    ids = list(range(len(rows)))
    df = spark.createDataFrame([(k, r, 0, "x") for k, r in zip(ids, rows, strict=True)], "vec_id long, embedding array<float>, label int, rep string").repartition(3)
    x = {k: np.array(r, np.float32).astype(float) for k, r in zip(ids, rows, strict=True) if r and None not in r and np.isfinite(r).all() and np.any(r)}
    cos = lambda a, b: len(a) == len(b) and float(a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b))) >= 0.95
    want = {k: k for k in ids} | brute_components(x, cos)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(df).collect()}
    assert {k: r.component_id for k, r in got.items()} == want and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert {k: r.n_links for k, r in got.items()} == {k: sum(k != j and cos(x[k], x[j]) for j in x) if k in x else 0 for k in ids}
    assert embedding_dedup.near_duplicates(df.where("1 = 0")).count() == 0


def test_embedding_dedup_in_double_precision(spark):
    turn = lambda c: [c, float(np.sqrt(1 - c * c))]
    rows = [[1.0, 0.0], turn(0.95 + 1e-10), [-1.0, 0.0], [-x for x in turn(0.95 - 1e-10)], [0.0, 1e200], [1e190, 1e200], [1e-300, -1e-300], [2e-300, -2e-300]]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    assert [r.component_id for r in embedding_dedup.near_duplicates(df).orderBy("vec_id").collect()] == [0, 0, 2, 3, 4, 4, 6, 6]


def test_embedding_buckets_over_the_bound_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(8)
    rows = [list(map(float, np.ones(8) + rng.standard_normal(8) * 0.05)) for _ in range(70)]
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<float>")
    x = np.array(rows, np.float32).astype(float)
    n = np.sqrt((x * x).sum(1))
    want = ((x @ x.T) / np.outer(n, n) >= 0.95).sum(1) - 1
    assert [r.n_links for r in embedding_dedup.near_duplicates(df).orderBy("vec_id").collect()] == want.tolist()


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_characters(lines):
    """Lines that go of documents of one line each, by all their runs of 16 characters."""
    sets = {k: runs_of_16(x.strip().lower()) for k, x in enumerate(lines)}
    return {k for k, c in brute_components(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b)).items() if k != c}


def gone(spark, lines):
    return {r.doc_id for r in line_dedup.dedup_lines(docs(spark, lines)).collect() if r.n_removed}


def test_line_dedup_looks_at_every_character(spark):
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghij0123456789") for _ in range(n))
    long = word(300)
    lines = ["https://www.example.com/page1", "https://www.example.com/other/2", "日本語" * 5 + "abcdefghijkl", "日本語" * 5 + "mnopqrstuvwx"]
    lines += [f"0123456789abcdef{word(60)}" for _ in range(20)] + [long, "x" + long, long[:299] + "!", long[:150] + word(150)]
    lines += [f"a common beginning {word(12)}" for _ in range(5)] + ["an end behind\rthis", "an end behind\rthat"]
    lines += ["import numpy_extension_a", "import numpy_extension_b", "chapter number 12", "https://example.org/page/1", "invoice total for march 100"]
    lines += ["chapter number 13", "https://example.org/page/2", "invoice total for march 999"]
    assert gone(spark, lines) == brute_characters(lines) == {25, 26}


@pytest.mark.parametrize("group", [line_dedup.GROUP, 10])
def test_line_dedup_finds_near_copies_in_bands_with_common_boilerplate(spark, monkeypatch, group):
    monkeypatch.setattr(line_dedup, "GROUP", group)
    rng = random.Random(10)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    common_part, lines = word(200), []
    for _ in range(100):
        own = word(150)
        at = rng.randrange(20, 110)
        lines += [common_part + own, common_part + own[:at] + word(8) + own[at + 8 :]]
    want = brute_characters(lines)
    got = gone(spark, lines)
    assert len(want) >= 95 and got <= want and len(got) >= 0.95 * len(want)


@pytest.mark.parametrize(("n", "edit"), [(2000, 8), (6000, 14)])
def test_line_dedup_of_a_template(spark, n, edit):
    """Strangers share 300 of 370 characters (0.64), each second line is a near copy of the one before."""
    rng = random.Random(n)
    word = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    common_part, lines, want = word(300), [], set()
    runs = lambda x: {x[i : i + 16] for x in ["\n" * 15 + x.strip() + "\n" * 15] for i in range(len(x) - 15)}
    for k in range(0, n, 2):
        own = word(70)
        at = rng.randrange(2, 68 - edit)
        lines += [common_part + own, common_part + own[:at] + word(edit) + own[at + edit :]]
        a, b = runs(lines[-2]), runs(lines[-1])
        if 5 * len(a & b) >= 4 * len(a | b):
            want.add(k + 1)
    got = gone(spark, lines)
    assert len(want) >= 0.9 * n / 2 and got <= want and len(got) >= 0.95 * len(want)


def test_line_dedup_of_different_texts_under_one_key(spark):
    got = line_dedup.dedup_lines(docs(spark, ["first\nsame", "first\nsame", "second\nthird", None, "third"], [5, 5, 5, 5, 9])).collect()
    assert sorted((r.doc_id, r.text or "", r.n_removed) for r in got) == [(5, "", 0), (5, "first\nsame", 0), (5, "first\nsame", 0), (5, "second\nthird", 0), (9, "", 1)]


def test_line_dedup_of_very_long_lines(spark):
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefghijklmnop ") for _ in range(300_000))
    assert gone(spark, [long, long[:200_000] + "x" + long[200_000:], long[:150_000]]) == {1}


@pytest.mark.parametrize("operator", [substring.remove_repeats, suffix_array.remove_shared])
def test_different_texts_under_one_key_lose_nothing(spark, operator):
    w = vocabulary(900)
    a, b = " ".join(w[:60]), " ".join(w[100:160])
    got = operator(docs(spark, [a, a, a, b, b], [1, 5, 5, 5, 9])).collect()
    text = lambda r: r.kept if isinstance(r.kept, str) else bytes(r.kept).decode()
    assert sorted((r.doc_id, text(r)) for r in got) == [(1, a), (5, ""), (5, ""), (5, b), (9, "")]


def test_different_texts_and_vectors_under_one_key(spark):
    w = vocabulary(900)
    a, b, c = " ".join(w[:60]), " ".join(w[100:160]), " ".join(w[200:260])
    got = jaccard_join.link_components(docs(spark, [a, a, b, b, c], [1, 5, 5, 9, 9])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (5, 1), (5, 5), (9, 5), (9, 9)]
    kept = jaccard_join.one_of_each(docs(spark, [a, a, b, b, c], [1, 5, 5, 9, 9])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (5, b), (9, c)]
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0, 0.01])], "vec_id long, embedding array<float>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df).collect())
    assert got == [(1, 0, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False)]


def test_line_dedup_meets_lines_whose_shared_runs_are_all_frequent(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP", 2)
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n - 1)) + "x"
    head, blocks = text(300), [text(30) for _ in range(6)]
    made = [head + "".join(b) + text(4) for b in itertools.combinations(blocks, 2) for _ in range(8)]
    rng.shuffle(made)
    sets = [{p[k : k + 16] for k in range(len(p) - 15)} for p in ("\n" * 15 + x + "\n" * 15 for x in made)]
    gone = {j for j in range(len(made)) for i in range(j) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    got = line_dedup.dedup_lines(docs(spark, made)).collect()
    assert len(gone) == 105 and {r.doc_id for r in got if r.n_removed} == gone


def test_what_lines_lack_of_their_leader_makes_no_rows_to_join(spark, monkeypatch):
    rng = random.Random(3)
    base = "".join(rng.choices("abcdefgh", k=400))
    lines = {k: base[:at] + base[at + 40 :] for k, at in enumerate(range(0, 360, 4))}
    text = spark.createDataFrame([*lines.items(), (900, base)], "id long, key string")
    stored, kept = common.stored, {}
    monkeypatch.setattr(common, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    large = text.selectExpr("id", "bigint(900) AS lead", "id AS c")
    met = {(r.a, r.b) for r in line_dedup.met_by_differences(large, text, False).collect()}
    assert met == {(a, 900) for a in lines}  # all link to it
    assert kept["line-differences"].count() == len(lines)  # a row for each line, none for each run


def test_a_bitmap_holds_every_value(spark):
    ids = [x * 2654435761 - 2**40 for x in range(3000)]
    df = spark.createDataFrame([(x,) for x in ids], "id long")
    got = {r.id: r._ts_in for r in line_dedup.maybe_in(df, "id", line_dedup.bitmap(df.where("id % 3 = 0"), "id")).collect()}
    rest = {x % line_dedup.BITS for x in ids if x % 3 == 0}
    assert got == {x: x % line_dedup.BITS in rest for x in ids}


@pytest.mark.parametrize("long", [line_dedup.LONG, 300])
def test_lines_of_a_large_band_meet_by_what_they_differ_in(spark, monkeypatch, long):
    monkeypatch.setattr(line_dedup, "LONG", long)
    rng = random.Random(12)
    w = vocabulary(4000)
    base = [rng.choice(w) for _ in range(60)]

    def edit(words, k):
        words = list(words)
        for at in rng.sample(range(len(words)), k):
            words[at] = rng.choice(w)
        return words

    made = [base] + [edit(base, k % 8) for k in range(200)]
    made += [edit(x, 1) for x in made[5::10]]
    lines = dict(enumerate(sorted({" ".join(x) for x in made if x != base})))
    leader = len(lines)
    sets = {k: runs_of_16(x) for k, x in (lines | {leader: " ".join(base)}).items()}
    alike = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    text = spark.createDataFrame([*lines.items(), (leader, " ".join(base))], "id long, key string")
    large = text.selectExpr("id", f"bigint({leader}) AS lead", "id AS c")
    met = [(r.a, r.b) for r in line_dedup.met_by_differences(large, text, long == 300).collect()]
    found = {p for p in met if alike(*p)}
    assert len(met) == len(set(met)) < 0.06 * leader * leader / 2  # nearly all have a similarity over 0.5
    ids = {k: k for k in sets}
    assert brute_components(ids, lambda a, b: (min(a, b), max(a, b)) in found) == brute_components(ids, alike)
    assert any(leader not in p for p in found)
