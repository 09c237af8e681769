"""Spelling variant grouping by errata tries (operator 11).

Two words are near if one inserted, deleted or replaced code point makes one of the other.  Such a
pair agrees in all of the shorter word's first half or in all of its second half, so every word goes
to four groups: by first and by second half as the shorter, and as the longer of a pair.  A group
with more words than ``GROUP`` is dealt out again by the halves of what its words don't agree in;
that ends where one place is left, in at most (letters + letters squared) words, 8190 for the runs
of ``vocabulary``.  A pair has one group in which it counts: that of its first difference.

A group's task builds a trie of what its words differ in.  Heavy-path decomposition: at every node the
child with the most words is heavy, and the light ones are merged with one character replaced (into
the heavy child, and with each other) or skipped (into the node itself, and, from the heavy side,
into the heavy child).  Merged nodes are walked together, the small ones looked up in the large one,
so a word is met once for each light edge above it, a logarithmic number of times; terminals that
coincide are near.

Defined results: a null text has no words; a null key is written as nothing before the colon; rows
that repeat count again; a word may have any length; other columns, whatever their names, are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

#: Words, and what may be one with a letter more, have at least that many letters.
SHORTEST, OCCURRENCES, DAMAGE = 5, 3, 97
RUN = re.compile("[A-Za-zÀ-ÿ]{5,}")
#: A task's counts are handed on when there are that many; long texts are looked at in parts of that size.
HELD, PART = 400_000, 1 << 20
GROUP = 8192
#: Groups dealt out again are few (a four-thousandth of the words); beyond this they aren't broadcast.
BROADCAST = 1_000_000


class Node:
    __slots__ = ("at", "size", "word")

    def __init__(self):
        self.at: dict[str, Node] = {}
        self.size, self.word = 0, -1


def trie(words: list[str]) -> Node:
    root = Node()
    for k, w in enumerate(words):
        node = root
        node.size += 1
        for c in w:
            below = node.at.get(c)
            if below is None:
                below = node.at[c] = Node()
            node = below
            node.size += 1
        node.word = k
    return root


def _merge(large: Node | None, small: list[Node], among: bool, found: set[tuple[int, int]]) -> None:
    """Walk nodes together: words of ``small`` that end where one of ``large`` does, or of another of ``small``."""
    todo = [(large, small)]
    while todo:
        large, small = todo.pop()
        ends = [n.word for n in small if n.word >= 0]
        if large is not None and large.word >= 0:
            found.update((w, large.word) for w in ends)
        if among and len(ends) > 1:
            found.update((a, b) for k, a in enumerate(ends) for b in ends[:k])
        if len(small) == 1:
            if large is not None:
                todo += [(large.at[c], [n]) for c, n in small[0].at.items() if c in large.at]
            continue
        below = defaultdict(list)
        for n in small:
            for c, x in n.at.items():
                below[c].append(x)
        for c, nodes in below.items():
            beside = large.at.get(c) if large is not None else None
            if beside is not None or (among and len(nodes) > 1):
                todo.append((beside, nodes))


def near(words: list[str]) -> set[tuple[int, int]]:
    """Pairs (lesser index first) of distinct words that are one edit apart."""
    found: set[tuple[int, int]] = set()
    todo = [trie(words)]
    while todo:
        node = todo.pop()
        while node is not None and node.size > 1:  # down the heavy path
            heavy, light = None, []
            for n in node.at.values():
                if heavy is None or n.size > heavy.size:
                    heavy, n = n, heavy
                if n is not None:
                    light.append(n)
            if light:
                _merge(heavy, light, False, found)  # replaced by the heavy edge's character
                _merge(node, light, True, found)  # skipped, or replaced by each other's
                for c, n in node.at.items():
                    if n is not heavy and c in heavy.at:
                        _merge(heavy.at[c], [n], False, found)  # the heavy edge skipped
            if heavy is not None and node.word >= 0 and heavy.word >= 0:
                found.add((heavy.word, node.word))
            todo += [n for n in light if n.size > 1]
            node = heavy
    return {(min(p), max(p)) for p in found}


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int = DAMAGE, least: int = OCCURRENCES) -> DataFrame:
    """(word, n): runs of letters with A to Z lowered, as often as they occur; every ``damage``-th, by a
    hash of key and run, lacks a letter.  Each task sums before the exchange."""
    made = pa.schema([("word", pa.string()), ("n", pa.int64())])
    source = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"), F.col(text).cast("binary").alias("t")).where("t is not null")

    def parts(text: str) -> Iterator[str]:
        begin = 0
        while len(text) - begin > PART:
            end = begin + PART
            while end > begin and (text[end - 1].isalpha() and text[end].isalpha()):
                end -= 1
            if end == begin:  # one run longer than a part
                break
            yield text[begin:end]
            begin = end
        yield text[begin:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                begun = zlib.crc32(f"{name}:".encode())
                for part in parts(raw.as_py().lower().decode()):  # bytes lower A to Z alone
                    for word, n in Counter(RUN.findall(part)).items():
                        h = zlib.crc32(word.encode(), begun)
                        if h % damage == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < SHORTEST:
                                continue
                        held[word] += n
                if len(held) > HELD:
                    yield common.rows(made, list(held), list(held.values()))
                    held.clear()
        if held:
            yield common.rows(made, list(held), list(held.values()))

    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _keyed(rows: DataFrame) -> DataFrame:
    """A hash of what the words of a group agree in: class, first ``lo`` and last ``hi`` letters."""
    ends = F.when(F.col("hi") > 0, F.right("word", F.col("hi"))).otherwise("")
    return rows.withColumn("h", F.xxhash64("short", "lo", "hi", F.substring(F.col("word"), F.lit(1), F.col("lo")), ends))


def _groups(words: DataFrame) -> DataFrame:
    """(h, word, n, short, lo, hi, before): each word in the groups of its pairs.

    ``short`` is the length of the shorter word of the pairs, and their first difference lies before
    ``before``, as far as the group counts them.
    """
    size = F.char_length("word")
    split = F.explode(F.array(F.struct((F.lit(False)).alias("back")), F.struct((F.lit(True)).alias("back"))))
    rows = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("short")).where(F.col("short") >= SHORTEST).select("*", split.alias("s"))
    half = F.floor(F.col("short") / 2).cast("int")
    back = F.col("s.back")
    rows = rows.select("word", "n", "short", F.when(back, 0).otherwise(half).alias("lo"), F.when(back, F.col("short") - half).otherwise(0).alias("hi"), F.when(back, half).otherwise(F.col("short") + 1).alias("before"))
    rows, done = common.stored(_keyed(rows), "groups"), []
    while True:
        # what the shorter word has besides ends in common: of one place, no group is large
        large = rows.groupBy("h").agg(F.count("*").alias("words"), F.min(F.col("short") - F.col("lo") - F.col("hi")).alias("apart")).where((F.col("words") > GROUP) & (F.col("apart") > 1)).select("h")
        large = common.stored(large, "large")
        n = large.count()
        if not n:
            return _union([*done, rows])
        small = F.broadcast(large) if n <= BROADCAST else large
        done.append(rows.join(small, "h", "left_anti"))
        again = rows.join(small, "h", "left_semi").select("*", split.alias("s"))
        half = F.floor((F.col("short") - F.col("lo") - F.col("hi")) / 2).cast("int")
        again = again.select(
            "word", "n", "short", F.when(back, F.col("lo")).otherwise(F.col("lo") + half).alias("lo"),
            F.when(back, F.col("short") - F.col("lo") - half).otherwise(F.col("hi")).alias("hi"), F.when(back, F.col("lo") + half).otherwise(F.col("before")).alias("before"),
        )
        rows = common.stored(_keyed(again), "groups")


def _union(parts: list[DataFrame]) -> DataFrame:
    names = ["h", "word", "n", "short", "lo", "hi", "before"]
    out = parts[0].select(names)
    for p in parts[1:]:
        out = out.unionByName(p.select(names))
    return out


def _pairs_of(words: list[str], short: int, lo: int, hi: int, before: int) -> Iterator[tuple[int, int]]:
    """Near pairs that count in a group whose words agree in ``lo`` first and ``hi`` last letters."""
    middles = [w[lo : len(w) - hi] for w in words]
    for a, b in near(middles):
        u, v = words[a], words[b]
        if min(len(u), len(v)) == short and (before > short or u[:before] != v[:before]):
            yield a, b


def _tasks(words: DataFrame, schema: str, give) -> DataFrame:
    """``give(words, counts, pairs)`` for every group, all groups of a hash in one task."""
    together = _groups(words).repartition("h").sortWithinPartitions("h")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, held = None, []
        for batch in batches:
            columns = batch.to_pydict()
            for r in zip(columns["h"], columns["word"], columns["n"], columns["short"], columns["lo"], columns["hi"], columns["before"], strict=True):
                if r[0] != key:
                    if len(held) > 1:
                        yield from told(held)
                    key, held = r[0], []
                held.append(r)
        if len(held) > 1:
            yield from told(held)

    def told(rows: list[tuple]) -> Iterator[tuple]:
        by = defaultdict(list)
        for _, word, n, short, lo, hi, before in rows:
            by[short, lo, hi, before, word[:lo], word[len(word) - hi :]].append((word, n))
        for (short, lo, hi, before, *_), found in by.items():
            if len(found) > 1:
                words, counts = [w for w, _ in found], [n for _, n in found]
                yield from give(words, counts, _pairs_of(words, short, lo, hi, before))

    names = [f.split()[0] for f in schema.split(", ")]
    kinds = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in groups(batches):
            held.append(row)
            if len(held) >= 20_000:
                yield common.rows(kinds, *map(list, zip(*held, strict=True)))
                held = []
        yield common.rows(kinds, *(map(list, zip(*held, strict=True)) if held else [[]] * len(names)))

    return together.mapInArrow(run, schema)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near) for all near pairs of the ``word`` column, each once, the shorter or lesser first."""

    def give(words, counts, pairs):
        for a, b in pairs:
            yield tuple(sorted((words[a], words[b]), key=lambda w: (len(w), w)))

    return _tasks(words.select("word", F.lit(1).cast("long").alias("n")), "word string, near string", give)


def forms(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of words that have near ones: how many, and the most frequent of
    them.  A group hands on a sum and a best for each word, not its pairs."""

    def give(words, counts, pairs):
        number, best = Counter(), {}
        for a, b in pairs:
            for x, y in ((a, b), (b, a)):
                number[x] += 1
                rank = (-counts[y], words[y])
                if x not in best or rank < best[x]:
                    best[x] = rank
        for x, (n, word) in best.items():
            yield words[x], number[x], word, -n

    partial = _tasks(words, "word string, n_near long, form string, form_n long", give)
    best = F.min(F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("w")))
    return partial.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", F.col("best.w").alias("form"), (-F.col("best.n")).alias("form_n"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where the chain of (word, form) links ends.  Each round doubles the steps taken;
    a form has twice its word's occurrences at least, so six rounds do for any corpus."""
    to = common.stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = to.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        # the words that others point to are few among those that have a form themselves
        to = common.stored(to.join(ahead, to["root"] == ahead["_at"], "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if not to.where("moved").limit(1).count():
            return to.select("word", "root")
        to = to.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: int = DAMAGE, least: int = OCCURRENCES) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the documents."""
    words = common.stored(vocabulary(docs, key, text, damage, least), "words")
    told = common.stored(words.join(forms(words), "word", "left").withColumn("good", F.coalesce(F.col("form_n") >= 2 * F.col("n"), F.lit(False))), "forms")
    ends = roots(told.where("good").select("word", "form"))
    out = told.join(ends, "word", "left")
    kept = lambda c: F.when(F.col("good"), F.col(c)).alias(c)
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), kept("form"), kept("form_n"), F.coalesce("root", "word").alias("root"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(common.table(spark, sf_dir, "documents"))


#: Checksums by a table made of eight shifts, pairs by words less one letter, roots by recursion.
OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS steps
  FROM (SELECT i, list_reduce(range(8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) AS v FROM (SELECT unnest(range(256)) AS i))
), runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]{5,}')) AS run
  FROM documents
), per_document AS (
  SELECT k, run, count(*) AS c, hex(encode(k || ':' || run)) AS bytes FROM runs GROUP BY k, run
), hashed AS (
  SELECT run, c, xor(list_reduce(
    list_transform(range(1, length(bytes), 2), lambda i: CAST('0x' || substr(bytes, CAST(i AS INT), 2) AS BIGINT)),
    lambda x, b: xor(x >> 8, steps[CAST(xor(x, b) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM per_document, crc
), damaged AS (
  SELECT c, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3
), less AS (
  SELECT word, n, i, substr(word, 1, CAST(i - 1 AS INT)) || substr(word, CAST(i + 1 AS INT)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM pairs GROUP BY word
), told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n FROM words w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at, form AS next FROM told
  UNION ALL SELECT walk.word, told.word, told.form FROM walk JOIN told ON told.word = walk.next
)
SELECT told.word, form, walk.at AS root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM told JOIN walk ON walk.word = told.word AND walk.next IS NULL
"""
