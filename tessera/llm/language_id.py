"""Language ID by segmentation-marginalised unigrams (operator 5).

Each language has a probability for every piece of a fixed public vocabulary.  The probability of
a word is the sum over all its segmentations into pieces, by a forward pass over the piece
lattice; a text is the product of its words.  The piece probabilities are fitted by expectation
maximisation on a bounded sample of labelled texts.

Words are runs of letters (all that isn't ASCII counts as one), lower-cased in ASCII, each behind a
space; a script without spaces makes long words, which are scored whole and learned from in parts.
Words repeat, so a worker scores a word once and adds up by document.  A text of any length is
scored whole.

Defined results: a null text or one without a letter is ``und`` with score 0; a table without
labelled rows to learn from makes every text ``und``; a repeated row is predicted again; columns
other than the three that are named are never read; a null ``doc_id`` is predicted and is held out
of nothing.  Languages that tie are decided for the first by name.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, kernels
from tessera.llm.lattice import Vocabulary, edges, prefixed, rectangles

#: Bounds of the training sample: texts of each language, those with the least hashed ids, and their characters altogether.
SAMPLE_DOCS, SAMPLE_CHARS = 200, 1 << 22
ROUNDS = 3
#: Pseudo-count of each piece in each language.
SMOOTHING = 0.02
#: Each byte's probability is multiplied by this, so that long words stay within doubles.
LIFT = float(np.exp(2.0))
UNKNOWN = "und"
#: Bytes of a word that pieces are learned from at a time; a longer one is cut between characters.
LONGEST = 180
#: Scores of that many words are remembered by a worker; beyond it starts afresh.
REMEMBERED = 300_000
#: Bytes of text that are scored at a time.
PIECE_BYTES = 1 << 19


@dataclass
class LanguageModel:
    languages: list[str]
    #: (pieces + 1, languages); the last row, for no piece, is 0.
    probability: np.ndarray
    vocabulary: str


def _lifted(v: Vocabulary, probability: np.ndarray) -> np.ndarray:
    size = np.array([len(t) for t in v.texts] + [0], float)
    return probability * LIFT ** size[:, None]


def forward(v: Vocabulary, lifted: np.ndarray, raw: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Log probability of each word (rows) in each language (columns), all segmentations summed."""
    groups = lifted.shape[1]
    prefix = v.roll.prefix(raw)
    out = np.zeros((len(start), groups))
    for size, part in rectangles(start, length):
        alpha = np.zeros((size + 1, len(part), groups))
        alpha[0] = 1
        scale = np.zeros(len(part))
        lattice = deque(edges(v.matches(prefix, raw, start[part], size)))
        ending = np.argsort(length[part], kind="stable")
        ends = np.searchsorted(length[part][ending], np.arange(size + 2))
        for j in range(1, size + 1):
            while lattice and lattice[0][0] == j:
                _, n, some, piece = lattice.popleft()
                alpha[j, some] += alpha[j - n, some] * lifted[piece]
            if j % 16 == 0:  # what is still needed is scaled alike in all languages
                low = max(0, j - v.longest)
                top = alpha[low : j + 1].max(axis=(0, 2))
                top[top == 0] = 1
                alpha[low : j + 1] /= top[:, None]
                scale += np.log(top)
            if ends[j] < ends[j + 1]:  # words that end here
                own = ending[ends[j] : ends[j + 1]]
                with np.errstate(divide="ignore"):
                    out[part[own]] = np.maximum(np.log(alpha[j, own]), -700.0) + scale[own, None] - j * np.log(LIFT)
    return out


def in_parts(raw: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word) of the words, those of more bytes than ``most`` cut between characters."""
    of = np.arange(len(start))
    while (end - start > most).any():
        long = np.flatnonzero(end - start > most)
        cut = start[long] + most
        for _ in range(3):  # not inside a character of UTF-8
            cut = cut - ((raw[cut] & 0xC0) == 0x80)
        start, end, of = np.concatenate([start, cut]), np.concatenate([end, end[long]]), np.concatenate([of, of[long]])
        end[long] = cut
    order = np.lexsort((start, of))
    return start[order], end[order], of[order]


def fit(texts: list[str], labels: list[str], path: str, rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> LanguageModel:
    """Expectation maximisation of the piece probabilities of each language."""
    v = Vocabulary(path)
    languages = sorted(set(labels))
    groups = len(languages)
    usable = np.ones(v.size + 1)
    usable[-1] = 0
    p = np.repeat((usable / usable.sum())[:, None], groups, axis=1)
    if not groups:
        return LanguageModel([], p, path)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])]).astype(np.int64)
    raw = kernels.ASCII_LOWER[np.frombuffer("".join(texts).encode(), np.uint8)]
    start, end, row = kernels.words(off, raw, kernels.NO_LETTER)
    if not len(start):
        return LanguageModel(languages, p, path)
    start, end, of = in_parts(raw, start, end)
    row = row[of]
    roll = kernels.Rolling(77)
    _, first, inv = np.unique(roll.spans(roll.prefix(raw), start, end), return_index=True, return_inverse=True)
    group = np.array([languages.index(x) for x in labels])[row]
    count = np.zeros((len(first), groups))
    np.add.at(count, (inv, group), 1)
    buf, begin, length = prefixed(raw, start[first], end[first])
    prefix = v.roll.prefix(buf)
    for _ in range(rounds):
        lifted = _lifted(v, p)
        expected = np.zeros_like(p)
        for size, part in rectangles(begin, length):
            lattice = list(edges(v.matches(prefix, buf, begin[part], size)))
            alpha, beta = np.zeros((size + 1, len(part), groups)), np.zeros((size + 1, len(part), groups))
            own = np.arange(len(part))
            alpha[0] = beta[length[part], own] = 1
            for j, n, some, piece in lattice:
                alpha[j, some] += alpha[j - n, some] * lifted[piece]
            for j, n, some, piece in reversed(lattice):
                beta[j - n, some] += beta[j, some] * lifted[piece]
            whole = alpha[length[part], own]
            weight = np.divide(count[part], whole, out=np.zeros_like(whole), where=whole > 0)
            for j, n, some, piece in lattice:
                np.add.at(expected, piece, alpha[j - n, some] * lifted[piece] * beta[j, some] * weight[some])
        p = (expected + smoothing) * usable[:, None]
        p /= p.sum(axis=0)
    return LanguageModel(languages, p, path)


class Scorer:
    """Scores batches of texts; the distinct words of each are scored once."""

    def __init__(self, model: LanguageModel):
        self.model, self.v = model, Vocabulary(model.vocabulary)
        self.lifted = _lifted(self.v, model.probability)
        self.roll = kernels.Rolling(77)
        self.keys, self.known = np.zeros(0, np.uint64), np.zeros((0, len(model.languages)))

    def score(self, off: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Log probability of each document (rows) in each language (columns)."""
        n, groups = len(off) - 1, len(self.model.languages)
        raw = kernels.ASCII_LOWER[raw]
        start, end, row = kernels.words(off, raw, kernels.NO_LETTER)
        if not len(start) or not groups:
            return np.zeros((n, groups))
        uniq, first, inv = np.unique(self.roll.spans(self.roll.prefix(raw), start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == uniq[known]
        if not known.all():
            if len(self.keys) > REMEMBERED:
                self.keys, self.known = self.keys[:0], self.known[:0]
                known[:] = False
            new = np.flatnonzero(~known)
            got = forward(self.v, self.lifted, *prefixed(raw, start[first[new]], end[first[new]]))
            where = np.searchsorted(self.keys, uniq[new])
            self.keys, self.known = np.insert(self.keys, where, uniq[new]), np.insert(self.known, where, got, axis=0)
            at = np.searchsorted(self.keys, uniq)
        word = self.known[at]
        return np.stack([np.bincount(row, weights=word[inv, g], minlength=n) for g in range(groups)], axis=1)


def _scorer(model: LanguageModel) -> Scorer:
    return common.resident(("scorer", id(model)), lambda: Scorer(model))  # the scorer holds its model, so the id stays its own


def has_letter(off: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Whether each text has a letter; only texts without an ASCII one are looked at by character."""
    low = raw | 0x20
    ascii_letter = np.concatenate([[0], np.cumsum((low >= 0x61) & (low <= 0x7A))])
    out = ascii_letter[off[1:]] > ascii_letter[off[:-1]]
    for k in np.flatnonzero(~out & (off[1:] > off[:-1])):
        out[k] = any(c.isalpha() for c in raw[off[k] : off[k + 1]].tobytes().decode("utf-8", "replace"))
    return out


def train(docs: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS, may_learn=None) -> LanguageModel:
    """Fit on at most ``sample_docs`` labelled texts of each language, of ``SAMPLE_CHARS`` altogether.

    The ids are chosen first, without their texts; the bounded list of ids then picks the texts, one
    for each id: of rows that share it, the one whose text has the least hash.  Texts that would take
    a language's sample over its characters are passed over, so a language with longer texts only isn't learned.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    if may_learn is not None:
        rows = rows.where(may_learn)
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}  # a row per language
    # hashed ids are even in [0, 1), so a threshold by language passes about twice the sample
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    least = F.coalesce(*[F.when(F.col("lang") == k, F.lit(2.0 * sample_docs / n + 1e-3 * (n < 1000))) for k, n in sorted(counts.items())]) if counts else F.lit(0.0)
    mark = F.xxhash64("text")
    some = rows.where(h < least).groupBy("lang", "doc_id").agg(h.alias("h"), F.min_by(F.char_length("text"), mark).alias("n"), F.min(mark).alias("t")).collect()
    chosen: dict[tuple, int] = {}
    for lang in counts:
        left, held = SAMPLE_CHARS, 0
        for r in sorted((x for x in some if x.lang == lang), key=lambda x: (x.h, x.doc_id)):
            if held < sample_docs and r.n <= left:
                left, held = left - r.n, held + 1
                chosen[lang, r.doc_id] = r.t
    ids = sorted({k for _, k in chosen})
    texts = rows.where(F.col("doc_id").isin(ids)).select("doc_id", "lang", "text", mark.alias("t")) if ids else None
    marks = docs.sparkSession.createDataFrame([(*k, t) for k, t in sorted(chosen.items())], f"lang string, doc_id {docs.schema['doc_id'].dataType.simpleString()}, t long") if ids else None
    picked = texts.join(F.broadcast(marks), ["lang", "doc_id", "t"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect() if ids else []  # a row for each id of the sample
    picked.sort(key=lambda r: (r[1], r[0], r[2]))
    return fit([r[2] for r in picked], [r[1] for r in picked], path)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, the posterior of that language."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # pieces x languages doubles: no part of it grows with the documents
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept) + ", lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scorer = _scorer(shared.value)
            names = np.array(scorer.model.languages or [UNKNOWN])
            where = batch.schema.get_field_index("text")
            for i, j, off, raw in kernels.pieces(batch.column(where), PIECE_BYTES):
                part = batch.slice(i, j - i)
                s = scorer.score(off, raw)
                known = has_letter(off, raw) & bool(len(scorer.model.languages))
                if s.shape[1]:
                    best = s.argmax(axis=1)
                    score = 1 / np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1)
                else:
                    best, score = np.zeros(len(s), int), np.zeros(len(s))
                pred = np.where(known, names[best], UNKNOWN)
                cols = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(pred.astype(str).tolist(), pa.string()), pa.array(np.where(known, score, 0.0))], [*kept, "lang_pred", "score"])
                common.release()
        common.trim()

    return docs.select(*kept).mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs, public_tokenizers.path("piece_bpe_32k.model"), may_learn=~held_out())
    return identify(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_known(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The documents whose language is known with at least that posterior, columns as they were."""
    found = identify(docs, model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*docs.columns)
