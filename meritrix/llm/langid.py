"""Language identification with word-first backoff.

A text's words are scored by their log frequency in each language. A word that
the table does not hold is scored by its character n-grams instead: the longest
length of which the table knows any, then shorter ones.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import carried, forget_state, map_batches, pieces, share_code, task, utf8, worker_state
from meritrix.session import stored

#: Size of the model: the most frequent words and n-grams of all languages. Counts
#: cover all training rows; the bounds keep the broadcast model within some 30 MB.
WORDS = 50_000
GRAMS = 60_000
LONGEST = 5
#: Partial counts and cached scores in a Python worker.
FLUSH = 200_000
CACHE_SIZE = 500_000
UNDETERMINED = "und"
#: A language knows a word that has at least this share of its words. The share does
#: not fall as the corpus grows, so chance finds do not add up to knowledge.
LEAST_FREQUENCY = 1e-5
#: Share of a foreign text's words taken as known, where the learned languages show less.
LEAST_FOREIGN = 0.1

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with its borders marked."""
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if len(marked) >= n else []


@dataclass(frozen=True)
class Model:
    """Log frequencies by language for known words and n-grams; which words each
    language knows, and the share of known words that its texts reach."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray  # one row per word, then one per n-gram
    known: np.ndarray | None = None  # one row per word, and a last one for all others
    bounds: np.ndarray | None = None  # one per language; None: every text reaches it

    def rows(self, words: list[str]) -> np.ndarray:
        """Scores of words: their own where the table holds them, else the mean over
        their known n-grams of the longest length of which any is known; zeros where
        not even one letter is known."""
        known, counts, grams = [], [], self.grams
        for word in words:
            at = self.words.get(word)
            found = [] if at is None else [at]
            n = LONGEST
            while not found and n:
                found = [grams[g] for g in grams_of(word, n) if g in grams and g not in "^$"]
                n -= 1
            known += found
            counts.append(len(found))
        counts = np.array(counts)
        out = np.zeros((len(words), len(self.langs)), np.float32)
        if known:
            sums = np.add.reduceat(self.scores[known], np.concatenate([[0], np.cumsum(counts[counts > 0])[:-1]]), axis=0)
            out[counts > 0] = sums / counts[counts > 0, None]
        return out


class _Rows:
    """Words to their rows in a growing matrix of scores."""

    def __init__(self, model: Model):
        self.model, self.at = model, {}
        self.matrix = np.zeros((1024, len(model.langs)), np.float32)
        self.known = np.zeros((1024, len(model.langs)), bool)

    def places(self, words: list[str]) -> np.ndarray:
        """Rows of the words; the cache starts anew when it has grown too large."""
        if len(self.at) > CACHE_SIZE:
            self.at.clear()
        new = list(set(words).difference(self.at))
        if new:
            first = len(self.at)
            while first + len(new) > len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
                self.known = np.concatenate([self.known, np.zeros_like(self.known)])
            self.matrix[first:first + len(new)] = self.model.rows(new)
            if self.model.known is not None:
                self.known[first:first + len(new)] = self.model.known[[self.model.words.get(w, -1) for w in new]]
            self.at.update(zip(new, range(first, first + len(new))))
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def judge(self, words: list[str]) -> tuple[int, float, bool]:
        """Best language, its share of the likelihoods, and whether it knows enough
        of the words: no less than its bound, but for one standard error."""
        at = self.places(words)
        sums = self.matrix[at].sum(axis=0, dtype=np.float64)
        best = int(sums.argmax())
        score = float(1 / np.exp(sums - sums[best]).sum())
        if self.model.bounds is None:
            return best, score, True
        bound, share = self.model.bounds[best], np.count_nonzero(self.known[at, best]) / len(words)
        return best, score, bool(share + math.sqrt(bound * (1 - bound) / len(words)) >= bound)


def _counted(frame: DataFrame, keys: str, count) -> DataFrame:
    """Sums of partial counts: ``count(batch, counts)`` adds to a Counter that a
    task hands on whenever it has grown to FLUSH keys."""
    share_code(frame.sparkSession)
    schema = pa.schema([("lang", pa.string()), (keys, pa.string()), ("n", pa.int64())])

    def run(batches):
        forget_state()
        counts: Counter = Counter()
        for batch in pieces(batches):
            count(batch, counts)
            if len(counts) > FLUSH:
                yield _flat(counts, schema)
                counts = Counter()
        if counts:
            yield _flat(counts, schema)

    return (frame.mapInArrow(task(run), f"lang string, {keys} string, n bigint")
            .groupBy("lang", keys).agg(F.sum("n").alias("n")))


def _flat(counts: Counter, schema: pa.Schema) -> pa.RecordBatch:
    langs, keys = zip(*counts)
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(keys, pa.string()), pa.array(counts.values(), pa.int64())],
        schema=schema)


def _count_words(batch: pa.RecordBatch, counts: Counter) -> None:
    by_lang: dict[str, Counter] = defaultdict(Counter)
    for lang, raw in zip(batch.column("lang").to_pylist(), utf8(batch, "text")):
        by_lang[lang].update(words_of(raw.decode()))
    for lang, words in by_lang.items():
        for word, n in words.items():
            counts[lang, word] += n


def _count_grams(batch: pa.RecordBatch, counts: Counter) -> None:
    for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
        for length in range(1, LONGEST + 1):
            for gram in grams_of(word, length):
                counts[lang, gram] += n


def _table(counts: DataFrame, key: str, size: int) -> dict[str, dict[str, int]]:
    """Counts by language of the ``size`` keys with the largest totals."""
    top = (counts.groupBy(key).agg(F.sum("n").alias("total"), F.map_from_entries(
        F.collect_list(F.struct("lang", "n"))).alias("by_lang"))  # one entry per language
        .orderBy(F.desc("total"), key).limit(size))
    return {row[key]: row.by_lang for row in top.collect()}


def _knowledge(word_counts: dict[str, dict[str, int]], totals: dict[str, int],
               langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words known by language, and by language the bound on a text's known share:
    the geometric mean of what unseen texts of its own reach (occurrences of words
    met more than once) and of what the learned languages know of each other at most."""
    n = np.array([[by_lang.get(x, 0) for x in langs] for by_lang in word_counts.values()], float).reshape(len(word_counts), len(langs))
    sums = np.array([totals[x] for x in langs], float)
    known = (n > 0) & (n >= LEAST_FREQUENCY * sums)
    own = (n * (known & (n > 1))).sum(axis=0) / sums
    met = n.T @ known / sums[:, None]
    np.fill_diagonal(met, 0)
    bounds = np.minimum(own, np.sqrt(own * met.max(initial=LEAST_FOREIGN)))
    return np.concatenate([known, np.zeros((1, len(langs)), bool)]), bounds


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Counts words over all given rows, then n-grams over the word counts. Rows
    with a null text or language teach nothing; without any row the model is empty."""
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    words = stored(_counted(rows.where("text IS NOT NULL AND lang IS NOT NULL"), "word", _count_words))
    word_counts = _table(words, "word", WORDS)
    gram_counts = _table(_counted(words, "gram", _count_grams), "gram", GRAMS)
    totals = {r.lang: r.n for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    gram_totals = Counter()
    for by_lang in gram_counts.values():
        gram_totals.update(by_lang)
    scores = np.zeros((len(word_counts) + len(gram_counts), len(langs)), np.float32)
    for table, first, sums in ((word_counts, 0, totals), (gram_counts, len(word_counts), gram_totals)):
        for i, by_lang in enumerate(table.values(), first):
            scores[i] = [math.log((by_lang.get(x, 0) + 0.5) / (sums.get(x, 0) + 0.5 * len(table))) for x in langs]
    scores -= scores.max(axis=1, keepdims=True) if len(langs) else 0  # only differences count
    return Model(langs, {w: i for i, w in enumerate(word_counts)},
                 {g: i for i, g in enumerate(gram_counts, len(word_counts))}, scores,
                 *_knowledge(word_counts, totals, langs))


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, lang_pred, score, known) for every row; ``score`` is the share
    of the best language in the summed likelihoods. It is near 1 for any longer text,
    whatever its language: ``known`` tells that the best language knows as large a share
    of the words as its texts do, so false is a text of no learned language.

    ``und`` with score 0, not known, goes to a null text, to one without a letter, and to all
    texts when the model is empty. Of equal scores the first language by name wins.
    Repeated rows and null ids stay; columns not named in ``keep`` are ignored; an empty
    table gives no rows. A text is held whole in one task, with some 60 bytes a word.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = "langid:" + hashlib.sha256(pickle.dumps((model.langs, list(model.words), list(model.grams)))
                                     + model.scores.tobytes() + pickle.dumps((model.known, model.bounds))).hexdigest()
    columns = (id_col, *keep)
    judged, extra = carried(docs, text, keep, "text_to_judge")
    narrow = docs.select(*columns, *extra)

    def one(rows: _Rows, raw: bytes) -> tuple[str, float, bool]:
        words = words_of(raw.decode())
        if not rows.model.langs or not any(c.isalpha() for word in words for c in word):
            return UNDETERMINED, 0.0, False
        best, score, known = rows.judge(words)
        return rows.model.langs[best], score, known

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = worker_state(key, lambda: _Rows(shared.value))
        found = [one(rows, raw) for raw in utf8(batch, judged)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), pa.array([f[0] for f in found], pa.string()),
             pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_())],
            [*columns, "lang_pred", "score", "known"])

    kinds = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in columns)
    return map_batches(narrow, work, f"{kinds}, lang_pred string, score double, known boolean")


def training_rows(docs: DataFrame, fold_of_id: Column, held_out: int) -> DataFrame:
    """Rows outside the held-out fold; rows without an id belong to no fold and are left out."""
    return docs.where(fold_of_id != held_out)
