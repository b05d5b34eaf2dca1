"""Quality rules as a short-circuit cascade.

Each rule's cost and rejection rate are estimated on a sample; the rules then run
in the order of rejections per cost, and a text leaves at the first rule that
rejects it. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import map_batches, share_code, utf8

#: Rows of each partition in the sample that orders the rules.
SAMPLE_ROWS = 100
#: Words from which windows are compared as numbers instead of tuples.
MANY_WORDS = 20_000

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_LOWER = bytes(range(ord("a"), ord("z") + 1))


class Text:
    """One text; each measure is computed when a rule first asks for it."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points in words: those of the text without white space."""
        return len(self.raw.translate(None, _SPACE).decode())

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, _SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.raw.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        if len(words) >= MANY_WORDS:
            return _repeated_in_windows(words)
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        counts, covered = Counter(windows), bytearray(len(words))
        for i, window in enumerate(windows):
            if counts[window] > 1:
                covered[i] = covered[i + 1] = covered[i + 2] = 1
        return covered.count(1)

    @cached_property
    def upper_share(self) -> float:
        upper = len(self.raw) - len(self.raw.translate(None, _UPPER))
        lower = len(self.raw) - len(self.raw.translate(None, _LOWER))
        return upper / max(1, upper + lower)

    @cached_property
    def loud_marks(self) -> int:
        return self.raw.count(b"!!") + self.raw.count(b"??")


def _repeated_in_windows(words: list[bytes]) -> int:
    """Words in windows of three that occur twice or more, with a few numbers for each
    word: equal words, then equal pairs, then equal windows get the same number."""
    number: dict[bytes, int] = {}
    one = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    pairs = np.unique(one[:-1] * len(number) + one[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(number) + one[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= again
    return int(np.count_nonzero(covered))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a text that the rule throws out."""

    name: str
    rejects: Callable[[Text], bool]


#: The base rules, fixed by the operator's contract.
BASE_RULES = (
    Rule("few_words", lambda t: t.n_words < 50),
    Rule("repeated_windows", lambda t: 100 * t.n_repeat_words > 50 * t.n_words),
)
#: Further rules; their bounds lie far from what prose shows.
RULES = BASE_RULES + (
    Rule("symbols", lambda t: 100 * t.n_symbols > 20 * t.n_words),
    Rule("repeated_lines", lambda t: 100 * t.n_dup_lines > 50 * len(t.lines)),
    Rule("upper_case", lambda t: t.upper_share > 0.6),
    Rule("loud_marks", lambda t: 100 * t.loud_marks > 20 * t.n_words),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("one_word", lambda t: 100 * max(Counter(t.words).values(), default=0) > 30 * t.n_words),
)


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
             rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Rule to (seconds a text, share rejected), each rule on its own, over the first
    ``rows`` rows of every partition, summed by rule. Only the order of the rules
    depends on the sample."""
    share_code(docs.sparkSession)

    def measure(batches):
        seen, spent, rejected = 0, [0.0] * len(rules), [0] * len(rules)
        for batch in batches:
            raws = utf8(batch.slice(0, rows - seen), "text_to_judge")
            for i, rule in enumerate(rules):
                fresh = [Text(raw) for raw in raws]
                start = time.perf_counter()
                rejected[i] += sum(map(bool, map(rule.rejects, fresh)))
                spent[i] += time.perf_counter() - start
            seen += len(raws)
            if seen >= rows:
                break
        if seen:
            yield pa.RecordBatch.from_pydict({
                "rule": [r.name for r in rules], "spent": spent, "rejected": rejected, "n": [seen] * len(rules)})

    sample = docs.select(F.col(text).cast("string").alias("text_to_judge"))
    found = sample.mapInArrow(measure, "rule string, spent double, rejected bigint, n bigint")
    sums = found.groupBy("rule").agg(F.sum("spent").alias("spent"), F.sum("rejected").alias("rejected"), F.sum("n").alias("n"))
    return {r.rule: (r.spent / r.n, r.rejected / r.n) for r in sums.collect()}  # one row per rule


def ordered(rules: Sequence[Rule], estimates: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first; rules of equal gain keep their order, and those
    without an estimate stay last."""
    def gain(rule: Rule) -> float:
        cost, rejected = estimates.get(rule.name, (1.0, 0.0))
        return -rejected / max(cost, 1e-9)

    return sorted(rules, key=gain)


def verdict(text: Text, cascade: Sequence[Rule]) -> tuple[str | None, int]:
    """The first rule that rejects the text, and how many rules it has met."""
    for n, rule in enumerate(cascade, 1):
        if rule.rejects(text):
            return rule.name, n
    return None, len(cascade)


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, *, id_col: str = "doc_id", text: str = "text",
                keep: tuple[str, ...] = (), measures: bool = True) -> DataFrame:
    """(id, kept columns, kept, failed_rule, n_rules[, measures, base_failed]) for every row.

    A text meets the rules of the cascade, ``n_rules`` of them, up to the first that
    rejects it, and costs no more than these. With ``measures`` the base measures, and
    with them ``base_failed``, are reported for every text, so that each is measured.
    ``failed_rule`` is the one that the cascade met first, so it may change with
    the order; ``kept`` does not. A null or empty text has no words and fails.
    Repeated rows and null ids stay; columns not named in ``keep`` are ignored; an empty
    table gives no rows, its rules stay in their order. A text is held whole in one
    task, with some 100 bytes for each of its words.
    """
    cascade = ordered(rules, estimate(docs, rules, text))
    columns = (id_col, *keep)
    narrow = docs.select(*columns, F.col(text).cast("string").alias("text_to_judge"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") if measures else ()

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        values: list[list] = [[] for _ in names]
        base, failed, met = [], [], []
        for raw in utf8(batch, "text_to_judge"):
            text_ = Text(raw)
            name, n = verdict(text_, cascade)
            failed.append(name)
            met.append(n)
            if measures:  # a rule asks for a measure once, whoever asks first
                base.append(verdict(text_, BASE_RULES)[0] is not None)
                for column, name in zip(values, names):
                    column.append(getattr(text_, name))
        kept = [f is None and not b for f, b in zip(failed, base)] if measures else [f is None for f in failed]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in columns), pa.array(kept, pa.bool_()), pa.array(failed, pa.string()), pa.array(met, pa.int32()),
             *(pa.array(v, pa.int64()) for v in values), *([pa.array(base, pa.bool_())] if measures else [])],
            [*columns, "kept", "failed_rule", "n_rules", *names, *(["base_failed"] if measures else [])])

    kinds = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in columns)
    measured = "".join(f", {name} bigint" for name in names) + (", base_failed boolean" if measures else "")
    return map_batches(narrow, work, f"{kinds}, kept boolean, failed_rule string, n_rules int{measured}")
