"""Benchmark decontamination by multi-pattern search over words.

Wu-Manber over words instead of letters: for each length of pattern, a table of
two-word blocks tells how far the search may jump; where it may not, the block
selects a bucket of patterns, the first word narrows it, and a direct comparison
confirms. A text of n words costs about n / 9 steps for windows of ten words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import carried, map_batches, share_code, utf8
from meritrix.session import stored

#: Benchmark text in one broadcast block; larger benchmarks take several passes.
BLOCK_BYTES = 2 << 20
#: Passes in one Spark job before the state is written out.
PASSES_PER_JOB = 4

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_SPLIT = bytes(c if c in _WORD else ord(" ") for c in bytes(range(256)).lower())


def words_of(raw: bytes) -> list[bytes]:
    """Lower-case words: runs of digits, a to z and whatever is outside ASCII."""
    return raw.translate(_SPLIT).split()


class WordPatterns:
    """All patterns of one length, as (item's words, start, item)."""

    def __init__(self, length: int):
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shifts: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[bytes, list]] = defaultdict(lambda: defaultdict(list))

    def add(self, words: list[bytes], start: int, item: str | None) -> None:
        end, block = start + self.length, self.block
        for distance in range(self.jump):
            key = tuple(words[end - distance - block:end - distance])
            if distance < self.shifts.get(key, self.jump):
                self.shifts[key] = distance
        found = self.buckets[tuple(words[end - block:end])][words[start]]
        for other, at, items in found:
            if other[at:at + self.length] == words[start:end]:
                items.add(item)
                return
        found.append((words, start, {item}))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set]]:
        """(start, items) of each occurrence, in order of the start."""
        length, block, jump, shift, buckets = self.length, self.block, self.jump, self.shifts.get, self.buckets
        end, n = length, len(words)
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            distance = shift(key, jump)
            if distance:
                end += distance
                continue
            start = end - length
            for other, at, items in buckets[key].get(words[start], ()):
                if other[at:at + length] == words[start:end]:
                    yield start, items
            end += 1


class Index:
    """The windows of a block of items, by length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        self.lengths: dict[int, WordPatterns] = {}
        for item, raw in items:
            words = words_of(raw)
            length = min(window, len(words))
            if length:
                patterns = self.lengths.setdefault(length, WordPatterns(length))
                for start in range(len(words) - length + 1):
                    patterns.add(words, start, item)

    def hits(self, words: list[bytes], mask: bytearray, items: set) -> None:
        for length, patterns in self.lengths.items():
            mark = b"\1" * length
            for start, found in patterns.search(words):
                mask[start:start + length] = mark
                items |= found


def _blocks(benchmark: DataFrame, item_col: str, text: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """Items in blocks of about BLOCK_BYTES; the driver holds one partition and one block."""
    rows = benchmark.select(F.col(item_col).cast("string"), F.col(text).cast("string")).where(F.col(text).isNotNull())
    block, size = [], 0
    for item, value in rows.toLocalIterator():
        raw = value.encode()
        if block and size + len(raw) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((item, raw))
        size += len(raw)
    yield block


def _spans(mask: bytearray) -> list[int]:
    """Start and end of each run of hit words, flat."""
    spans, at = [], mask.find(1)
    while at >= 0:
        end = mask.find(0, at)
        end = len(mask) if end < 0 else end
        spans += (at, end)
        at = mask.find(1, end)
    return spans


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id",
                       item_col: str = "item_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, n_words, n_hit, spans, items, contaminated) for every row.

    ``spans`` are the runs of hit words (start, end, flat), ``items`` the sorted
    ids, as strings, of the items with an occurring window. Each block of the
    benchmark takes one pass over the texts, which moves no row.

    A null or empty text has no words; an item without words matches nothing; an
    item with a null id marks words but is not listed; repeated items count once.
    Columns not named in ``keep`` are ignored. Empty tables give no rows or no hits.
    Repeated rows stay. A text is held whole in one task, with some 60 bytes a word.
    """
    share_code(docs.sparkSession)
    kept = (id_col, *keep)
    searched, extra = carried(docs, text, keep, "text_to_search")
    state = docs.select(*kept, *extra,
                        F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    kinds = ", ".join(f"`{c}` {state.schema[c].dataType.simpleString()}" for c in kept)
    kinds += ", text_to_search string" if extra else ""
    schema = f"{kinds}, spans array<int>, items array<string>, n_words bigint, n_hit bigint"
    for number, block in enumerate(_blocks(benchmark, item_col, text)):
        if number:
            state = state.drop("n_words", "n_hit")
        if number and number % PASSES_PER_JOB == 0:
            state = stored(state)
        state = map_batches(state, _pass(docs.sparkSession, (*kept, searched) if extra else kept, searched, block, window), schema)
    return state.select(*kept, "n_words", "n_hit", "spans", "items", (F.col("n_hit") > 0).alias("contaminated"))


def _pass(spark, carried_on: tuple[str, ...], searched: str, block: list, window: int):
    """One block against a batch of texts. The index is built once per task."""
    shared, built = spark.sparkContext.broadcast(block), []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not built:
            built.append(Index(shared.value, window))
        index, spans, items, n_words, n_hit = built[0], [], [], [], []
        for raw, old, known in zip(utf8(batch, searched), batch.column("spans").to_pylist(),
                                   batch.column("items").to_pylist()):
            words, found = words_of(raw), set(known)
            mask = bytearray(len(words))
            for start, end in zip(old[::2], old[1::2]):
                mask[start:end] = b"\1" * (end - start)
            index.hits(words, mask, found)
            spans.append(_spans(mask))
            items.append(sorted(found - {None}))
            n_words.append(len(words))
            n_hit.append(mask.count(1))
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in carried_on), pa.array(spans, pa.list_(pa.int32())),
             pa.array(items, pa.list_(pa.string())), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64())],
            [*carried_on, "spans", "items", "n_words", "n_hit"])

    return work


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and the digest of the item list."""
    return found.select(
        id_col, "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")
