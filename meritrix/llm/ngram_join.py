"""Exact Jaccard self-join of documents on word n-grams, vertically partitioned.

All n-grams stand in one global order, rare ones first; the order is cut into
fragments of about equal load, and a pair's overlap is counted fragment by fragment
and summed. Only candidate pairs are counted: documents whose rarest n-grams (their
prefixes) meet, at positions and with sizes that still allow the threshold.

How rare an n-gram is comes from counts over all documents in a fixed number of
hash buckets: n-grams that stand out by their own count (those of copies and shared
passages) come last, by that count; all others are ordered by the counts of their
words, so that those with rare words come first. Any total order keeps the prefix
filter exact; a good one keeps posting lists short.

For components it is not needed to count every pair of a group of near copies:
first each document of a posting list is counted against the list's most central
one, and then only pairs of lists that still meet across components.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meritrix.llm.tasks import forget_state, map_batches, pieces, share_code, task, utf8
from meritrix.session import stored

#: log2 of the buckets that n-grams are counted in, of those for words, of those of
#: a filter of classes, and the slices that bucket arrays travel in.
COUNT_BITS = 22
WORD_BITS = 20
FILTER_BITS = 24
SLICES = 64
FRAGMENTS = 8
#: Bytes of a text that are hashed at once.
PIECE = 1 << 20

_random = np.random.default_rng(20240601)
_BYTE_HASH = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
                      for base in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word, A to Z lower-cased. A word's hash is its part of
    a running polynomial over the bytes, moved back to the word's start."""
    if len(raw) > PIECE:
        parts, at = [], 0
        while at < len(raw):
            end = min(at + PIECE, len(raw))
            while end < len(raw) and not _SPACE[raw[end]]:
                end += 1
            parts.append(_hash_words(raw[at:end]))
            at = end
        return np.concatenate(parts)
    return _hash_words(raw)


def _hash_words(raw: bytes) -> np.ndarray:
    codes = np.frombuffer(raw.lower(), np.uint8)
    inside = np.concatenate([[False], ~_SPACE[codes], [False]])
    borders = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = borders[::2], borders[1::2]
    powers, inverse = _power_tables(len(codes) + 1)
    running = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE_HASH[codes] * powers[:len(codes)], out=running[1:], dtype=np.uint64)
    return _mix((running[ends] - running[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def _windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n words; of the whole sequence where it is shorter."""
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = total + words[i:len(words) - width + 1 + i] * _PLACE[i]
    return _mix(total)


def shingles(raw: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; nothing without words."""
    words = word_hashes(raw)
    return np.unique(_windows(words, n)) if len(words) else words


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def class_id(grams: np.ndarray) -> bytes:
    """96-bit name of a set; equal sets are one class."""
    return hashlib.blake2b(grams.tobytes(), digest_size=12).digest()


@dataclass(frozen=True)
class Order:
    """The global order: by ``standing`` of the n-gram's bucket (0: it does not stand
    out), then by the sum of its words' ``levels``, then by hash. ``cuts`` are the
    sums where a new fragment starts."""

    n: int
    standing: np.ndarray
    levels: np.ndarray
    cuts: np.ndarray

    @classmethod
    def of(cls, gram_counts: np.ndarray, word_counts: np.ndarray, n: int) -> Order:
        """A bucket stands out when its count is four deviations above the mean. A
        word's level is four times the logarithm of its bucket's count. Fragments
        are cut where sums of n independent levels have equal shares."""
        mean = gram_counts.mean()
        out = gram_counts > mean + 4 * np.sqrt(mean) + 1
        standing = np.where(out, 1 + np.minimum(2 * np.log2(np.maximum(gram_counts, 1)), 120), 0).astype(np.uint8)
        levels = (4 * np.log2(word_counts + 1)).astype(np.uint8)
        share = np.bincount(levels, weights=word_counts, minlength=1)
        share = share / max(1.0, share.sum())
        sums = share
        for _ in range(n - 1):
            sums = np.convolve(sums, share)
        cuts = np.searchsorted(np.cumsum(sums), np.arange(1, FRAGMENTS) / FRAGMENTS)
        return cls(n, standing, levels, cuts)

    def ranked(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct n-grams of a text and the sums of their words' levels."""
        words = word_hashes(raw)
        if not len(words):
            return words, np.zeros(0, np.uint64)
        level, width = self.levels[_bucket(words, WORD_BITS)].astype(np.uint64), min(self.n, len(words))
        sums = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            sums += level[i:len(words) - width + 1 + i]
        grams, at = np.unique(_windows(words, self.n), return_index=True)
        return grams, sums[at]

    def prefix(self, grams: np.ndarray, sums: np.ndarray, length: int) -> np.ndarray:
        """The first n-grams; those with equal keys keep the order of their hashes."""
        standing = self.standing[_bucket(grams, COUNT_BITS)].astype(np.uint64)
        keys = (standing << np.uint64(56)) | (sums << np.uint64(40)) | (grams >> np.uint64(24))
        return grams[np.argsort(keys, kind="stable")[:length]]

    def fragments(self, grams: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The fragment of each n-gram; those that stand out are in the last one."""
        fragment = np.searchsorted(self.cuts, sums.astype(np.int64), side="right")
        fragment[self.standing[_bucket(grams, COUNT_BITS)] > 0] = FRAGMENTS - 1
        return fragment


def _slices(counts: np.ndarray) -> tuple[list[int], list[bytes]]:
    """The slices that are not empty, packed."""
    parts = counts.reshape(SLICES, -1)
    at = [i for i in range(SLICES) if parts[i].any()]
    return at, [zlib.compress(parts[i].tobytes(), 1) for i in at]


def bucket_sums(packed: DataFrame, bits: int, given: type = np.uint32, kind: type = np.int64, add=np.add) -> np.ndarray:
    """Sum of packed (slice, counts) rows, whose counts are of the type ``given``. Rows of
    a slice meet in one task, which adds them one after the other as ``kind``; the
    driver receives 2**bits packed counts."""
    share_code(packed.sparkSession)
    schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])

    def sums_of(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, counts in zip(batch.column("slice").to_pylist(), batch.column("counts").to_pylist()):
                more = np.frombuffer(zlib.decompress(counts), given).astype(kind)
                sums[at] = add(sums[at], more) if at in sums else more
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(s.tobytes(), 1) for s in sums.values()], pa.binary())],
            schema=schema)

    total = np.zeros((SLICES, (1 << bits) // SLICES), kind)
    added = packed.repartition(SLICES, "slice").mapInArrow(task(sums_of), "slice int, counts binary")
    for row in added.collect():  # one row per slice
        total[row.slice] = np.frombuffer(zlib.decompress(row.counts), kind)
    return total.reshape(-1)


def _measured(docs: DataFrame, n: int) -> DataFrame:
    """First pass over the texts: one row per document with size and class, and per
    task the packed bucket counts of its documents' n-grams, then of their words."""
    share_code(docs.sparkSession)
    kind, names = docs.schema["doc_id"].dataType.simpleString(), ["doc_id", "n", "class", "slice", "counts"]

    def run(batches):
        forget_state()
        counts, id_type = [np.zeros(1 << bits, np.uint32) for bits in (COUNT_BITS, WORD_BITS)], None
        for batch in pieces(batches):
            words = [word_hashes(raw) for raw in utf8(batch, "text")]
            sets = [np.unique(_windows(w, n)) if len(w) else w for w in words]
            for total, hashes, bits in zip(counts, (sets, words), (COUNT_BITS, WORD_BITS)):
                buckets, seen = np.unique(_bucket(np.concatenate(hashes), bits), return_counts=True)
                total[buckets] += seen.astype(np.uint32)
            id_type = batch.column("doc_id").type
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_id(s) if len(s) else None for s in sets], pa.binary()),
                 pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        for kind_of, total in enumerate(counts):  # the slices of words are numbered after those of n-grams
            at, packed = _slices(total)
            if at:  # only after a batch
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(at), id_type), pa.nulls(len(at), pa.int64()), pa.nulls(len(at), pa.binary()),
                     pa.array([a + kind_of * SLICES for a in at], pa.int32()), pa.array(packed, pa.binary())], names)

    return docs.mapInArrow(task(run), f"doc_id {kind}, n bigint, class binary, slice int, counts binary")


def _prefixes(docs: DataFrame, order, percent: int) -> DataFrame:
    """Second pass: (class, n, prefix) of each document with words."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ranked = [r for raw in utf8(batch, "text") if len((r := order.value.ranked(raw))[0])]
        sets = [grams for grams, _ in ranked]
        lengths = [len(s) - -(-percent * len(s) // 100) + 1 for s in sets]
        prefixes = [order.value.prefix(*r, k).view(np.int64) for r, k in zip(ranked, lengths)]
        flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([class_id(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int32()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["class", "n", "prefix"])

    return map_batches(docs, work, "class binary, n int, prefix array<bigint>")


class Filter:
    """Classes by their bucket: a bit array of fixed size that holds all members
    and lets some others through."""

    def __init__(self, members: DataFrame):
        """``members`` has a column ``class``; its tasks hand on packed buckets."""
        share_code(members.sparkSession)

        def mark(batches):
            counts = np.zeros(1 << FILTER_BITS, np.uint8)
            for batch in batches:
                counts[[_class_bucket(c) for c in batch.column("class").to_pylist()]] = 1
            at, packed = _slices(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(packed, pa.binary())], ["slice", "counts"])

        marks = members.select("class").mapInArrow(task(mark), "slice int, counts binary")
        marked = bucket_sums(marks, FILTER_BITS, np.uint8, np.uint8, np.maximum) > 0
        self.bits = members.sparkSession.sparkContext.broadcast(np.packbits(marked))

    def passes(self, name: bytes) -> bool:
        at = _class_bucket(name)
        return bool(self.bits.value[at >> 3] & (128 >> (at & 7)))

    def rows(self, frame: DataFrame) -> DataFrame:
        """The rows of ``frame`` whose class passes."""
        passes = self.passes

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([passes(c) for c in batch.column("class").to_pylist()], pa.bool_()))

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)
        return map_batches(frame, work, schema)


def _class_bucket(name: bytes) -> int:
    return int.from_bytes(name[:8], "little") >> (64 - FILTER_BITS)


def _fragments(docs: DataFrame, order, wanted: Filter) -> DataFrame:
    """Third pass: (class, fragment, grams) of the documents whose class passes;
    copies repeat their rows."""
    passes = wanted.passes

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, places, parts = [], [], []
        for raw in utf8(batch, "text"):
            grams, sums = order.value.ranked(raw)
            if not len(grams) or not passes(name := class_id(grams)):
                continue
            fragment = order.value.fragments(grams, sums)
            for at in np.unique(fragment):
                names.append(name)
                places.append(int(at))
                parts.append(grams[fragment == at].view(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.binary()), pa.array(places, pa.int32()), pa.array(parts, pa.list_(pa.int64()))],
            ["class", "fragment", "grams"])

    return map_batches(docs, work, "class binary, fragment int, grams array<bigint>")


def _allowed(percent: int, a: str, b: str) -> Column:
    """Sizes and the positions of a shared n-gram leave room for the overlap."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    rest = F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (
        rest * (100 + percent) >= percent * (na + nb))


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()


def _pair() -> list[Column]:
    """Columns a, b, na, nb of a pair of structs x and y."""
    return [F.col("x.class").alias("a"), F.col("y.class").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")]


class Join:
    """The state of one self-join: sizes and classes of all documents, the global
    order, and the posting lists of the prefixes that hold two classes or more."""

    def __init__(self, docs: DataFrame, n: int, percent: int, *, id_col: str = "doc_id", text: str = "text"):
        if not (1 <= n <= len(_PLACE) and 1 <= percent <= 100):
            raise ValueError("n must be 1 to 64 and percent 1 to 100")
        self.percent = percent
        self.docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
        measured = stored(_measured(self.docs, n))
        grams, words = F.col("slice") < SLICES, F.col("slice") >= SLICES
        self.order = docs.sparkSession.sparkContext.broadcast(Order.of(
            bucket_sums(measured.where(grams).select("slice", "counts"), COUNT_BITS),
            bucket_sums(measured.where(words).select((F.col("slice") - SLICES).alias("slice"), "counts"), WORD_BITS), n))
        self.rows = measured.where("slice IS NULL").select("doc_id", "n", "class")
        sets = _prefixes(self.docs, self.order, percent).groupBy("class").agg(
            F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"))
        postings = sets.select("class", "n", F.posexplode("prefix").alias("pos", "gram"))
        lists = Window.partitionBy("gram")
        self.postings = stored(
            postings.withColumn("listed", F.count(F.lit(1)).over(lists))
            .withColumn("center", F.first(F.struct("pos", "n", "class")).over(lists.orderBy("pos", "n", "class")))
            .where("listed > 1").drop("listed"))
        self.parts: DataFrame | None = None
        self.known: DataFrame | None = None

    def to_centers(self) -> DataFrame:
        """Candidate pairs of each document with the central one of each list: the
        one with the fewest rarer n-grams."""
        one, other = F.struct("class", "n"), F.struct("center.class", "center.n")
        return (self.postings.alias("q")
                .where((F.col("class") != F.col("center.class")) & _allowed(self.percent, "q", "center"))
                .select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y"))
                .select(*_pair()).distinct())

    def across(self, component: DataFrame | None) -> DataFrame:
        """Candidate pairs of all lists; with ``component`` (id, component) only
        those between different components, in lists that hold several."""
        p = self.postings.drop("center")
        if component is None:
            p = p.withColumn("component", F.col("class"))
        else:
            p = p.join(component.withColumnRenamed("id", "class"), "class", "left").withColumn(
                "component", F.coalesce("component", "class"))
            mixed = p.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
                "low != high")
            p = stored(p.join(mixed.select("gram"), "gram", "left_semi"))
        a, b = p.alias("a"), p.alias("b")
        return (a.join(b, (F.col("a.gram") == F.col("b.gram")) & (F.col("a.class") < F.col("b.class"))
                       & (F.col("a.component") != F.col("b.component")) & _allowed(self.percent, "a", "b"))
                .select(F.struct("a.class", "a.n").alias("x"), F.struct("b.class", "b.n").alias("y"))
                .select(*_pair()).distinct())

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The candidate pairs (a, b, na, nb) that reach the threshold, with their
        overlap. Stored.

        The overlap in the first fragment is counted first: where it and all that
        is left of the smaller set cannot reach the threshold, the pair ends there.
        The other fragments are read for the sets of the remaining pairs, counted,
        and summed.
        """
        pairs = stored(pairs)
        parts = self._parts_of(pairs)
        whole = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).otherwise(0)
        common = F.size(F.array_intersect("ga", "gb"))
        reaches = lambda k: k * (100 + self.percent) >= self.percent * (F.col("na") + F.col("nb"))

        def side(sets: DataFrame, name: str) -> DataFrame:
            return sets.withColumnsRenamed({"class": name, "grams": f"g{name}"})

        lead = parts.where("fragment = 0").groupBy("class").agg(F.any_value("grams").alias("grams"))
        first = pairs.join(side(lead, "a"), "a", "left").join(side(lead, "b"), "b", "left").withColumn(
            "seen", F.when(F.col("ga").isNotNull() & F.col("gb").isNotNull(), common).otherwise(0))
        rest = F.least(F.col("na") - whole("ga"), F.col("nb") - whole("gb"))
        alive = stored(first.where(reaches(F.col("seen") + rest)).select("a", "b", "na", "nb", "seen"))
        left = Filter(stored(_members(alive))).rows(parts.where("fragment > 0"))
        sets = left.groupBy("class", "fragment").agg(F.any_value("grams").alias("grams"))
        asked = alive.select("a", "b", F.explode(F.sequence(F.lit(1), F.lit(FRAGMENTS - 1))).alias("fragment"))
        # the sets stay where their aggregation has put them; only pairs move to side a
        others = (asked.join(side(sets, "a"), ["a", "fragment"]).join(side(sets, "b"), ["b", "fragment"])
                  .select("a", "b", common.alias("k")).groupBy("a", "b").agg(F.sum("k").alias("k")))
        summed = alive.join(others, ["a", "b"], "left").withColumn(
            "overlap", F.col("seen") + F.coalesce("k", F.lit(0)))
        return stored(summed.where(reaches(F.col("overlap"))).select("a", "b", "na", "nb", "overlap"))

    def _parts_of(self, pairs: DataFrame) -> DataFrame:
        """Fragments of all sets in ``pairs``; those read before are kept."""
        wanted = _members(pairs)
        if self.known is not None:
            wanted = wanted.join(self.known, "class", "left_anti")
        wanted = stored(wanted)
        new = stored(_fragments(self.docs, self.order, Filter(wanted)))
        self.parts = new if self.parts is None else self.parts.union(new)
        self.known = wanted if self.known is None else self.known.union(wanted)
        return self.parts


def connected(links: DataFrame) -> DataFrame:
    """(id, component) for the nodes of links (a, b): the smallest node reachable.

    Alternates large and small stars until nothing changes. Each step takes minima
    and joins; a node with very many links is split by adaptive execution, and each
    step is written out.
    """
    edges, before = links.select("a", "b").where("a != b"), None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        least = down.groupBy("a").agg(F.min("b").alias("low"))
        small = down.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
            F.struct(F.col("a").alias("a"), F.col("low").alias("b")))).alias("e")).select("e.*").where("a != b")
        edges = stored(small.distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    ends = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return ends.union(ends.select(F.col("component").alias("id"), "component").distinct())


def components(docs: DataFrame, *, n: int, percent: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row.

    Two documents link when 100 * overlap >= percent * union of their n-gram sets;
    ``component_id`` is the smallest id reachable by links. A document with fewer
    than n words has its whole sequence as one n-gram; one without words, or with a
    null text, is empty, linked with nothing and its own component. Repeated rows
    stay. A null id belongs to its component, but names it only if no other id does.
    Other columns are ignored, whatever their names; an empty table gives no rows.

    N-grams are compared by 64-bit hashes.
    """
    join = Join(docs, n, percent, id_col=id_col, text=text)
    near = join.linked(join.to_centers()).select("a", "b")
    first = stored(connected(near))
    far = join.linked(join.across(first)).select("a", "b")
    of_class = stored(connected(near.union(far)))
    least = join.rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    named = least.join(of_class.withColumnRenamed("id", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(names, "component").select("class", "component_id")
    return join.rows.join(by_class, "class", "left").select(
        F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def links(docs: DataFrame, *, n: int, percent: int, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_a, id_b, overlap, size_a, size_b): every link between two different
    n-gram sets, each set represented by its smallest id. Equal sets are not listed
    as pairs; ``components`` gives them one component."""
    join = Join(docs, n, percent, id_col=id_col, text=text)
    least = join.rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("least"))
    ids = lambda side: least.select(F.col("class").alias(side), F.col("least").alias(f"id_{side}"))
    return (join.linked(join.across(None)).join(ids("a"), "a").join(ids("b"), "b")
            .select("id_a", "id_b", "overlap", F.col("na").alias("size_a"), F.col("nb").alias("size_b")))
