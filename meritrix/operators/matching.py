"""Fuzzy and substring matches against large lookups, as equi joins.

Edit distance. Two edits hit at most two segments of a lookup text; the title holds the
others, moved by one place or two. The keys of a text are all but two of its segments, those
of a title what it holds in the same places. Segments are cut where the texts of a length
differ, so a text's words that very many share in the same place are one segment, and
the digits that tell them apart are several. Titles that have no text so near, and may be
further off, are met by one of the k + 1 even segments of the lookup text, which the title
holds no further from its place than the edits allow. Only pairs that share a key meet,
and the distance confirms them.

Substrings. The keys of a title are its substrings of the lengths that patterns have, where
a pattern can begin.

All keys are hashes built by column expressions, so no lookup has to fit into one task. Their
number for a row does not grow with the square of its length, as they are what takes disk. The
planner takes exploded keys to be as few as the rows that they come from, so the joins
on them ask for a merge join; a broadcast would go through the driver.
"""

from __future__ import annotations

import json
import math
from itertools import accumulate, combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.session import stored

MIN_FUZZY_LENGTH, MAX_FUZZY_LENGTH = 4, 60
#: Edits that the keys of all but two segments cover; titles up to SHORT characters allow no more.
SHORT_EDITS, SHORT = 2, 16
#: Segments that a text may be cut into; cost of meeting a text, where a key costs 1.
SEGMENTS, MEETING = range(3, 10), 0.7
#: Characters by which a character is foreseen when segments are cut.
CONTEXT = 2
#: Beginnings that titles are asked for before they get keys: so many at most, and of patterns so long.
BEGINNINGS, LONGEST_BEGINNING = 3_000, 12


def edits_of(length: Column) -> Column:
    """Allowed edit distance for a title of this length: 15 % of it, at least 2."""
    return F.greatest(F.lit(2), F.round(length * 0.15).cast("int"))


def edits_for(length: int) -> int:
    """The same of a number."""
    return max(2, int(length * 0.15 + 0.5))


def max_edits(title: Column) -> Column:
    return edits_of(F.length(title))


def _int(value) -> Column:
    return value.cast("int")


def weights(texts: DataFrame) -> dict[int, tuple[int, list[float]]]:
    """By length of the texts: their number, and for each place how far it tells them apart,
    in bits. Of the pairs of texts that agree in the CONTEXT characters before the place, it
    is the share that agrees there too."""
    text, n = F.col("text"), F.length("text").alias("n")
    ends = F.transform(F.sequence(F.lit(1), F.length(text)), lambda p: F.substr(
        text, F.greatest(F.lit(1), p - CONTEXT), F.least(p, F.lit(CONTEXT + 1))))
    grams = texts.select(n, F.posexplode(ends).alias("p", "gram")).groupBy("n", "p", "gram").agg(F.count("*").cast("double").alias("c"))
    before = grams.groupBy("n", "p", F.left("gram", F.length("gram") - 1)).agg(
        F.sum("c").alias("s"), F.sum(F.col("c") * (F.col("c") - 1)).alias("same"))
    rows = before.groupBy("n", "p").agg(
        F.sum("s").alias("texts"), F.sum(F.col("s") * (F.col("s") - 1)).alias("pairs"), F.sum("same").alias("same")).collect()
    found: dict[int, tuple[int, list[float]]] = {}
    for r in sorted(rows, key=lambda r: (r.n, r.p)):
        found.setdefault(r.n, (int(r.texts), []))[1].append(math.log2((r.pairs + 1) / (r.same + 1)))
    return found


def cuts(texts: int, bits: list[float]) -> list[int]:
    """Bounds of segments, from 0 to the length, that tell about equally many texts of this
    length apart; as many segments as cost least in keys and texts that share one."""
    bits = [w + 0.01 for w in bits]  # places that tell nothing are dealt out evenly
    known, best = list(accumulate(bits, initial=0.0)), None
    for m in SEGMENTS:
        bounds = [0, *(min(range(len(known)), key=lambda p, i=i: abs(known[p] - known[-1] * i / m)) for i in range(1, m)), len(bits)]
        told = [known[hi] - known[lo] for lo, hi in zip(bounds, bounds[1:])]
        met = sum(texts * 2 ** (a + b - known[-1]) for a, b in combinations(told, 2))
        cost = m * (m - 1) / 2 + 5 * (m - 1) + 9 * (m - 1) * (m - 2) / 2 + MEETING * met
        if best is None or cost < best[0]:
            best = cost, bounds
    return best[1]


def _kept(bounds: list[int], longer: int, moves) -> list[tuple]:
    """What is kept for each two segments left out, of a string that has ``longer`` characters
    more than a text with these bounds: its name, then the characters of the head, place (from 1)
    and width of what stands between the two, place of the tail. ``moves``: by how much the part
    between may stand further back; where there is none, both may be hit by the edits in any way."""
    found = []
    for i, j in combinations(range(len(bounds) - 1), 2):
        apart = j > i + 1
        head, tail, width = bounds[i], bounds[j + 1] + longer, bounds[j] - bounds[i + 1]
        for at in [bounds[i + 1] + move for move in moves] if apart else [head]:
            if head <= at and at + width <= tail:  # else what is left out would be of less than no characters
                found.append(((bounds[-1] * 100 + i) * 100 + j, head, at + 1, width, tail + 1))
    return found


def text_pieces(bounds: list[int]) -> list[tuple]:
    return _kept(bounds, 0, [0])


def title_pieces(length: int, bounds: dict[int, list[int]]) -> list[tuple]:
    """For a title of this length. Of two edits in segments apart from each other, either
    moves what follows by one place at most."""
    found = []
    for longer in range(-SHORT_EDITS, SHORT_EDITS + 1):
        if length - longer in bounds:
            found += _kept(bounds[length - longer], longer, [d for d in (-1, 0, 1) if abs(longer - d) <= 1])
    return found


def _heads(texts: DataFrame, bounds: dict[int, list[int]]) -> dict[int, list[int]]:
    """Hashes of what texts have before a segment, for the first segments of which all lengths
    together have at most BEGINNINGS; by the segment's number."""
    text, left, found = F.col("text"), BEGINNINGS, {}
    for i in range(1, max(map(len, bounds.values()), default=0) - 2):
        places = _listed([b[i] if i < len(b) else 0 for b in (bounds.get(n, []) for n in range(max(bounds) + 1))])
        rows = texts.select(_head(F.length(text), text, F.get(places, F.length(text))).alias("head")).distinct().limit(left + 1).collect()
        if len(rows) > left:
            break
        left -= len(rows)
        found[i] = [r.head for r in rows]
    return found


def _head(size: Column, text: Column, width: Column) -> Column:
    return F.xxhash64(size, F.left(text, width))


def _met_heads(pieces: Column, text: Column, i: int, known: list[int]) -> Column:
    """The pieces that leave out another segment than the i-th first, or have one of the known heads."""
    def met(p):
        return (_int(F.floor(p[0] / 100)) % 100 != i) | _head(_int(F.floor(p[0] / 10_000)), text, p[1]).isin(known)

    return F.filter(pieces, met)


def _keys(text: Column, pieces: dict[int, list[tuple]], heads: dict[int, list[int]] | None = None) -> Column:
    """Hashes of the pieces listed for the text's length. ``heads``: by number of the first
    segment that is left out, the only heads (``_heads``) that can be met."""
    listed = json.dumps([pieces.get(n, []) for n in range(max(pieces, default=0) + 1)], separators=(",", ":"))
    table = F.get(F.from_json(F.lit(listed), "array<array<array<int>>>"), F.length(text))
    for i, known in (heads or {}).items():
        table = _met_heads(table, text, i, known)
    return F.transform(table, lambda p: F.xxhash64(
        p[0], F.substr(text, F.lit(1), p[1]), F.substr(text, p[2], p[3]), F.substr(text, p[4])))


def _segment(length: Column, edits: Column, i: Column) -> tuple[Column, Column]:
    """Start (from 0) and length of the i-th of ``edits`` + 1 even segments; the
    last ones take the characters that are left over."""
    n = edits + 1
    base, longer = F.floor(length / n), F.pmod(length, n)
    return _int(i * base + F.greatest(F.lit(0), i - (n - longer))), _int(base + F.when(i >= n - longer, 1).otherwise(0))


def segment_keys(text: Column, lengths: Column) -> Column:
    """Keys (length, edits, segment, string) of a lookup text, for every number of edits
    that a title of one of ``lengths``, of which it can be the nearest, may allow."""
    length = F.length(text)
    # titles of length t allow k(t) edits; a text of this length is near only if |t - length| <= k(t)
    nearby = F.filter(lengths, lambda t: F.abs(t - length) <= edits_of(t))
    edits = F.array_distinct(F.transform(nearby, edits_of))

    def keys(k):
        def key(i):
            start, size = _segment(length, k, i)
            return F.struct(length.alias("size"), k.alias("edits"), i.alias("segment"),
                            F.substr(text, start + 1, size).alias("piece"))
        return F.transform(F.sequence(F.lit(0), k), key)

    return F.flatten(F.transform(edits, keys))


def probe_keys(title: Column, sizes: Column) -> Column:
    """Keys under which a lookup text within the title's allowance is found: for each
    length of ``sizes`` that it may have and each of its segments, the substrings of the title at
    most as far from the segment's place as the edits before and after it allow."""
    length, k = F.length(title), max_edits(title)

    def of_size(size):
        def of_segment(i):
            start, width = _segment(size, k, i)
            shift = length - size
            low = F.greatest(F.lit(0), start - i, start + shift - (k - i))
            high = F.least(length - width, start + i, start + shift + (k - i))
            starts = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            return F.transform(starts, lambda s: F.struct(
                size.alias("size"), k.alias("edits"), i.alias("segment"), F.substr(title, s + 1, width).alias("piece")))
        return F.flatten(F.transform(F.sequence(F.lit(0), k), of_segment))

    return F.array_distinct(F.flatten(F.transform(F.filter(sizes, lambda n: F.abs(n - length) <= k), of_size)))


def _lengths(texts: DataFrame, column: str = "text") -> list[int]:
    """The lengths that texts have."""
    return sorted(r.n for r in texts.select(F.length(column).alias("n")).distinct().collect())


def _listed(numbers: list[int]) -> Column:
    return F.lit(numbers).cast("array<int>") if numbers else F.array().cast("array<int>")


def _by_text(lookup: DataFrame) -> DataFrame:
    """One row per text that is not empty: the smallest code and label."""
    rows = lookup.where(F.length("text") > 0).groupBy("text")
    return rows.agg(F.min(F.struct("code", "label")).alias("v")).select("text", "v.*")


def _spread(rows: DataFrame, by: Column) -> DataFrame:
    """Rows whose keys take long to make, over all cores: by their bytes they would be few
    tasks. They are dealt by a hash, as a second deal by the same column is left out."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return rows.repartition(parts, F.xxhash64(by))


def _closest(asked: DataFrame, asked_keys: Column, texts: DataFrame, text_keys: Column, allowed: Column) -> DataFrame:
    """(title_normalized, near): edits and text of the closest of those that share a key."""
    title, text = F.col("title_normalized"), F.col("text")
    a = _spread(asked, title).select(title, F.explode(asked_keys).alias("key"))
    b = _spread(texts, text).select(text, F.explode(text_keys).alias("key"))
    edits = F.call_function("levenshtein", title, text, allowed)  # -1: more than allowed
    return a.join(b.hint("merge"), "key").select(title, F.struct(edits.alias("edits"), text.alias("text")).alias("near")).where(
        F.col("near.edits") >= 0).groupBy(title).agg(F.min("near").alias("near"))


def _hashed(keys: Column) -> Column:
    return F.transform(keys, lambda k: F.xxhash64(k))


def nearest(titles: DataFrame, lookup: DataFrame) -> DataFrame:
    """(title_normalized, edits, text, code, label): the closest text of ``lookup``
    (text, code, label) within each title's allowance (ties: smaller text, code, label).
    ``titles`` has distinct ``title_normalized``; titles outside the lengths for which
    edits count find nothing. A lookup text of up to two characters or none is near
    short titles only, as its distance says."""
    title, text = F.col("title_normalized"), F.col("text")
    length, known = F.length(title), stored(_by_text(lookup))
    texts = known.select(text).where(F.length(text) <= MAX_FUZZY_LENGTH + edits_for(MAX_FUZZY_LENGTH))
    short = texts.where(F.length(text) <= MAX_FUZZY_LENGTH + SHORT_EDITS)
    bounds = {n: cuts(*found) for n, found in weights(short).items()}
    sizes, asking = _lengths(texts), range(MIN_FUZZY_LENGTH, MAX_FUZZY_LENGTH + 1)
    pieces = {t: title_pieces(t, bounds) for t in asking if any(abs(t - n) <= SHORT_EDITS for n in sizes)}
    first = stored(_closest(
        titles.select(title).where(length.isin([*pieces])), _keys(title, pieces, _heads(short, bounds)),
        short, _keys(text, {n: text_pieces(b) for n, b in bounds.items()}), F.lit(SHORT_EDITS)))
    # titles and texts that are left and may be near one of the others
    open_lengths = [t for t in asking if t > SHORT and any(abs(t - n) <= edits_for(t) for n in sizes)]
    further = stored(titles.select(title).where(length.isin(open_lengths)).join(first.select(title), "title_normalized", "left_anti"))
    lengths = _lengths(further, "title_normalized")
    rest = texts.where(F.array_contains(
        _listed([n for n in sizes if any(abs(t - n) <= edits_for(t) for t in lengths)]), F.length(text)))
    found = first.unionByName(_closest(
        further, _hashed(probe_keys(title, _listed(sizes))), rest, _hashed(segment_keys(text, _listed(lengths))), max_edits(title)))
    return found.select(title, "near.*").join(known, "text").select(title, "edits", "text", "code", "label")


def _beginnings(texts: DataFrame, lengths: list[int]) -> list[str]:
    """What texts begin with, all with the same number of characters: as many as tell at most BEGINNINGS apart."""
    sizes = range(min(min(lengths, default=0), LONGEST_BEGINNING), 0, -1)
    found = texts.agg(*[F.approx_count_distinct(F.left("text", F.lit(n))).alias(str(n)) for n in sizes]).first() if sizes else {}
    for n in sizes:
        if found[str(n)] <= BEGINNINGS:
            rows = texts.select(F.left("text", F.lit(n)).alias("start")).distinct().limit(BEGINNINGS + 1).collect()
            if len(rows) <= BEGINNINGS:
                return sorted(r.start for r in rows)
    return []


def _grams(text: Column, n: Column, starts: Column) -> Column:
    """Substrings of n characters at some places."""
    return F.transform(F.filter(starts, lambda i: i + n - 1 <= F.length(text)), lambda i: F.substr(text, i, n))


def contained(titles: DataFrame, lookup: DataFrame) -> DataFrame:
    """(title_normalized, text, code, label): the longest text of ``lookup`` (text, code,
    label) inside each title (ties: alphabetical, then code, label). An empty text is in
    every title and no match."""
    title, text, known = F.col("title_normalized"), F.col("text"), stored(_by_text(lookup))
    lengths = _lengths(known)
    beginnings = _beginnings(known, lengths)
    starts = F.when(F.length(title) > 0, F.sequence(F.lit(1), F.length(title))).otherwise(F.array().cast("array<int>"))
    if beginnings:
        starts = F.filter(starts, lambda i: F.substr(title, i, F.lit(len(beginnings[0]))).isin(beginnings))
    parts = F.array_distinct(F.flatten(F.transform(_listed(lengths), lambda n: _grams(title, n, F.col("_starts")))))
    asked = titles.select(title, starts.alias("_starts")).select(title, F.explode(_hashed(parts)).alias("key"))
    hits = asked.join(known.select(text, F.xxhash64(text).alias("key")).hint("merge"), "key").where(F.contains(title, text))
    best = hits.groupBy(title).agg(F.min(F.struct((-F.length("text")).alias("rank"), "text")).alias("hit"))
    return best.select(title, "hit.text").join(known, "text").select(title, "text", "code", "label")
