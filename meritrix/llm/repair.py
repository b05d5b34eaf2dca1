"""Repair of conversation structure by the cheapest edits.

Turns are kept (K), given another role (R), deleted (D) or inserted (I) until the roles
read as an optional system turn and whole user-assistant pairs. The least cost is a
Viterbi recursion over four states, solved backwards. A conversation of any length
is cut into chunks of bounded size: each chunk first runs on a speculative vector of
costs at its end, and fix-up passes rerun the chunks whose vector turns out to differ
by more than a constant, over spans that grow 16-fold, so that few passes are
enough whatever the data. The stitched costs then drive a forward trace that takes
the least letter of those that keep the cost.

Order inside a conversation: turn (nulls first), role, SHA-256 of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meritrix.llm.tasks import forget_state, share_code
from meritrix.session import stored

#: Costs of an edit, and what a truncated turn adds unless it is deleted.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns of a chunk.
CHUNK = 65_536
#: White space at the ends of texts: x20 and x09 to x0D.
BLANKS = " \t\n\x0b\x0c\r"
#: States: nothing yet, after the system turn, after a user turn, after a pair.
START, SYSTEM, USER, PAIR = range(4)
#: Where a user or assistant turn, whichever fits, leads from each state.
NEXT = (USER, USER, PAIR, USER)
#: Costs after the last turn: a pair or nothing may end it, the other states insert first.
END = (0, 2 * INSERT, INSERT, 0)
#: A turn is one byte: blank or duplicate ones must go; for the others, from OPEN on,
#: the place of the role's initial in INITIALS (or one more) doubled, plus 1 if truncated.
BLANK, DUPLICATE, OPEN = 0, 1, 2
INITIALS = "uas"
#: Where a kept turn leads from each state, by initial.
KEPT = ((USER, USER, None, USER), (None, None, PAIR, None), (SYSTEM, None, None, None), (None,) * 4)

Vector = tuple[int, int, int, int]


def _options(code: int, after: Vector, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost to the end, next state) of the edits of one turn, by letter."""
    found = [("D", DELETE + after[state], state)]
    if code >= OPEN:
        late = TRUNCATED if code & 1 else 0
        kept = KEPT[(code - OPEN) // 2][state]
        if kept is not None:
            found.append(("K", late + after[kept], kept))
        found.append(("R", REROLE + late + after[NEXT[state]], NEXT[state]))
    return found


def before(code: int, after: Vector) -> Vector:
    """Costs to the end before a turn, from those after it; inserts come first."""
    plain = [min(cost for _, cost, _ in _options(code, after, state)) for state in range(4)]
    user, pair = min(plain[USER], INSERT + plain[PAIR]), min(plain[PAIR], INSERT + plain[USER])
    return min(plain[START], INSERT + user), min(plain[SYSTEM], INSERT + user), user, pair


class Viterbi:
    """Steps over turns. Costs matter up to a constant only, and differ by little
    between states, so few (turn, vector) pairs exist and each is worked out once."""

    def __init__(self):
        self.steps: dict[tuple[int, Vector], tuple[Vector, int]] = {}
        self.edits: dict[tuple[int, Vector, int], tuple[str, int]] = {}

    def step(self, code: int, after: Vector) -> tuple[Vector, int]:
        hit = self.steps.get((code, after))
        if hit is None:
            costs = before(code, after)
            least = min(costs)
            hit = self.steps[code, after] = (tuple(c - least for c in costs), least)
        return hit

    def backward(self, codes: bytes, end: Vector, keep: bool = False) -> tuple[Vector, int, list[Vector]]:
        """The vector before a chunk, less its least cost; that cost; and, if asked
        for, the vector after each of its turns."""
        vector, base, after = end, 0, []
        for code in reversed(codes):
            if keep:
                after.append(vector)
            if code < OPEN:  # a forced deletion changes all costs alike
                base += DELETE
            else:
                vector, least = self.step(code, vector)
                base += least
        after.reverse()
        return vector, base, after

    def edit(self, code: int, after: Vector, state: int) -> tuple[str, int]:
        """The least letters for one turn, inserts before it included, and the next state."""
        hit = self.edits.get((code, after, state))
        if hit is None:
            costs, letters, at = before(code, after), "", state
            while True:
                options = [*_options(code, after, at), ("I", INSERT + costs[NEXT[at]], NEXT[at])]
                letter, _, to = min(o for o in options if o[1] == costs[at])
                letters, at = letters + letter, to
                if letter != "I":
                    break
            hit = self.edits[code, after, state] = (letters, at)
        return hit

    def trace(self, codes: bytes, after: list[Vector], state: int) -> tuple[str, int]:
        letters = []
        for code, vector in zip(codes, after):
            piece, state = self.edit(code, vector, state)
            letters.append(piece)
        return "".join(letters), state

    def solve(self, codes: bytes) -> tuple[str, int]:
        """Edits and cost of a whole conversation."""
        vector, base, after = self.backward(codes, END, keep=True)
        letters, state = self.trace(codes, after, START)
        return letters + closing(state), base + vector[START]


def closing(state: int) -> str:
    """Inserts after the last turn."""
    return "I" * (END[state] // INSERT)


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) with known faults, by crc32 of ``conv:turn`` modulo
    20: 0 drops a row, 1 empties its text, 2 removes its [.!?], 3 repeats it, 4 makes
    it the user's. A null counts as one space, in the result only for role and text."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)))
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    plain = F.coalesce(F.col(text), F.lit(" "))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).when(kind == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(1)))
    return rows.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(plain, ".!?", "")).otherwise(plain).alias("text"),
        F.explode(copies).alias("copy")).drop("copy")


def _named(rows: DataFrame) -> DataFrame:
    """Null roles and texts as one space, and the digest that orders equal turns."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))


def _order(*more: str) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", *more)]


def _met(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("conv_id", "seq")) -> DataFrame:
    """Rows of ``a`` with what ``b`` has for the same keys, where a null equals a null."""
    named = b.withColumnsRenamed({c: f"{c}_of_b" for c in keys})
    same = F.lit(True)
    for c in keys:
        same &= a[c].eqNullSafe(named[f"{c}_of_b"])
    return a.join(named, same, "left").drop(*(f"{c}_of_b" for c in keys))


def _classified(named: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, code, n): equal rows are counted before anything is
    shuffled, and the first turn of a role and text is found by a second count, so no
    key gathers its rows. ``code`` is the first of the n copies, the others repeat it."""
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    late = F.when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "u", 0).when(initial == "a", 1).when(initial == "s", 2).otherwise(len(INITIALS))
    code = F.when(F.length(trimmed) == 0, BLANK).otherwise(OPEN + 2 * place + late)
    keys = ("conv_id", "turn", "role", "digest")
    counted = stored(named.select(*keys, code.cast("int").alias("code")).groupBy(*keys, "code").agg(F.count(F.lit(1)).alias("n")))
    firsts = counted.groupBy("conv_id", "role", "digest").agg(
        F.bool_or(F.col("turn").isNull()).alias("unnumbered"), F.min("turn").alias("turn"))
    firsts = firsts.withColumn("turn", F.when(~F.col("unnumbered"), F.col("turn"))).withColumn("first", F.lit(True))
    code = F.when((F.col("code") == BLANK) | F.col("first"), F.col("code")).otherwise(DUPLICATE)
    return _met(counted, firsts, keys).select(*keys, code.alias("code"), "n")


def _arrow(frame: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """``run`` maps Arrow batches to lists of rows of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        out, size = [], 0
        for row in run(given):
            out.append(row)
            size += sum(len(v) for v in row if isinstance(v, (str, bytes)))
            if len(out) == 4_096 or size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return frame.mapInArrow(batches, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _chunks(turns: DataFrame, size: int) -> DataFrame:
    """Chunks of at most ``size`` turns of one conversation, in a range partitioning
    by the order of the turns: (conv_id, turn, role, digest: of the first turn, part, k,
    codes, edits, cost). Where a conversation surely lies in one chunk it is solved
    at once; those that may go on in another one are left open (null edits)."""
    kinds = {f.name: f.dataType for f in turns.schema.fields}
    schema = T.StructType([
        *(T.StructField(c, kinds[c]) for c in ("conv_id", "turn", "role", "digest")),
        T.StructField("part", T.IntegerType()), T.StructField("k", T.LongType()), T.StructField("codes", T.BinaryType()),
        T.StructField("edits", T.StringType()), T.StructField("cost", T.LongType())])

    def run(batches):
        viterbi, head, codes, k, first, cut = Viterbi(), None, bytearray(), 0, True, False

        def close(whole: bool):
            done = viterbi.solve(codes) if whole else (None, None)
            return (*head, part, k, bytes(codes), *done)

        for conv, turn, role, digest, code, n, part in _rows(batches):
            if head is not None and head[0] != conv:
                yield close(whole=not (first or cut))
                head, codes, k, first, cut = None, bytearray(), k + 1, False, False
            while n:
                if len(codes) == size:
                    yield close(whole=False)
                    head, codes, k, cut = None, bytearray(), k + 1, True
                if head is None:
                    head = (conv, turn, role, digest)
                taken = 1 if code >= OPEN else min(n, size - len(codes))
                codes += bytes([code]) * taken
                n -= taken
                if code >= OPEN:
                    code = DUPLICATE  # further copies of the same row
        if head is not None:
            yield close(whole=False)

    by = _order()
    placed = turns.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
    return _arrow(placed.select("conv_id", "turn", "role", "digest", "code", "n", "part"), run, schema)


def _vector(name: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(T.LongType()))


def _converged(pieces: DataFrame) -> DataFrame:
    """(conv_id, seq, last, end, start, base): the vector of costs at the end and the
    start of each chunk (conv_id, seq, last, codes), less its least cost ``base``."""
    schema = T.StructType([pieces.schema["conv_id"], T.StructField("seq", T.IntegerType()), T.StructField("last", T.BooleanType()),
                           _vector("end"), _vector("start"), T.StructField("base", T.LongType())])

    def speculate(batches):
        viterbi = Viterbi()
        for conv, seq, last, codes in _rows(batches):
            end = END if last else (0, 0, 0, 0)
            start, base, _ = viterbi.backward(codes, end)
            yield conv, seq, last, end, start, base

    def fix(batches):
        viterbi, at, fresh = Viterbi(), None, None
        for conv, span, seq, last, end, start, base, following, codes in _rows(batches):
            if not last and at == (conv, span, seq + 1):
                following = fresh
            if not last and tuple(end) != tuple(following):
                end = following
                start, base, _ = viterbi.backward(codes, tuple(end))
            at, fresh = (conv, span, seq), start
            yield conv, seq, last, end, start, base

    vectors, span = stored(_arrow(pieces.select("conv_id", "seq", "last", "codes"), speculate, schema)), 16
    while True:
        met = _met(vectors, vectors.select("conv_id", (F.col("seq") - 1).alias("seq"), F.col("start").alias("following")))
        if met.where("NOT last AND end != following").isEmpty():
            return vectors
        dealt = _met(met, pieces.select("conv_id", "seq", "codes")).withColumn("span", F.expr(f"seq div {span}"))
        dealt = dealt.repartition("conv_id", "span").sortWithinPartitions("conv_id", "span", F.desc("seq"))
        vectors = stored(_arrow(dealt.select(
            "conv_id", "span", "seq", "last", "end", "start", "base", "following", "codes"), fix, schema))
        span *= 16


def _joined(open_chunks: DataFrame) -> DataFrame:
    """Edits and cost of chunks that may be parts of longer conversations: (part, k,
    edits, cost). Only a number of chunks, 1 : CHUNK of the turns, is ordered by
    conversation; the turns themselves stay in their chunks."""
    by_conv = Window.partitionBy("conv_id")
    placed = open_chunks.select("conv_id", "part", "k", F.row_number().over(by_conv.orderBy("part", "k")).alias("seq"))
    placed = placed.withColumn("last", F.col("seq") == F.count(F.lit(1)).over(by_conv))
    pieces = stored(open_chunks.select("part", "k", "codes").join(placed, ["part", "k"]))
    vectors = _converged(pieces)
    solved = stored(_met(pieces.select("conv_id", "seq", "last", "part", "k", "codes"),
                         vectors.select("conv_id", "seq", "end", "start", "base")))

    def lead(batches):
        """Where each state at the start of a chunk leads."""
        viterbi = Viterbi()
        for conv, seq, codes, end in _rows(batches):
            after = viterbi.backward(codes, tuple(end), keep=True)[2]
            yield conv, seq, [viterbi.trace(codes, after, state)[1] for state in range(4)]

    def follow(batches):
        """The state that each chunk of a conversation starts from."""
        at, state = None, START
        for conv, seq, to in _rows(batches):
            if at != (conv, seq - 1):
                state = START
            yield conv, seq, state
            at, state = (conv, seq), to[state]

    def letters(batches):
        viterbi = Viterbi()
        for part, k, seq, last, codes, end, start, base, state in _rows(batches):
            after = viterbi.backward(codes, tuple(end), keep=True)[2]
            edits, state = viterbi.trace(codes, after, state)
            yield part, k, edits + (closing(state) if last else ""), base + (start[START] if seq == 1 else 0)

    conv, seq = open_chunks.schema["conv_id"], T.StructField("seq", T.IntegerType())
    leads = _arrow(solved.select("conv_id", "seq", "codes", "end"), lead,
                   T.StructType([conv, seq, T.StructField("to", T.ArrayType(T.IntegerType()))]))
    leads = leads.repartition("conv_id").sortWithinPartitions("conv_id", "seq")
    states = _arrow(leads, follow, T.StructType([conv, seq, T.StructField("state", T.IntegerType())]))
    return _arrow(
        _met(solved, states).select("part", "k", "seq", "last", "codes", "end", "start", "base", "state"), letters,
        T.StructType([T.StructField("part", T.IntegerType()), T.StructField("k", T.LongType()),
                      T.StructField("edits", T.StringType()), T.StructField("cost", T.LongType())]))


def edits(rows: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """The cheapest edits of every conversation of (conv_id, turn, role, text), in chunks of
    at most ``chunk`` turns: (conv_id, turn, role, digest: of the chunk's first turn,
    part, k: their order, codes: a byte per turn, edits: letters K, R, D, one per turn,
    and I, cost). No task holds more than a chunk, however long a conversation is, and no
    text is shuffled. A null conversation is one of its own; an empty table gives no rows."""
    share_code(rows.sparkSession)
    chunks = stored(_chunks(_classified(_named(rows)), chunk))
    joined = stored(_joined(chunks.where("edits IS NULL")))
    closed = chunks.where("edits IS NOT NULL")
    opened = chunks.where("edits IS NULL").drop("edits", "cost").join(joined, ["part", "k"]).select(*closed.columns)
    return closed.unionByName(opened)


class _Conversation:
    """Replays the edits of one conversation over its turns, which come in order."""

    def __init__(self, conv):
        self.conv, self.state, self.cost, self.audit, self.pending, self.at = conv, START, 0, [], [], 0
        self.counts, self.illegal, self.initial = [0, 0, 0], 0, None
        self.lowest = self.highest = None
        self.distinct, self.hash, self.empty = 0, hashlib.sha256(), True

    def plan(self, codes: bytes, letters: str, cost: int) -> None:
        """The next chunk's edits."""
        self.cost += cost
        self.audit.append(letters)
        self.pending.append(letters)
        for fault in (BLANK, DUPLICATE):
            self.counts[fault] += codes.count(fault)
        self.counts[2] += sum(codes.count(c) for c in range(OPEN + 1, OPEN + 2 * len(INITIALS) + 2, 2))

    def _letters(self) -> Iterator[str]:
        while self.pending:
            if self.at == len(self.pending[0]):
                self.pending.pop(0)
                self.at = 0
            else:
                self.at += 1
                yield self.pending[0][self.at - 1]

    def _fitting(self) -> str:
        return "assistant" if self.state == USER else "user"

    def turn(self, turn, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired turns, (edit, role, text), up to and with this one."""
        if turn is not None and turn != self.highest:
            self.lowest = turn if self.lowest is None else self.lowest
            self.highest, self.distinct = turn, self.distinct + 1
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = role[:1]
        for letter in self._letters():
            if letter == "K":
                self.state = KEPT[INITIALS.index(role[0])][self.state]
                yield "K", role, text
            elif letter != "D":
                fitting, self.state = self._fitting(), NEXT[self.state]
                yield letter, fitting, "" if letter == "I" else text
            if letter != "I":
                return

    def end(self) -> Iterator[tuple[str, str, str]]:
        for letter in self._letters():
            fitting, self.state = self._fitting(), NEXT[self.state]
            yield letter, fitting, ""

    def hashed(self, turns: Iterator[tuple[str, str, str]]) -> None:
        for _, role, text in turns:
            self.hash.update(f"{role}:{text}".encode() if self.empty else f"\n{role}:{text}".encode())
            self.empty = False

    def digest(self) -> tuple:
        gaps = 0 if self.lowest is None else self.highest - self.lowest + 1 - self.distinct
        return (self.conv, gaps, *self.counts, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def _replayed(rows: DataFrame, chunk: int, known: DataFrame | None = None) -> DataFrame:
    """Turns, the edits of their chunks and the ``known`` conversations, each conversation
    in one task and in order: (conv_id, turn, role, text, codes, edits, cost). The texts
    are shuffled here, once; a task streams through a conversation."""
    named = _named(rows)
    plans = edits(rows, chunk=chunk).withColumn("kind", F.lit(1))
    turns = named.withColumn("kind", F.lit(2))
    both = turns.unionByName(plans, allowMissingColumns=True)
    if known is not None:
        both = both.unionByName(known.select("conv_id", F.lit(0).alias("kind")), allowMissingColumns=True)
    placed = both.repartition("conv_id").sortWithinPartitions(*_order("kind", "part", "k"))
    return placed.select("conv_id", "turn", "role", "text", "codes", "edits", "cost", "kind")


def repaired(rows: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, place, edit, role, text): the repaired conversations, in order from 1."""
    schema = T.StructType([rows.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("edit", T.StringType()),
                           T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])

    def run(batches):
        at, place = None, 0
        for conv, turn, role, text, codes, letters, cost, kind in _rows(batches):
            if at is None or at.conv != conv:
                if at is not None:
                    yield from ((at.conv, place + i, *made) for i, made in enumerate(at.end(), 1))
                at, place = _Conversation(conv), 0
            if kind == 1:
                at.plan(codes, letters, cost)
            else:
                for made in at.turn(turn, role, text):
                    place += 1
                    yield (conv, place, *made)
        if at is not None:
            yield from ((at.conv, place + i, *made) for i, made in enumerate(at.end(), 1))

    return _arrow(_replayed(rows, chunk), run, schema)


def digests(rows: DataFrame, conversations: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)
    for every conversation of ``conversations`` (conv_id) over its ``rows`` (conv_id, turn,
    role, text); zeros and the empty text's hash where it has none.

    A null role or text counts as one space, a null turn comes first, and a null
    conversation is one of its own; turns of one number follow each other by role, then by
    the SHA-256 of their text; equal rows are turns of their own, all but the first
    of them duplicates. A role without a first letter cannot be kept. Extra columns
    are ignored. The hash of a repaired conversation is sequential, so one task streams
    through its turns; it holds one batch of texts and the audit, a byte per turn, which
    as one value cannot exceed 2 GB. ``edits`` has no such limit.
    """
    long = T.LongType()
    schema = T.StructType([rows.schema["conv_id"], *(T.StructField(c, long) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), T.StructField("audit", T.StringType()),
        T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        at = None
        for conv, turn, role, text, codes, letters, cost, kind in _rows(batches):
            if at is None or at.conv != conv:
                if at is not None:
                    at.hashed(at.end())
                    yield at.digest()
                at = _Conversation(conv)
            if kind == 1:
                at.plan(codes, letters, cost)
            elif kind == 2:
                at.hashed(at.turn(turn, role, text))
        if at is not None:
            at.hashed(at.end())
            yield at.digest()

    return _arrow(_replayed(rows, chunk, conversations), run, schema)
