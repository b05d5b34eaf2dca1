"""SentencePiece encoding and decoding with merge-type vocabularies.

A text is normalised as the model file says, and an agenda of adjacent symbol pairs,
ordered by the score of the piece that they would make and then by position, joins
the best pair until none is left. Symbols that are no piece fall back to bytes.
Pairs that no piece can ever span cut a text into parts which are worked on (and
remembered) one by one; a part of any length takes O(n log n). Each Arrow batch can
be checked against the sentencepiece library.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import share_code, worker_state

#: Parts whose ids a worker keeps before it starts anew, and the longest one kept.
CACHE_SIZE, CACHED_LENGTH = 600_000, 64
#: Bytes of text or ids that are worked on at once.
PIECE_BYTES = 4 << 20
#: Stands for a space inside pieces; fixed by the file format.
SPACE = "▁"
#: What an unknown piece decodes to; fixed by the library's default.
UNKNOWN_TEXT = " ⁇ "
#: Kinds of pieces, fixed by the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Training by merges (as opposed to a unigram model), fixed by the file format.
MERGES = 2


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
            yield tag >> 3, message[at:at + size]
            at += size


def read_model(model: bytes) -> list[tuple[str, float, int]]:
    """(piece, score, kind) by id. A model that this operator could not follow
    exactly (no merges, a character map, white space rules other than one leading
    space, user-defined or unused pieces) is refused."""
    pieces, trained, normal = [], {}, {}
    for field, value in _fields(model):
        if field == 1:
            entry = dict(_fields(value))
            score = struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0
            pieces.append((entry[1].decode(), score, entry.get(3, NORMAL)))
        elif field == 2:
            trained = dict(_fields(value))
        elif field == 3:
            normal = dict(_fields(value))
    strange = {kind for _, _, kind in pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}
    if (trained.get(3) != MERGES or not trained.get(35) or trained.get(24) or normal.get(2) or normal.get(4, 1)
            or not normal.get(3, 1) or not normal.get(5, 1) or strange or sum(kind == BYTE for _, _, kind in pieces) != 256):
        raise ValueError("the model normalises or splits texts in a way that this operator does not know")
    return pieces


class Agenda:
    """Encodes and decodes by a table of pieces."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.table = {p: (score, i) for i, (p, score, kind) in enumerate(pieces) if kind == NORMAL}
        self.byte_ids = [0] * 256
        self.surface: dict[str, bytes] = {}
        for i, (p, _, kind) in enumerate(pieces):
            byte = int(p[1:-1], 16) if kind == BYTE else 0
            if kind == BYTE:
                self.byte_ids[byte] = i
            self.surface[str(i)] = {BYTE: bytes([byte]), UNKNOWN: UNKNOWN_TEXT.encode(), CONTROL: b"",
                                    NORMAL: p.replace(SPACE, " ").encode()}[kind]
        self.silent = {str(i) for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.spaced = {str(i) for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL and p.startswith(SPACE)}
        longer = [p for p in self.table if len(p) > 1]
        pairs = {pair for p in longer for pair in zip(p, p[1:])}
        inside = set("".join(longer))
        plain = list(map(chr, range(128)))
        self.alone = "".join(c for c in plain if c not in inside)
        self.cut = bool(self.alone) and not any(x != SPACE and y == SPACE for x, y in pairs)
        if not self.cut:  # pieces may span words: only whole texts will do
            self.parts = lambda text: [text] if text else []
            return
        # marks follow no ASCII letter or digit in any piece: a cut before one is safe unless it follows one of ``held``
        words = set(filter(str.isalnum, plain))
        marks = [c for c in plain if c in inside - words and not any(x in words and y == c for x, y in pairs)]
        held = "".join(sorted({x for x, y in pairs if y in marks} - {SPACE}))
        lone, mark, held = re.escape(self.alone), re.escape("".join(marks)), re.escape(held)
        more = f"[^{SPACE}{lone}{mark}]*" + (f"(?:(?<=[{held}])[{mark}][^{SPACE}{lone}{mark}]*)*" if held else "")
        self.parts = re.compile(f"{SPACE}*[^{SPACE}{lone}]{more}|{SPACE}+|[{lone}]").findall

    def merge(self, part: str) -> list[int]:
        """``ends[i]`` is where the symbol that starts at i ends (0: it was joined
        to its left neighbour), ``left[i]`` where its left neighbour starts. An entry
        of the agenda is stale when its symbols have changed since, which its
        length shows."""
        n, known = len(part), self.table.get
        ends, left = list(range(1, n + 1)), list(range(-1, n))
        agenda = [(-hit[0], i, 2) for i in range(n - 1) if (hit := known(part[i:i + 2]))]
        heapq.heapify(agenda)
        while agenda:
            _, i, length = heapq.heappop(agenda)
            middle = ends[i]
            if not middle or middle == n or ends[middle] - i != length:
                continue
            end = i + length
            ends[i], ends[middle] = end, 0
            if end < n:
                left[end] = i
                if hit := known(part[i:ends[end]]):
                    heapq.heappush(agenda, (-hit[0], i, ends[end] - i))
            before = left[i]
            if before >= 0 and (hit := known(part[before:end])):
                heapq.heappush(agenda, (-hit[0], before, end - before))
        ids, i = [], 0
        while i < n:
            hit = known(part[i:ends[i]])
            if hit:
                ids.append(hit[1])
            else:
                ids += map(self.byte_ids.__getitem__, part[i:ends[i]].encode())
            i = ends[i]
        return ids

    def decode(self, ids: list[str]) -> str:
        """The text of decimal ids. The first piece loses its leading space, as
        encoding adds one; bytes that form no character become U+FFFD each, and
        control pieces end a run of bytes."""
        if self.silent.isdisjoint(ids):
            runs = [ids]
        else:
            runs = [list(run) for silent, run in groupby(ids, self.silent.__contains__) if not silent]
        text = "".join(b"".join(map(self.surface.__getitem__, run)).decode(errors="each-byte") for run in runs)
        return text[1:] if runs and runs[0] and runs[0][0] in self.spaced else text


codecs.register_error("each-byte", lambda error: ("\ufffd" * (error.end - error.start), error.end))


class _Parts(dict):
    """Part of a text to its ids as decimal text; filled on first use, bounded.
    ``fresh`` are the parts encoded since the last check against the library."""

    def __init__(self, agenda: Agenda, library=None):
        super().__init__()
        self.agenda, self.library, self.fresh, self.trusted = agenda, library, [], agenda.cut

    def agree(self, texts: list[str], ids: list[str]) -> list[bool]:
        """Whether the library gives the same ids for each text. It encodes the parts
        that are new, in one text that keeps them apart; as soon as one differs, and
        where texts are not cut into parts, it encodes the whole texts."""
        if self.trusted:
            words = [p for p in self.fresh if p[0] == SPACE and p.strip(SPACE)]
            others = [x for p in self.fresh if p[0] != SPACE or not p.strip(SPACE) for x in (self.agenda.alone[0], p)]
            parts = [*(words or [SPACE]), *others]
            want = ",".join(map(self.__getitem__, parts))
            self.trusted = ",".join(map(str, self.library.encode("".join(parts)[1:]))) == want
            self.fresh = []
        if self.trusted:
            return [True] * len(texts)
        self.fresh = []
        return [",".join(map(str, found)) == x for found, x in zip(self.library.encode(texts, num_threads=1), ids)]

    def __missing__(self, part: str) -> str:
        ids = ",".join(map(str, self.agenda.merge(part)))
        if self.library:
            self.fresh.append(part)
        if len(part) <= CACHED_LENGTH:
            if len(self) >= CACHE_SIZE:
                self.clear()
            self[part] = ids
        return ids


def _by_bytes(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most PIECE_BYTES of text each, or single longer rows."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at = total = 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and total + size > PIECE_BYTES:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += size
    if at < batch.num_rows:
        yield batch.slice(at)


def encode(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text: str = "text",
           check: bool = False) -> DataFrame:
    """(id, ids, n_tokens) for every row: ``ids`` holds the decimal ids of the whole
    text, joined by commas. With ``check`` the library encodes, batch by batch, each
    part that is new to the worker, and whole texts once any of them differs; the column
    ``agrees`` tells whether it gives the same ids.

    A null or empty text has no ids and the empty string. Repeated rows and null ids
    stay, each row by itself; other columns of ``docs`` are ignored, whatever their
    names; an empty table gives an empty result. Pairs of equal scores are joined
    from the left. A very long text is held whole in one task (a text of n characters
    takes about 100 n bytes while a part without any space that long is merged), and
    texts are worked on PIECE_BYTES at a time.
    """
    spark = docs.sparkSession
    share_code(spark)
    with open(model_path, "rb") as file:
        model = file.read()
    read_model(model)  # an unknown kind of model is an error here, not in the tasks
    shared = spark.sparkContext.broadcast(model)
    key = f"pieces:{hashlib.sha256(model).hexdigest()}:{check}"
    narrow = docs.select(id_col, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_to_encode"))

    def state():
        agenda, library = Agenda(read_model(shared.value)), None
        if check:
            from sentencepiece import SentencePieceProcessor

            library = SentencePieceProcessor(model_proto=shared.value)
        return agenda.parts, _Parts(agenda, library)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        split, parts = worker_state(key, state)
        texts = batch.column("text_to_encode").to_pylist()
        ids = [",".join(map(parts.__getitem__, split(SPACE + t.replace(" ", SPACE)))) if t else "" for t in texts]
        columns = [batch.column(id_col), pa.array(ids, pa.string()),
                   pa.array([x.count(",") + 1 if x else 0 for x in ids], pa.int64())]
        if check:
            columns.append(pa.array(parts.agree(texts, ids), pa.bool_()))
        return pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "ids", "n_tokens", *(["agrees"] if check else [])]
    kinds = f"`{id_col}` {narrow.schema[id_col].dataType.simpleString()}, ids string, n_tokens bigint"

    def run(batches):
        for batch in batches:
            for piece in _by_bytes(batch, "text_to_encode"):
                yield work(piece)

    return narrow.mapInArrow(run, kinds + (", agrees boolean" if check else ""))


def decode(encoded: DataFrame, model_path: str, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(kept columns, decoded) for rows that hold ``ids``: the text that the ids stand
    for, as the library's decode(ids) gives it. Null or empty ids decode to the empty
    text; control ids to nothing; an unknown number raises KeyError."""
    spark = encoded.sparkSession
    share_code(spark)
    with open(model_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())
    key = "surface:" + hashlib.sha256(shared.value).hexdigest()
    narrow = encoded.select(*dict.fromkeys((*keep, "ids")))

    def run(batches):
        agenda = Agenda(read_model(shared.value))
        for batch in batches:
            for piece in _by_bytes(batch, "ids"):
                texts = [agenda.decode(x.split(",")) if x else "" for x in piece.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "decoded"])

    kinds = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in keep)
    return narrow.mapInArrow(run, f"{kinds}, decoded string")


def round_trip_digests(docs: DataFrame, model_path: str, *, id_col: str = "doc_id", text: str = "text",
                       check: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, agrees]): both directions for every row."""
    encoded = encode(docs, model_path, id_col=id_col, text=text, check=check)
    keep = (id_col, "n_tokens", "ids_sha256", *(["agrees"] if check else []))
    hashed = encoded.withColumn("ids_sha256", F.sha2(F.col("ids").cast("binary"), 256))
    back = decode(hashed, model_path, keep=keep)
    return back.select(*keep, F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
