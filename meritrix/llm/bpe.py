"""Byte-level BPE encoding and decoding.

Two tiers: a minimal perfect hash resolves pre-tokens that are whole vocabulary
entries; for the others, a heap of mergeable neighbours over linked bytes applies
the ranks in O(n log n), however long the pre-token is.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import map_batches, share_code, utf8, worker_state

#: Pre-tokens whose ids a worker keeps before it starts anew.
CACHE_SIZE = 400_000
_MASK = (1 << 64) - 1


def _mixed(key: bytes) -> tuple[int, int]:
    """Two independent 32-bit hashes of a key."""
    digest = hashlib.blake2b(key, digest_size=8).digest()
    return int.from_bytes(digest[:4], "little"), int.from_bytes(digest[4:], "little")


class PerfectHash:
    """Minimal perfect hash by displacement: n keys in n slots. Keys fall into
    about n / 4 buckets; each bucket, the largest first, takes the smallest
    displacement that sends all its keys to free slots. The slot stores the key,
    so that a lookup of any other key is recognised as a miss."""

    def __init__(self, entries: dict[bytes, int]):
        n = self.n = max(1, len(entries))
        n_buckets = self.n_buckets = max(1, n // 4)
        buckets: list[list[tuple[int, int, bytes]]] = [[] for _ in range(n_buckets)]
        for key in entries:
            a, b = _mixed(key)
            buckets[a % n_buckets].append((a, b, key))
        self.displacements = [0] * n_buckets
        self.keys: list[bytes | None] = [None] * n
        self.values = [0] * n
        for at in sorted(range(n_buckets), key=lambda i: -len(buckets[i])):
            bucket, d = buckets[at], 0
            if not bucket:
                break
            while True:
                slots = {self._slot(a, b, d) for a, b, _ in bucket}
                if len(slots) == len(bucket) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
                if d > 1 << 22:
                    raise ValueError("two vocabulary entries share both hashes")
            self.displacements[at] = d
            for a, b, key in bucket:
                slot = self._slot(a, b, d)
                self.keys[slot], self.values[slot] = key, entries[key]

    def _slot(self, a: int, b: int, d: int) -> int:
        x = (a + d * 0x9E3779B97F4A7C15 ^ b * 0xBF58476D1CE4E5B9) & _MASK
        return (((x ^ x >> 29) * 0x94D049BB133111EB & _MASK) >> 20) % self.n

    def get(self, key: bytes) -> int | None:
        a, b = _mixed(key)
        slot = self._slot(a, b, self.displacements[a % self.n_buckets])
        return self.values[slot] if self.keys[slot] == key else None


class Encoder:
    """Encodes pre-tokens and decodes ids by a table of ranks. Every single byte
    must have a rank, as it has in the usual tables."""

    def __init__(self, ranks: dict[bytes, int], whole: PerfectHash | None = None):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.ranks = ranks
        self.whole = whole or PerfectHash(ranks)

    def encode_piece(self, piece: bytes) -> list[int]:
        rank = self.whole.get(piece)
        return [rank] if rank is not None else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Joins neighbours in the order of (rank, position). ``ends[i]`` is where
        the part that starts at i ends (0: it was joined to its left neighbour),
        ``left[i]`` where its left neighbour starts. A heap entry is stale when its
        parts have changed since, which its length shows."""
        n, rank_of = len(piece), self.ranks.get
        ends, left = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, i, 2) for i in range(n - 1) if (r := rank_of(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, length = heapq.heappop(heap)
            middle = ends[i]
            if not middle or middle == n or ends[middle] - i != length:
                continue
            end = i + length
            ends[i], ends[middle] = end, 0
            if end < n:
                left[end] = i
                if (r := rank_of(piece[i:ends[end]])) is not None:
                    heapq.heappush(heap, (r, i, ends[end] - i))
            before = left[i]
            if before >= 0 and (r := rank_of(piece[before:end])) is not None:
                heapq.heappush(heap, (r, before, end - before))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[piece[i:ends[i]]])
            i = ends[i]
        return ids


class _Pieces(dict):
    """Pre-token to its ids as decimal text; filled on first use, bounded."""

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> str:
        if len(self) >= CACHE_SIZE:
            self.clear()
        self[piece] = ids = " ".join(map(str, self.encoder.encode_piece(piece.encode())))
        return ids


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks from a file of ``base64 rank`` lines."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text: str = "text",
           keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, kept columns, ids, n_tokens) for every row: ``ids`` holds the decimal
    ids of the whole text, joined by one space.

    A null or empty text has no ids and the empty string. Repeated rows and null
    ids stay; columns not named in ``keep`` are ignored, whatever their names; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    share_code(spark)
    ranks = load_ranks(ranks_path)
    shared = spark.sparkContext.broadcast((ranks, PerfectHash(ranks)))
    key = "bpe:" + hashlib.sha256(repr((sorted(ranks.items()), pattern)).encode()).hexdigest()
    narrow = docs.select(id_col, *keep, F.col(text).cast("string").alias("text_to_encode"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        find, pieces = worker_state(key, lambda: (regex.compile(pattern).findall, _Pieces(Encoder(*shared.value))))
        ids = [" ".join(map(pieces.__getitem__, find(raw.decode()))) for raw in utf8(batch, "text_to_encode")]
        kept = [batch.column(name) for name in (id_col, *keep)]
        counts = pa.array([x.count(" ") + 1 if x else 0 for x in ids], pa.int64())
        return pa.RecordBatch.from_arrays([*kept, pa.array(ids, pa.string()), counts],
                                          [id_col, *keep, "ids", "n_tokens"])

    kinds = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in (id_col, *keep))
    return map_batches(narrow, work, f"{kinds}, ids string, n_tokens bigint")


def decode(encoded: DataFrame, ranks_path: str, *, keep: tuple[str, ...] = ("doc_id",),
           keep_ids: bool = False) -> DataFrame:
    """(kept columns, decoded) for rows that hold ``ids``: the bytes that the ids
    stand for. Null ids decode to no bytes; an unknown id raises KeyError."""
    spark = encoded.sparkSession
    share_code(spark)
    ranks = load_ranks(ranks_path)
    shared = spark.sparkContext.broadcast({str(rank): token for token, rank in ranks.items()})
    keep = (*keep, "ids") if keep_ids else keep
    narrow = encoded.select(*dict.fromkeys((*keep, "ids")))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        token = shared.value.__getitem__
        texts = [b"".join(map(token, x.split(" "))) if x else b"" for x in batch.column("ids").to_pylist()]
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.binary())],
                                          [*keep, "decoded"])

    kinds = ", ".join(f"`{c}` {narrow.schema[c].dataType.simpleString()}" for c in keep)
    return map_batches(narrow, work, f"{kinds}, decoded binary")


def round_trip_digests(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id",
                       text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): both directions for every row."""
    encoded = encode(docs, ranks_path, pattern, id_col=id_col, text=text)
    hashed = encoded.select(id_col, "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"), "ids")
    back = decode(hashed, ranks_path, keep=(id_col, "n_tokens", "ids_sha256"))
    return back.select(id_col, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
