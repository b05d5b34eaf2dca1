"""Token counts without a shuffle of pre-tokens.

Two tiers of lookup on the map side: a broadcast table holds the lengths of
frequent pre-tokens, and a bounded cache in each Python worker holds those of
all others, which the tokenizer itself encodes on their first use. A text's
count is the sum of its pre-tokens' lengths, as merges never cross them.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections import Counter
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meritrix.llm.tasks import forget_state, map_batches, pieces, share_code, task, utf8, worker_state

#: Size of the broadcast table, and how many of its most frequent pre-tokens a task
#: reports with their counts. Both only decide which tier answers.
TABLE_SIZE = 65_536
TASK_SIZE = 16_384
#: Entries of a worker's cache before it starts anew.
CACHE_SIZE = 600_000


class PreTokens:
    """Splits texts as the tokenizer file says and encodes single pre-tokens."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
        parsed = json.loads(spec)
        normalizers = [n["type"] for n in parsed["normalizer"]["normalizers"]]
        split, level = parsed["pre_tokenizer"]["pretokenizers"]
        if (normalizers != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"]
                or level["type"] != "ByteLevel" or level["use_regex"] or level["add_prefix_space"]):
            raise ValueError("the tokenizer file splits texts in a way that this operator does not know")
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        if any(t.get(k) for t in parsed["added_tokens"] for k in ("normalized", "lstrip", "rstrip", "single_word")):
            raise ValueError("the tokenizer file treats added tokens in a way that this operator does not know")
        specials = [t["content"] for t in parsed["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.start = os.path.commonprefix(specials)  # a text without it has no special string
        self.tokenizer = Tokenizer.from_str(spec)

    def length(self, piece: str) -> int:
        return len(self.tokenizer.encode(piece, add_special_tokens=False))

    def of(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and the number of special strings in it, which
        the library takes as one token each before it normalises the rest."""
        parts = self.special.split(text) if self.special and self.start in text else [text]
        pieces: list[str] = []
        for part in parts:
            part = unicodedata.normalize("NFC", part)
            # one character at a time where Python's lower() looks at a neighbour
            part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            pieces += self.find(part)
        return pieces, len(parts) - 1


class _Cache(dict):
    """Second tier: lengths of rarer pre-tokens, encoded on their first use."""

    def __init__(self, length):
        super().__init__()
        self.length = length

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE_SIZE:
            self.clear()
        self[piece] = n = self.length(piece)
        return n


def frequent(docs: DataFrame, spec: str, text: str = "text") -> list[str]:
    """The most frequent pre-tokens of all rows. Each task counts its own and keeps a
    bounded number of counts; what it reports, at most TASK_SIZE counts, is summed, and
    the driver receives TABLE_SIZE pre-tokens."""
    schema = pa.schema([("piece", pa.string()), ("n", pa.int64())])

    def count(batches):
        forget_state()
        splitter, counts = PreTokens(spec), Counter()
        for batch in pieces(batches):
            for value in utf8(batch, text):
                counts.update(splitter.of(value.decode())[0])
            if len(counts) > 16 * TASK_SIZE:
                counts = Counter(dict(counts.most_common(4 * TASK_SIZE)))
        top = [(p, n) for p, n in counts.most_common(TASK_SIZE) if len(p) <= 64]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], schema=schema)

    sums = docs.select(text).mapInArrow(task(count), "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    return [r.piece for r in sums.orderBy(F.desc("n"), "piece").limit(TABLE_SIZE).collect()]


def packed(found: list[str], spec: str) -> tuple[bytes, bytes]:
    """The table as it travels: the pre-tokens in one text, and their lengths."""
    splitter = PreTokens(spec)
    return "\n".join(found).encode(), np.array(list(map(splitter.length, found)), np.uint16).tobytes()


def unpacked(table: tuple[bytes, bytes]) -> dict[str, int]:
    """For lookups in a worker. No pre-token holds a line break."""
    text, lengths = table
    return dict(zip(text.decode().split("\n"), np.frombuffer(lengths, np.uint16).tolist())) if lengths else {}


def count_tokens(docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text: str = "text",
                 limit: int = 2048) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids
    are kept as they are; other columns of ``docs`` are ignored, whatever their
    names. An empty table gives an empty result. A text is held whole in one task, with
    some 100 bytes for each of its pre-tokens. The texts are read twice, first to find
    the frequent pre-tokens; the counts depend on neither tier.
    """
    spark = docs.sparkSession
    share_code(spark)
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = file.read()
    narrow = docs.select(F.col(id_col), F.col(text).cast("string").alias("text"))
    table = packed(frequent(narrow, spec), spec)
    shared = spark.sparkContext.broadcast((spec, table))
    key = "tokens:" + hashlib.sha256(spec.encode() + table[0]).hexdigest()

    def state():
        spec, table = shared.value
        splitter = PreTokens(spec)
        return splitter, unpacked(table), _Cache(splitter.length)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        splitter, table, cache = worker_state(key, state)
        known, fetch, sizes, counts = table.__contains__, table.get, [], []
        for raw in utf8(batch, "text"):
            pieces, specials = splitter.of(raw.decode())
            rare = list(filterfalse(known, pieces))
            n = sum(filter(None, map(fetch, pieces)))
            counts.append(n + sum(map(cache.__getitem__, rare)) + specials)
            sizes.append(len(raw))
        return pa.RecordBatch.from_arrays(
            [batch.column(id_col), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
             pa.array([n > limit for n in counts], pa.bool_())],
            [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = narrow.schema[id_col].dataType.simpleString()
    return map_batches(narrow, work, f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
