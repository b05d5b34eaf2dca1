"""Weighted rendezvous sharding, DataFrame functions only.

Each row draws one number per shard from a hash of its key and the shard, and
goes where the number, scaled by the shard's weight, is smallest. A further shard
adds one draw, so that rows move into it and nowhere else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meritrix.session import stored

#: Parts of a shard that are numbered on their own, so that no task holds a shard.
PARTS = 256


def _draw(keys: Sequence[Column], shard: int, weight: float) -> Column:
    """Exponential draw: the smallest of several is theirs in proportion to the weights."""
    uniform = (F.shiftrightunsigned(F.xxhash64(*keys, F.lit(shard)), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
    return F.struct((-F.log(uniform) / F.lit(float(weight))).alias("draw"), F.lit(shard).alias("shard"))


def rendezvous(keys: Sequence[Column], weights: Sequence[float]) -> Column:
    """The shard of a key among shards with positive weights. Equal draws go to the
    lower number. Null key parts are skipped by the hash: they are one key."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a positive weight")
    draws = [_draw(keys, shard, weight) for shard, weight in enumerate(weights)]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def assign(docs: DataFrame, weights: Sequence[float], *, grown: Sequence[float] | None = None,
           keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """(keys, size, text_crc32, law, shard, slot, grown_shard) for every row.

    ``size`` is the text's UTF-8 length plus 1 (a null text: 1), ``slot`` numbers
    the rows of a shard from 0 without gaps, and ``grown_shard`` is the shard among
    the weights ``grown`` (null without them). Rows that share a key share a shard,
    repeated rows have slots of their own, and rows with a null key form one key.
    Other columns are ignored, whatever their names; an empty table gives no rows, and
    texts of any length only their size and checksum. The shard of a key never changes;
    slots depend on how the table is read, as equal rows are told apart by that.

    Rows are numbered inside small parts of a shard; the parts' offsets come from
    their counts, which are at most PARTS rows a shard. A part mixes in the row's
    content and its scan partition, so that a hot key is spread over all parts; the
    rows are written out before both uses of them, so that these agree.
    """
    ids = [F.col(k) for k in keys]
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        *ids, (F.octet_length(body) + 1).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
        rendezvous(ids, weights).alias("shard"),
        (rendezvous(ids, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.spark_partition_id().alias("scan_part"))
    part = F.pmod(F.xxhash64(*ids, "size", "text_crc32", "scan_part"), F.lit(PARTS)).cast("int")
    rows = stored(rows.withColumn("part", part).drop("scan_part"))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part").orderBy(*keys, "size", "text_crc32")
    numbered = rows.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(F.broadcast(offsets), ["shard", "part"]).select(
        *keys, "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("place")).cast("bigint").alias("slot"), "grown_shard")
