"""Exact grouped quantiles whose memory does not grow with a group.

Spark's ``percentile`` keeps every distinct value of a group in one task's
hash map. When one group holds a third of a 100 TB table that map does not
fit, so the quantile is found by selection instead:

1. count equal values (combined before the shuffle, spread over the values);
2. histogram the counts into a fixed number of buckets per group and find the
   bucket in which each wanted rank falls (at most ``buckets`` rows a group);
3. order only the values of those buckets and read the ranks off.

Where a bucket of a huge group would still hold too many values for one task, step 2 is
repeated inside it: each further round cuts the wanted buckets between their own
smallest and largest value, however unevenly the values lie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    specs: dict[str, tuple[str, float]],
    lo: float,
    hi: float,
    buckets: int = 2048,
    weight: str | None = None,
    few_groups: bool = False,
    rounds: int = 1,
) -> DataFrame:
    """Interpolated quantiles per group: ``specs`` maps alias -> (column, p).

    ``lo``/``hi`` only shape the histogram; values outside land in the end
    buckets and stay exact. ``weight`` names a column of repeat counts.
    ``few_groups`` says that the keys come from fixed label lists, so that the
    wanted buckets (two per group and quantile) are safe to broadcast. ``rounds`` is
    how often the histogram is taken: a task orders the values of one bucket of the last
    one, about 1 : ``buckets`` ** ``rounds`` of a group's range.
    """
    measures = list(dict.fromkeys(col for col, _ in specs.values()))
    group = [*keys, "m"]
    on_keys = ", ".join(f"`{k}`" for k in group)
    width = buckets / float(hi - lo)

    pairs = ", ".join(f"struct({i} AS m, CAST(`{c}` AS DOUBLE) AS v)" for i, c in enumerate(measures))
    values = (
        df.selectExpr(*keys, f"{weight or 1} AS w", f"inline(array({pairs}))")
        .filter("v IS NOT NULL")
        .groupBy(*group, "v").agg(F.sum("w").alias("n"))
        .selectExpr(*group, "v", "n", f"CAST(least(greatest(floor((v - {float(lo)}) * {width}D), 0), {buckets - 1}) AS BIGINT) AS b")
    )

    def ranks(p, total="total"):
        position = f"({float(p)}D * ({total} - 1))"
        return position, f"floor({position})", f"ceil({position})"

    holds_a_rank = " OR ".join(
        f"(m = {measures.index(c)} AND before <= {r} AND {r} < before + n_b)" for c, p in specs.values() for r in ranks(p)[1:])
    same = " AND ".join([f"`{k}` <=> `_{k}`" for k in keys] + ["m = _m", "b = _b"])

    def met(values: DataFrame, wanted: DataFrame) -> DataFrame:
        return values.join(F.broadcast(wanted) if few_groups else wanted, F.expr(same))

    wanted = None
    for _ in range(rounds):
        parent, base, total = "0", "0", f"sum(n_b) OVER (PARTITION BY {on_keys})"
        if wanted is not None:  # cut the wanted buckets of the round before
            inside = f"CAST(least(floor((v - low) / (high - low) * {buckets}D), {buckets - 1}) AS BIGINT)"
            values = met(values, wanted).selectExpr(
                *group, "v", "n", f"_b * {buckets} + CASE WHEN high > low THEN {inside} ELSE 0 END AS b", "_b", "before AS base", "total")
            parent, base, total = "_b", "base", "total"
        # at most `buckets` rows per group and bucket of the round before
        more = [f"any_value({c}) AS {c}" for c in ("_b", "base", "total") if wanted is not None]
        counted = values.groupBy(*group, "b").agg(
            F.sum("n").alias("n_b"), F.min("v").alias("low"), F.max("v").alias("high"), *map(F.expr, more))
        placed = counted.selectExpr(
            *group, "b", "n_b", "low", "high", f"{total} AS total",
            f"{base} + sum(n_b) OVER (PARTITION BY {on_keys}, {parent} ORDER BY b ROWS UNBOUNDED PRECEDING) - n_b AS before")
        wanted = placed.filter(holds_a_rank).selectExpr(
            *[f"`{k}` AS `_{k}`" for k in [*group, "b"]], "before", "total", "low", "high")
        values = values.select(*group, "v", "n", "b")

    ranked = met(values, wanted).selectExpr(
        *group, "v", "n", "total",
        f"before + sum(n) OVER (PARTITION BY {on_keys}, b ORDER BY v ROWS UNBOUNDED PRECEDING) - n AS first",
    )

    def at(c, rank):
        return f"max(v) FILTER (WHERE m = {measures.index(c)} AND first <= {rank} AND {rank} < first + n)"

    found = []
    for alias, (c, p) in specs.items():
        position, low, high = ranks(p)
        part = f"max({position} - {low}) FILTER (WHERE m = {measures.index(c)})"
        found.append(F.expr(f"{at(c, low)} + ({at(c, high)} - {at(c, low)}) * {part}").alias(alias))
    return ranked.groupBy(*keys).agg(*found)
