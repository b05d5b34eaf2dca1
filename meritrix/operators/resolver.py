"""Free-text job title -> occupation code.

One aggregation finds the distinct titles; everything after it is local to a
row: exact seed title, then nearest seed title, then longest pattern contained
in the title, then the unmapped sentinel. The lookups are constants inside the
expressions, so there is no theta join however many titles there are. Lookups
that are frames, and may be large, are met by equi joins (``operators.matching``).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.functions import lookups as L
from meritrix.functions.derive import first_match, norm_b, soc_major_group
from meritrix.operators.matching import MAX_FUZZY_LENGTH, MIN_FUZZY_LENGTH, contained, edits_for, max_edits, nearest
from meritrix.operators.merge import upsert
from meritrix.session import stored

#: Rows of a lookup that every title can be compared with; larger ones are met by joins.
MOST_LISTED = 1_000


def soc_seed(spark, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or L.SOC_TITLE_SEED, "title_norm string, soc_code string, soc_title string")


def soc_patterns(spark, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or L.SOC_TITLE_PATTERNS, "pattern string, soc_code string, soc_title string")


def fips_names(spark, rows=None) -> DataFrame:
    return spark.createDataFrame(rows or L.STATE_FIPS_NAMES, "state_fips string, state_name string")


def _constant(value, kind: str) -> Column:
    """A literal of a nested type. It is one JSON text, folded once by the optimizer,
    instead of a thousand literals."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def exact_match(title: Column, seed) -> Column:
    found = {}
    for text, code, label in seed:
        found.setdefault(text, {"code": code, "label": label})
    return F.try_element_at(_constant(found, "map<string,struct<code:string,label:string>>"), title)


def nearest_seed(title: Column, seed) -> Column:
    """Closest seed title within the allowed distance (ties: smaller text).

    The seeds are listed by the title lengths that they can be near, so a title
    meets only those whose length does not exclude them.
    """
    allowed = max_edits(title)
    near = [[s for s in seed if abs(len(s[0]) - n) <= edits_for(n)] for n in range(MIN_FUZZY_LENGTH, MAX_FUZZY_LENGTH + 1)]
    by_length = _constant([[{"text": t, "code": c, "label": n} for t, c, n in s] for s in near],
                          "array<array<struct<text:string,code:string,label:string>>>")
    close = F.get(by_length, F.length(title) - MIN_FUZZY_LENGTH)
    scored = F.transform(close, lambda s: F.struct(
        F.call_function("levenshtein", title, s["text"], allowed).alias("edits"), s["text"].alias("text"),
        s["code"].alias("code"), s["label"].alias("label"),
    ))
    best = F.array_min(F.filter(scored, lambda s: s["edits"] >= 0))  # -1: more than allowed
    return F.when(F.length(title).between(MIN_FUZZY_LENGTH, MAX_FUZZY_LENGTH), best)


def any_of(texts) -> str:
    """Regular expression for strings that contain one of the texts: their common
    beginnings are tried once at each place."""
    tree: dict = {}
    for text in texts:
        node = tree
        for letter in text:
            node = node.setdefault(letter, {})
        node[""] = {}

    def spelled(node) -> str:
        if "" in node:  # a longer text is found by this one
            return ""
        ways = [(re.escape(letter) if letter.isascii() else letter) + spelled(rest) for letter, rest in sorted(node.items())]
        return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"

    return spelled(tree)


def longest_pattern(title: Column, patterns) -> Column:
    """Longest pattern inside the title (ties: alphabetical). Patterns are looked for
    one by one only in titles that hold any of them."""
    if not patterns:
        return F.lit(None).cast("struct<text:string,code:string,label:string>")
    ranked = sorted(patterns, key=lambda p: (-len(p[0]), *map(_first_null, p)))
    table = _constant([{"text": t, "code": c, "label": n} for t, c, n in ranked], "array<struct<text:string,code:string,label:string>>")
    hit = F.get(F.filter(table, lambda p: F.contains(title, p["text"])), F.lit(0))
    return F.when(title.rlike(any_of(p[0] for p in patterns)), hit)


def _first_null(value) -> tuple:
    """Sort key in the order of Spark's, NULL first."""
    return value is not None, value or ""


def distinct_titles(postings: DataFrame) -> DataFrame:
    """Normalised titles with a sample of the raw text and a posting count.

    Raw titles are counted first, so the regular expression runs once per
    distinct text. The normalised title is returned as an aggregate, not as
    the grouping key: a later filter on the resolved code would otherwise be
    pushed below the aggregation and resolve every posting.
    """
    raw = postings.filter(F.col("job_title").isNotNull()).groupBy("job_title").agg(F.count("*").alias("n"))
    return raw.withColumn("_title", norm_b("job_title")).groupBy("_title").agg(
        F.min("_title").alias("title_normalized"), F.min("job_title").alias("title_raw"), F.sum("n").alias("posting_count")
    ).drop("_title")


def resolve_titles(titles: DataFrame, seed=None, patterns=None) -> DataFrame:
    """Add code, method and confidence to rows with ``title_normalized``. The lookups
    are lists of (text, code, label), or both frames as ``soc_seed`` and
    ``soc_patterns`` make them, of any size; frames of few rows are used as lists."""
    if isinstance(seed, DataFrame) and isinstance(patterns, DataFrame):
        seed, patterns = _named(seed), _named(patterns.withColumnRenamed("pattern", "title_norm"))
        lists = [_listed(seed), _listed(patterns)]
        if None in lists:
            return _labelled(_met(titles, seed, patterns))
        seed, patterns = lists[0], [p for p in lists[1] if p[0]]
        return _labelled(_local(titles, seed, patterns))
    return _labelled(_local(titles, seed or L.SOC_TITLE_SEED, patterns or L.SOC_TITLE_PATTERNS))


def _named(lookup: DataFrame) -> DataFrame:
    """Lookup rows as (text, code, label), one per text: the smallest code and label."""
    rows = lookup.where("title_norm IS NOT NULL").groupBy(F.col("title_norm").alias("text"))
    return rows.agg(F.min(F.struct("soc_code", "soc_title")).alias("v")).select(
        "text", F.col("v.soc_code").alias("code"), F.col("v.soc_title").alias("label"))


def _listed(lookup: DataFrame) -> list[tuple] | None:
    """The rows of a lookup that has at most MOST_LISTED."""
    rows = lookup.limit(MOST_LISTED + 1).collect()
    return [tuple(r) for r in rows] if len(rows) <= MOST_LISTED else None


def _local(titles: DataFrame, seed, patterns) -> DataFrame:
    """The stages on constant lists, row by row."""
    title = F.col("title_normalized")
    # each stage is its own projection, so a later one is evaluated only on
    # rows that the earlier ones left open
    return (
        titles.withColumn("_exact", exact_match(title, seed))
        .withColumn("_fuzzy", F.when(F.col("_exact").isNull(), nearest_seed(title, seed)))
        .withColumn("_word", F.when(F.col("_exact").isNull() & F.col("_fuzzy").isNull(), longest_pattern(title, patterns)))
    )


def _met(titles: DataFrame, seed: DataFrame, patterns: DataFrame) -> DataFrame:
    """The same stages as joins; each one meets only the titles that are still open."""
    known = stored(seed)
    open_titles = stored(titles.join(
        known.select(F.col("text").alias("title_normalized"), F.struct("code", "label").alias("_exact")), "title_normalized", "left"))
    near = nearest(open_titles.where("_exact IS NULL"), known)
    fuzzy = near.select("title_normalized", F.struct("edits", "text", "code", "label").alias("_fuzzy"))
    open_titles = stored(open_titles.join(fuzzy, "title_normalized", "left"))
    inside = contained(open_titles.where("_exact IS NULL AND _fuzzy IS NULL"), stored(patterns))
    return open_titles.join(
        inside.select("title_normalized", F.struct("text", "code", "label").alias("_word")), "title_normalized", "left")


def _labelled(staged: DataFrame) -> DataFrame:
    """Code, method and confidence from the stages' finds."""
    length = F.length("title_normalized").cast("double")
    exact, fuzzy, word = F.col("_exact"), F.col("_fuzzy"), F.col("_word")

    def pick(field, otherwise):
        return F.coalesce(exact[field], fuzzy[field], word[field], F.lit(otherwise))

    return staged.select(
        pick("code", L.UNMAPPED_CODE).alias("soc_code"),
        pick("label", L.UNMAPPED_TITLE).alias("soc_title"),
        soc_major_group(pick("code", L.UNMAPPED_CODE)).alias("soc_major_group"),
        "title_normalized",
        "title_raw",
        first_match(
            [(exact.isNotNull(), "exact"), (fuzzy.isNotNull(), "fuzzy"), (word.isNotNull(), "keyword")], "unmapped"
        ).alias("match_method"),
        first_match(
            [
                (exact.isNotNull(), 1.0),
                (fuzzy.isNotNull(), 1.0 - fuzzy["edits"].cast("double") / length),
                (word.isNotNull(), F.least(F.lit(1.0), F.length(word["text"]).cast("double") / length)),
            ],
            0.0,
        ).alias("match_confidence"),
        "posting_count",
    )


def resolve_soc(postings: DataFrame, seed=None, patterns=None, existing: DataFrame | None = None) -> DataFrame:
    """One row per normalised title; re-running refreshes ``existing``."""
    resolved = resolve_titles(distinct_titles(postings), seed, patterns)
    return resolved if existing is None else upsert(
        existing, stored(resolved), ["title_normalized"], unique=True)


def soc_stats(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("match_method").agg(
        F.count("*").alias("title_count"), F.sum("posting_count").alias("total_postings")
    )
