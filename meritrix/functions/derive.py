"""Row-level derivations: every function maps Columns to a Column.

All of them are built-in expressions, so they stay inside whole-stage codegen
and are pruned or pushed by Catalyst like any other projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meritrix.functions import lookups as L


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(rules, default=None) -> Column:
    """CASE over ordered ``(condition, value)`` pairs."""
    out = F
    for condition, value in rules:
        out = out.when(condition, value)
    return out.otherwise(F.lit(default) if not isinstance(default, Column) else default)


# -- JSON payloads ---------------------------------------------------------

def with_payload(df: DataFrame, col: str = "raw_data") -> DataFrame:
    """Parse a JSON text column once, as VARIANT column ``payload``; text that
    is not JSON gives NULL."""
    return df.withColumn("payload", F.try_parse_json(col))


def json_path(payload, path: str, to: str = "string") -> Column:
    """Value at a path such as ``$.a.b[0]``, NULL when absent, out of range or
    not castable."""
    return F.try_variant_get(_col(payload), path, to)


def iso_date(c) -> Column:
    """Date part of an ISO timestamp string, NULL when it is not a date."""
    return F.substring(_col(c), 1, 10).try_cast("date")


# -- titles ----------------------------------------------------------------

#: ``a-z0-9``, letter by letter: Java keeps listed characters in one table, and ranges in
#: nested tests that take six times as long.
PLAIN = "abcdefghijklmnopqrstuvwxyz0123456789"


def norm_a(c) -> Column:
    """Lower-case, every run of other characters becomes one blank."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), f"[^{PLAIN}]+", " "))


def norm_b(c) -> Column:
    """Resolver form: like norm_a, but blanks already present are kept."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), f"[^{PLAIN} ]+", " "))


def one_blank(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), r"\s+", " "))


def level_private(title) -> Column:
    t = F.lower(_col(title))
    return first_match(
        [(t.rlike(L.ENTRY_WORDS_PRIVATE), "entry"), (t.rlike(L.SENIOR_WORDS_PRIVATE), "senior")],
        "mid",
    )


def level_federal(grade, title, salary_min) -> Column:
    t, pay = F.lower(_col(title)), _col(salary_min)
    return first_match(
        [
            (_col(grade) == "SES", "senior"),
            (t.rlike(L.ENTRY_WORDS_FEDERAL), "entry"),
            (t.rlike(L.SENIOR_WORDS_FEDERAL), "senior"),
            (pay < L.FEDERAL_ENTRY_BELOW, "entry"),
            (pay >= L.FEDERAL_SENIOR_FROM, "senior"),
        ],
        "mid",
    )


def is_entry(title, sector: str) -> Column:
    words = L.ENTRY_FLAG_WORDS_PRIVATE if sector == "private" else L.ENTRY_WORDS_FEDERAL
    return F.lower(_col(title)).rlike(words)


def employment_type(code, title, full: str, part: str) -> Column:
    """``full``/``part`` are the source's own codes for the two schedules."""
    c = _col(code)
    return first_match(
        [
            (c == full, "full_time"),
            (c == part, "part_time"),
            (F.lower(_col(title)).contains("intern"), "intern"),
        ],
        "unknown",
    )


def remote_private(description) -> Column:
    d = F.lower(_col(description))
    return first_match(
        [(d.rlike(r"\bremote\b"), "remote"), (d.rlike(r"\bhybrid\b"), "hybrid")], "unknown"
    )


def remote_federal(flag, description) -> Column:
    d = F.lower(F.coalesce(_col(description), F.lit("")))
    return first_match([(_col(flag), "remote"), (d.rlike(r"\bhybrid\b"), "hybrid")], "onsite")


# -- posting fields --------------------------------------------------------

def description_or_summary(content, summary) -> Column:
    return F.coalesce(_col(content), _col(summary))


def city_part(c) -> Column:
    return F.split_part(_col(c), F.lit(","), F.lit(1))


def annualise(amount, code) -> Column:
    """Yearly pay from an amount and its rate code (unknown codes are yearly)."""
    pay, rate = _col(amount).try_cast("double"), _col(code)
    return first_match([(rate == k, pay * n) for k, n in L.PAY_PERIODS.items() if n != 1], pay)


def is_predicted(c) -> Column:
    return F.coalesce(_col(c) == "1", F.lit(False))


def salary_midpoint(lo, hi) -> Column:
    low, high = _col(lo), _col(hi)
    return F.coalesce((low + high) / 2.0, low, high)


def present_mean(lo, hi) -> Column:
    """Mean of the present values; NULL when neither is."""
    return salary_midpoint(lo, hi)


def salary_text(lo, hi) -> Column:
    """Display form of a pay range; zero counts as missing."""
    low, high = F.nullif(_col(lo), F.lit(0.0)), F.nullif(_col(hi), F.lit(0.0))

    def dollars(c):
        return F.concat(F.lit("$"), F.format_number(c, 0))

    return first_match(
        [
            (low.isNotNull() & high.isNotNull(), F.concat(dollars(low), F.lit(" – "), dollars(high))),
            (low.isNotNull(), F.concat(dollars(low), F.lit("+"))),
            (high.isNotNull(), F.concat(F.lit("up to "), dollars(high))),
        ],
        "Salary not listed",
    )


def location_text(city, state) -> Column:
    """'city, state' without blank parts, else a placeholder."""
    def part(c):
        s = F.trim(_col(c))
        return F.when((s != "") & (F.lower(s) != "nan"), s)

    joined = F.concat_ws(", ", part(city), part(state))
    return F.when(joined != "", joined).otherwise("Unknown location")


# -- labels ----------------------------------------------------------------

def census_region(state) -> Column:
    s = _col(state)
    return first_match([(s.isin(names), region) for region, names in L.CENSUS_REGIONS.items()], "Other")


def agency_parent(name, sector) -> Column:
    n = F.lower(_col(name))
    return F.when(
        _col(sector) == "federal", first_match([(n.contains(p), code) for p, code in L.AGENCY_PARENTS])
    )


def category_group(category) -> Column:
    c = F.lower(_col(category))
    return first_match(
        [(reduce(Column.__or__, [c.contains(w) for w in words]), group) for group, words in L.CATEGORY_GROUPS],
        "Other",
    )


def area_type(agglvl, ranges=None) -> Column:
    level = _col(agglvl)
    return first_match(
        [(level.between(lo, hi), label) for lo, hi, label in ranges or L.AREA_TYPE_RANGES], "other"
    )


def own_label(code) -> Column:
    c = _col(code)
    return first_match([(c == k, label) for k, label in L.OWNERSHIP_LABELS.items()], "Other")


def industry_level(code) -> Column:
    c = _col(code)
    return F.when(c.rlike("^[0-9]{2,6}$"), F.length(c)).otherwise(0)


def state_fips(area) -> Column:
    a = _col(area)
    return F.when(F.length(a) >= 2, F.left(a, F.lit(2)))


def occupation_group(label) -> Column:
    text = F.lower(_col(label))
    return first_match([(text.contains(g), g) for g in L.OCCUPATION_GROUPS])


def soc_major_group(code) -> Column:
    return F.concat(F.left(_col(code), F.lit(2)), F.lit("-0000"))


def soc_major_title(group) -> Column:
    g = _col(group)
    return first_match([(g == k, title) for k, title in L.SOC_MAJOR_TITLES], L.UNMAPPED_TITLE)


def gap_direction(gap) -> Column:
    return F.when(_col(gap) > 0, "Federal pays more").otherwise("Private pays more")


# -- keys and calendar -----------------------------------------------------

def posting_key(source, job_id) -> Column:
    return F.concat(_col(source), F.lit("::"), _col(job_id))


def qcew_key(area="area_fips", industry="industry_code", own="own_code", year="year", qtr="qtr") -> Column:
    """Composite key; NULL when any part is NULL, so such rows can be rejected."""
    bar = F.lit("|")
    return F.concat(_col(area), bar, _col(industry), bar, _col(own).cast("string"), bar,
                    _col(year).cast("string"), bar, _col(qtr).cast("string"))


def oews_key(year="survey_year", area="area", occ="occ_code") -> Column:
    blank, bar = F.lit(""), F.lit("|")
    return F.concat(_col(year).cast("string"), bar, F.coalesce(_col(area), blank), bar,
                    F.coalesce(_col(occ), blank))


def date_key(d) -> Column:
    """yyyymmdd as INT, by arithmetic rather than by formatting and parsing."""
    day = _col(d)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def quarter_start(year, qtr) -> Column:
    return F.make_date(_col(year), (_col(qtr) - 1) * 3 + 1, F.lit(1))


def quarter_date_key(year, qtr) -> Column:
    return date_key(quarter_start(year, qtr))


def survey_date_key(year) -> Column:
    return date_key(F.make_date(_col(year), F.lit(5), F.lit(1)))


def calendar_attributes(d) -> list[Column]:
    """Calendar columns of a day; weeks count 0=Sun .. 6=Sat."""
    day = _col(d)
    weekday = F.dayofweek(day) - 1
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        weekday.isin(0, 6).alias("is_weekend"),
    ]


def drop_columns(df: DataFrame, cols) -> DataFrame:
    """SELECT * EXCLUDE (...)."""
    return df.drop(*cols)
