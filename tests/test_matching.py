"""Equi-join matches against brute force and against the constant lookups."""

import random

from pyspark.sql import functions as F

from meritrix.functions import lookups as L
from meritrix.operators import matching as M
from meritrix.operators.resolver import resolve_soc, soc_patterns, soc_seed
from tests.test_resolver import edits

LOOKUP = "text string, code string, label string"


def allowed(title):
    return max(2, int(len(title) * 0.15 + 0.5))


def changed(draw, text, n, letters="abcd "):
    chars = list(text)
    for _ in range(n):
        at, kind = draw.randrange(len(chars) + 1), draw.randrange(3)
        if kind == 0:
            chars.insert(at, draw.choice(letters))
        elif chars and at < len(chars):
            chars[at:at + 1] = [draw.choice(letters)] if kind == 1 else []
    return "".join(chars)


def sample(seed, n_lookup, n_titles):
    draw = random.Random(seed)
    known = {"".join(draw.choice("abcd ") for _ in range(draw.randint(0, 66))) for _ in range(n_lookup)}
    known |= {"é", "ab", "abc", "日本語テキスト", "x" * 70}
    titles = {changed(draw, draw.choice(sorted(known)), draw.randint(0, 10)) for _ in range(n_titles)} | {"", "a", "abcd", "x" * 60, "x" * 61}
    return sorted(known), sorted(titles)


def test_nearest_equals_brute_force(spark, rows):
    known, titles = sample(1, 250, 500)
    lookup = rows(LOOKUP, *((t, f"c{len(t)}", t[:3]) for t in known), ("abcd", "c0", "tie"))
    got = {r.title_normalized: (r.edits, r.text, r.code) for r in M.nearest(rows("title_normalized string", *((t,) for t in titles)), lookup).collect()}
    want = {}
    for title in titles:
        near = min((edits(title, t), t, c) for t, c in [*((t, f"c{len(t)}") for t in known if t), ("abcd", "c0")] if abs(len(t) - len(title)) <= 12) \
            if 4 <= len(title) <= 60 else None
        if near and near[0] <= allowed(title):
            want[title] = near
    assert got == want and len(want) > 200


def test_every_number_of_edits_is_found(spark, rows):
    """Titles at exactly the allowed distance, for every length."""
    draw, pairs = random.Random(4), []
    for n in range(4, 61):
        for _ in range(6):
            title = "".join(draw.choice("abcdefghijkl") for _ in range(n))
            text, k = title, allowed(title)
            while edits(title, text) != k:
                text = changed(draw, title, k, "mnopq")
            pairs.append((title, text))
    lookup = rows(LOOKUP, *((t, "c", "l") for t in {t for _, t in pairs}))
    got = {r.title_normalized: r.edits for r in M.nearest(rows("title_normalized string", *{(t,) for t, _ in pairs}), lookup).collect()}
    assert all(got[title] <= allowed(title) for title, _ in pairs)


def test_contained_equals_brute_force(spark, rows):
    draw = random.Random(2)
    known = {"".join(draw.choice("abc ") for _ in range(draw.randint(0, 6))) for _ in range(60)} | {"é", "ab", "日本"}
    titles = {"".join(draw.choice("abcé ") for _ in range(draw.randint(0, 40))) for _ in range(300)} | {"", "x日本y", "é" * 5_000 + "abc"}
    lookup = rows(LOOKUP, *((t, f"c{t}", "l") for t in known), ("ab", "a-first", "l"))
    got = {r.title_normalized: (r.text, r.code) for r in M.contained(rows("title_normalized string", *((t,) for t in titles)), lookup).collect()}
    codes = [(t, f"c{t}") for t in known if t] + [("ab", "a-first")]
    want = {}
    for title in titles:
        hits = [(-len(t), t, c) for t, c in codes if t in title]
        if hits:
            want[title] = min(hits)[1:]
    assert got == want and 50 < len(want) < len(titles)


def test_frames_and_lists_resolve_alike(spark, rows):
    draw = random.Random(7)
    words = sorted({w for t, *_ in L.SOC_TITLE_SEED + L.SOC_TITLE_PATTERNS for w in t.replace("-", " ").split()})
    titles = [changed(draw, " ".join(draw.choices(words, k=draw.randint(1, 4))), draw.randint(0, 3), "abcdefgh ") for _ in range(300)]
    postings = rows("job_title string", *((t,) for t in [*titles, *(t for t, *_ in L.SOC_TITLE_SEED), None, "", "???"]))
    lists = resolve_soc(postings).collect()
    frames = resolve_soc(postings, seed=soc_seed(spark), patterns=soc_patterns(spark)).collect()
    assert sorted(map(tuple, lists), key=str) == sorted(map(tuple, frames), key=str)


def test_a_hundred_thousand_seeds(spark, rows):
    """Names that differ by a few digits, so that each title is near very many."""
    parts = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    names = parts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(49)))).select(F.concat_ws(
        " ", "p_name", F.lower("p_type"), F.lit("model"), "p_partkey", "copy").alias("title_norm"))
    seed = names.withColumns({"soc_code": F.lit("15-0000"), "soc_title": F.col("title_norm")})
    assert seed.distinct().count() == 100_000
    known = sorted(r.title_norm for r in seed.collect())
    draw = random.Random(3)
    titles = {changed(draw, t, draw.randint(0, 4), "abcd19") for t in draw.sample(known, 60)}
    out = resolve_soc(rows("job_title string", *((t,) for t in titles)), seed=seed, patterns=soc_patterns(spark)).collect()
    exact = set(known)
    for r in out:
        title = r.title_normalized
        if title in exact:
            assert (r.match_method, r.soc_title) == ("exact", title)
        elif r.match_method == "fuzzy":
            assert edits(title, r.soc_title) == round((1 - r.match_confidence) * len(title)) <= allowed(title)
            closer = [t for t in draw.sample(known, 300) if (edits(title, t), t) < (edits(title, r.soc_title), r.soc_title)]
            assert not closer
    assert sum(r.match_method in ("exact", "fuzzy") for r in out) >= 0.9 * len(out)


def test_empty_lookups(spark, rows):
    postings = rows("job_title string", ("Nurse",), ("zz",))
    none = resolve_soc(postings, seed=soc_seed(spark).limit(0), patterns=soc_patterns(spark).limit(0)).collect()
    assert {r.match_method for r in none} == {"unmapped"} and len(none) == 2
    assert resolve_soc(postings.limit(0), seed=soc_seed(spark), patterns=soc_patterns(spark)).count() == 0


def test_keys_of_rows_are_not_broadcast(spark, rows):
    """The planner counts the keys of a small file as its rows; a broadcast of them fills the driver."""
    titles, lookup = rows("title_normalized string", ("goods clerk no 17",)), rows(LOOKUP, ("goods clerk no 18", "c", "l"))
    for frame in (M.nearest(titles, lookup), M.contained(titles, lookup)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
        for part in plan.split("BroadcastExchange")[1:]:
            assert "Generate" not in part.split("Exchange hashpartitioning")[0].split("Join")[0]


def test_a_title_in_a_crowd_meets_few_texts(spark, rows):
    """Thousands of texts have the same words at the same place; only keys of the whole text are met."""
    lookup = spark.range(3_000).selectExpr("concat('large ring economy no ', 10000 + id) AS text", "'c' AS code", "'l' AS label")
    titles = lookup.selectExpr("concat('xy', text) AS title_normalized")
    got = M.nearest(titles, lookup).collect()
    assert len(got) == 3_000 and all(r.edits == 2 and "xy" + r.text == r.title_normalized for r in got)


def test_two_edits_leave_all_but_two_segments():
    """A title and a text within two edits share a key, however the text is cut."""
    draw = random.Random(11)

    def kept(text, pieces):
        return {(of, text[:head], text[at - 1:at - 1 + width], text[tail - 1:]) for of, head, at, width, tail in pieces}

    for _ in range(20_000):
        text = "".join(draw.choice("abc") for _ in range(draw.randint(1, 16)))
        bounds = [0, *sorted(draw.randint(0, len(text)) for _ in range(draw.choice(M.SEGMENTS) - 1)), len(text)]
        title = changed(draw, text, draw.randint(0, 2), "abcd")
        assert kept(text, M.text_pieces(bounds)) & kept(title, M.title_pieces(len(title), {len(text): bounds})), (text, title, bounds)


def test_segments_are_cut_where_texts_differ():
    bounds = M.cuts(1_000_000, [0.5] + [0.0] * 17 + [3.3] * 7)
    assert bounds[0] == 0 and bounds[-1] == 25 and sorted(bounds) == bounds and sum(b >= 18 for b in bounds) >= 4
    assert M.cuts(1, [0.0]) == [*sorted(M.cuts(1, [0.0]))] and M.cuts(1, [0.0])[-1] == 1


def test_keys_are_few(spark, monkeypatch):
    """The keys of a row take the disk: of a text of 25 characters 326 are left by two deletions."""
    counts, closest = [], M._closest

    def counted(asked, asked_keys, texts, text_keys, allowed):
        counts.append([f.select(F.avg(F.size(k))).first()[0] for f, k in ((asked, asked_keys), (texts, text_keys))])
        return closest(asked, asked_keys, texts, text_keys, allowed)

    monkeypatch.setattr(M, "_closest", counted)
    lookup = spark.range(5_000).selectExpr("concat('large ring economy no ', 10000 + id) AS text", "'c' AS code", "'l' AS label")
    assert M.nearest(lookup.selectExpr("concat('xy', text) AS title_normalized"), lookup).count() == 5_000
    of_title, of_text = counts[0]
    assert of_title < 120 and of_text < 40


def test_texts_are_asked_for_only_where_titles_are_left(spark, monkeypatch):
    """No title is left after two edits: no text gets keys for more."""
    asked, closest = [], M._closest

    def seen(titles, title_keys, texts, text_keys, allowed):
        asked.append((titles.count(), texts.count()))
        return closest(titles, title_keys, texts, text_keys, allowed)

    monkeypatch.setattr(M, "_closest", seen)
    lookup = spark.range(50).selectExpr("concat('large ring economy no ', 10000 + id) AS text", "'c' AS code", "'l' AS label")
    assert M.nearest(lookup.selectExpr("concat('xy', text) AS title_normalized"), lookup).count() == 50
    assert asked == [(50, 50), (0, 0)]


def test_many_beginnings_are_not_listed(rows, monkeypatch):
    """Titles get the same matches where texts begin in too many ways to be listed."""
    known, titles = sample(5, 120, 200)
    lookup, asked = rows(LOOKUP, *((t, "c", "l") for t in known)), rows("title_normalized string", *((t,) for t in titles))
    short = lookup.where("length(text) < 9")
    listed = [sorted(map(tuple, f.collect())) for f in (M.nearest(asked, lookup), M.contained(asked, short))]
    for most in (0, 4):
        monkeypatch.setattr(M, "BEGINNINGS", most)
        assert listed == [sorted(map(tuple, f.collect())) for f in (M.nearest(asked, lookup), M.contained(asked, short))]
    assert all(listed)
