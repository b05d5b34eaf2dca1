import random
import re

import pytest

from meritrix.functions import lookups as L
from meritrix.operators.resolver import any_of, distinct_titles, resolve_soc, resolve_titles, soc_patterns, soc_seed, soc_stats

GOLDEN = [
    ("Software Engineer", "software engineer", "15-1252", "exact", 1.0),
    ("Full-Stack Developer", "full stack developer", "15-1254", "exact", 1.0),
    ("Research Scientist", "research scientist", "15-2099", "exact", 1.0),
    ("Senior Research Scientist", "senior research scientist", "19-1042", "keyword", 0.72),
    ("Park Ranger", "park ranger", "33-3052", "exact", 1.0),
    ("Sofware Enginer", "sofware enginer", "15-1252", "fuzzy", 0.8667),
    ("Accountnt", "accountnt", "13-2011", "fuzzy", 0.8889),
    ("Dentst", "dentst", "29-1021", "fuzzy", 0.8333),
    ("Data, Analyst", "data  analyst", "15-2041", "fuzzy", 0.9231),
    ("Senior Data Analyst — Remote", "senior data analyst   remote", "15-2041", "keyword", 0.4286),
    ("Supervisory Management & Program Analyst", "supervisory management   program analyst", "13-1111", "keyword", 0.375),
    ("Health System Specialist", "health system specialist", "11-9111", "keyword", 0.5417),
    ("Aerospace Engineer, GS-13", "aerospace engineer  gs 13", "17-2011", "keyword", 0.72),
    ("Chief Nurse", "chief nurse", "11-1011", "keyword", 0.4545),
    ("Camp Counselor", "camp counselor", "21-1019", "keyword", 0.6429),
    ("Firewall Administrator", "firewall administrator", "33-2011", "keyword", 0.1818),
    ("Creditor Liaison", "creditor liaison", "27-3041", "keyword", 0.375),
    ("Chief of Staff, Office of the Director", "chief of staff  office of the director", "11-9199", "keyword", 0.2105),
    ("Front - End Lead", "front   end lead", "99-9999", "unmapped", 0.0),
    ("Tester", "tester", "99-9999", "unmapped", 0.0),
    ("RN", "rn", "99-9999", "unmapped", 0.0),
    ("???", "", "99-9999", "unmapped", 0.0),
]


def resolve(rows, titles, **kw):
    out = resolve_soc(rows("job_title string", *[(t,) for t in titles]), **kw).collect()
    return {r.title_normalized: r for r in out}


def test_golden_titles(rows):
    got = resolve(rows, [t for t, *_ in GOLDEN])
    assert len(got) == len(GOLDEN)
    for _, norm, code, method, confidence in GOLDEN:
        r = got[norm]
        assert (r.soc_code, r.match_method, round(r.match_confidence, 4)) == (code, method, confidence), norm
        assert r.soc_major_group == code[:2] + "-0000"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(title):
    for t, code, _ in L.SOC_TITLE_SEED:
        if t == title:
            return code, "exact"
    if 4 <= len(title) <= 60:
        d, _, code = min((edits(title, t), t, c) for t, c, _ in L.SOC_TITLE_SEED)
        if d <= max(2, int(len(title) * 0.15 + 0.5)):
            return code, "fuzzy"
    hits = [(-len(p), p, c) for p, c, _ in L.SOC_TITLE_PATTERNS if p in title]
    return (min(hits)[2], "keyword") if hits else ("99-9999", "unmapped")


def test_against_brute_force(rows):
    rng = random.Random(7)
    words = sorted({w for t, *_ in L.SOC_TITLE_SEED + L.SOC_TITLE_PATTERNS for w in t.replace("-", " ").split()})
    titles = set()
    for _ in range(250):
        text = list(" ".join(rng.choices(words, k=rng.randint(1, 4))))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice("abcdefgh ")
        titles.add("".join(text).strip())
    got = resolve(rows, titles)
    for t in titles:
        assert (got[t].soc_code, got[t].match_method) == brute(t), t


def test_counts_and_methods_partition_the_titles(rows):
    got = resolve(rows, ["Software Engineer", "software  engineer!", "Software Engineer", None, "zzzz"])
    assert got["software engineer"].posting_count == 2 and got["software engineer"].title_raw == "Software Engineer"
    stats = soc_stats(resolve_soc(rows("job_title string", ("Clerk",), ("RN",), ("RN",), ("Lawyer",)))).collect()
    assert {r.match_method: (r.title_count, r.total_postings) for r in stats} == {
        "keyword": (1, 1), "unmapped": (1, 2), "exact": (1, 1)}


def test_own_tables_and_refresh(rows):
    first = resolve_soc(rows("job_title string", ("Zookeeper",)))
    again = resolve_soc(rows("job_title string", ("Zookeeper",), ("Nurse",)), existing=first,
                        seed=[("zookeeper", "39-2021", "Animal Caretakers")], patterns=[("nurse", "29-1141", "Nurses")])
    assert {(r.title_normalized, r.soc_code) for r in again.collect()} == {("zookeeper", "39-2021"), ("nurse", "29-1141")}


def test_a_text_is_normalised_once(rows):
    plan = distinct_titles(rows("job_title string", ("Nurse",)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_frames_of_few_rows_need_no_joins(spark, rows):
    titles = rows("title_normalized string, title_raw string, posting_count long", ("nurse", "Nurse", 1))
    out = resolve_titles(titles, soc_seed(spark), soc_patterns(spark))
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.first().soc_code == "29-1141"


def test_any_of_finds_what_contains_finds(spark, rows):
    draw = random.Random(5)
    texts = {"".join(draw.choice("ab-. é") for _ in range(draw.randint(1, 5))) for _ in range(12)}
    titles = ["".join(draw.choice("ab-. éc") for _ in range(draw.randint(0, 12))) for _ in range(300)]
    frame = rows("t string", *((t,) for t in titles))
    got = {r.t: r.hit for r in frame.select("t", frame.t.rlike(any_of(texts)).alias("hit")).collect()}
    assert got == {t: any(x in t for x in texts) for t in titles} and re.compile(any_of(texts)) and len(set(got.values())) == 2
