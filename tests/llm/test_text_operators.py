"""Decontamination, personal data and quality rules against brute force."""

import hashlib
import random
from collections import Counter
import re

import pytest

from meritrix.llm import decontaminate, pii, rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_hits(docs, items):
    """Every window at every place, by comparison."""
    out = {}
    for doc, text in docs:
        words, hit, found = WORD.findall((text or "").translate(LOWER)), set(), set()
        for item, item_text in items:
            other = WORD.findall((item_text or "").translate(LOWER))
            n = min(10, len(other))
            windows = {tuple(other[i:i + n]) for i in range(len(other) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(item)
        names = sorted(str(i) for i in found if i is not None)
        out[doc] = (len(words), len(hit), len(names), sha(",".join(names)), bool(hit))
    return out


@pytest.fixture
def searched(spark):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice("aa B c dé e.f ü x-y 7".split()) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 2, 3, 9, 10, 11, 30, 12])] + [(7, "again b c"), (None, "q r"), (90, None)]
    docs = [(i, text(draw.randint(0, 80))) for i in range(60)]
    docs += [(100 + i, f"Intro! {t} -- {t}\nend q R") for i, (_, t) in enumerate(items)]
    docs += [(200, None), (201, ""), (202, "...")]
    return docs, items


def test_contamination_equals_brute_force(spark, searched, monkeypatch):
    docs, items = searched
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, n_hit int").repartition(3)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    expected = plain_hits(docs, items)
    for block in (decontaminate.BLOCK_BYTES, 60):  # in one pass, and in several
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        monkeypatch.setattr(decontaminate, "PASSES_PER_JOB", 2)
        got = decontaminate.digests(decontaminate.find_contamination(frame, bench)).collect()
        assert {r.doc_id: tuple(r)[1:] for r in got} == expected


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id bigint, text string")
    got = decontaminate.digests(decontaminate.find_contamination(docs, none)).collect()
    assert sorted(r.n_words for r in got) == [0, 2, 2] and not any(r.contaminated for r in got)
    assert decontaminate.find_contamination(docs.where("false"), none).count() == 0


def test_contamination_over_a_whole_table(spark):
    directory = "/root/testdata/sf0.001"
    docs, bench = (spark.read.parquet(f"{directory}/{t}.parquet") for t in ("documents", "benchmark"))
    got = decontaminate.digests(decontaminate.find_contamination(docs, bench)).collect()
    expected = plain_hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert {r.doc_id: tuple(r)[1:] for r in got} == expected
    assert any(r.contaminated for r in got)


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_spans(text):
    """The base definitions as regular expressions with their checks."""
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p[-4:]) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


PII_TEXTS = [
    None, "", "mail a.b+c@x-y.co.uk, é@é.com ü.a@b.cd. a@b@c.de x@y.z@q.rs @a.b a@b", "1.2.3.4.5.6.7.8.9 256.1.1.1 0001.02.3.255",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1111 4111  1111", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "+1 (555) 123-4567, +44 20 7946 0958. +1 +12 +1--2 ++49 (0)30 123456 - +", "9" * 6000, "1." * 3000, "+1" + "(" * 4000,
    'token = "24be64439e3e49cf46b2d7c90f36" API_KEY: abcdefghijklmnopqrst12 token of thanks', "IBAN DE89 3704 0044 0532 0130 00 end",
    "ssn: 123-45-6789 https://user:pw@host.example.com/x?y http://plain.example.com", "😀 a@b.cd 漢 1.2.3.4",
]


def test_base_spans_equal_the_expressions(spark):
    draw = random.Random(8)
    texts = PII_TEXTS + ["".join(draw.choice("aé.@+1234567890 -()%\n") for _ in range(draw.randint(1, 90))) for _ in range(2500)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    for row in pii.find_pii(docs.repartition(4)).collect():
        expected = plain_spans(texts[row.doc_id] or "")
        assert row.base_spans == expected, texts[row.doc_id]
        assert row.spans.startswith(expected)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [expected.count(f"{k}:") for k in BASE]


def test_added_spans_and_masks():
    finder = pii.Finder()
    kinds = lambda t: {k for k, v in finder.spans(t).items() if v}
    assert kinds(PII_TEXTS[10]) == {"secret"} and len(finder.spans(PII_TEXTS[10])["secret"]) == 2
    (span,) = finder.spans(PII_TEXTS[11])["iban"]
    assert PII_TEXTS[11][slice(*span)] == "DE89 3704 0044 0532 0130 00"
    assert {"ssn", "url"} <= kinds(PII_TEXTS[12]) and len(finder.spans(PII_TEXTS[12])["url"]) == 1
    assert kinds("A plain text about tokens, http://example.com and section 12.3.") == set()
    text = "write to a@b.cd or +1 555 123 4567!"
    assert pii.masked(text, finder.spans(text)) == "write to <EMAIL> or <PHONE>!"


def test_personal_data_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (None, None)], "doc_id bigint, text string")
    got = pii.find_pii(docs, mask=True).collect()
    assert sorted((r.doc_id or 0, r.masked_text) for r in got if r.doc_id) == [(1, "<EMAIL>")] * 2
    assert [r.masked_text for r in got if r.doc_id is None] == [None]
    assert pii.digests(pii.find_pii(docs.where("false"))).count() == 0


def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def test_rules_equal_brute_force(spark):
    draw = random.Random(4)
    texts = ["", " \x0b\n", "a b c a b c", "é\x85ü nb sp\x1cz"] + [
        "".join(draw.choice(["a ", "bé ", "#", "\n", "c\t", "A", "x y z\n"]) for _ in range(draw.randint(1, 150))) for _ in range(200)]
    texts += [" ".join(f"word{i}" for i in range(60)), " ".join(f"Word{i}##" for i in range(60))]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(-1, None, 5), (None, texts[-2], 5)]
    got = rules.apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, kept int").repartition(3)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = texts[-2] if row.doc_id is None else (texts[row.doc_id] if row.doc_id >= 0 else "")
        n, *_, repeated = expected = plain_measures(text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == expected
        assert row.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert row.kept == (row.failed_rule is None) and not (row.base_failed and row.kept)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].kept and by_id[len(texts) - 1].failed_rule == "symbols"


def test_order_of_the_cascade_changes_no_verdict():
    draw = random.Random(6)
    texts = [rules.Text("".join(draw.choice(["a ", "B! ", "#", "\n", "c d e\n"]) for _ in range(200)).encode()) for _ in range(50)]
    for _ in range(10):
        order = list(rules.RULES)
        draw.shuffle(order)
        assert [rules.verdict(t, order)[0] is None for t in texts] == [rules.verdict(t, rules.RULES)[0] is None for t in texts]
    costs = {"few_words": (1.0, 0.5), "symbols": (0.1, 0.2), "upper_case": (0.1, 0.0)}
    assert [r.name for r in rules.ordered(rules.RULES, costs)][:2] == ["symbols", "few_words"]


def test_rules_on_an_empty_table(spark):
    assert rules.apply_rules(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_a_text_meets_no_rule_after_the_one_that_rejects_it(spark, tmp_path):
    """The dear rule writes down each text that it is asked about."""
    marks = str(tmp_path)

    def dear(text):
        open(f"{marks}/{hash(text.raw)}-{random.random()}", "w").close()
        return text.n_repeat_words < 0

    cascade = [rules.Rule("dear", dear), rules.Rule("cheap", lambda t: t.raw.startswith(b"bad"))]
    docs = spark.createDataFrame([(i, "bad text" if i % 10 else "fine text") for i in range(400)], "doc_id int, text string").coalesce(2)
    got = rules.apply_rules(docs, cascade, measures=False)
    assert got.columns == ["doc_id", "kept", "failed_rule", "n_rules"]
    rows = got.collect()
    asked = len(list(tmp_path.iterdir()))
    assert {r.n_rules for r in rows if r.doc_id % 10} == {1} and {r.n_rules for r in rows if not r.doc_id % 10} == {2}
    assert asked == 2 * rules.SAMPLE_ROWS + 40  # the sample of each partition, and the texts that pass the cheap rule
    assert sum(r.kept for r in rows) == 40


def test_the_sample_covers_every_partition(spark):
    docs = spark.createDataFrame([(i, "x " * 60 if i < 600 else "short") for i in range(1_200)], "doc_id int, text string").coalesce(1).repartitionByRange(4, "doc_id")
    cost, share = rules.estimate(docs)["few_words"]
    assert cost > 0 and share == 0.5


def test_windows_of_long_texts_are_counted_alike():
    draw = random.Random(9)
    for n in (rules.MANY_WORDS, rules.MANY_WORDS + 777):
        words = [draw.choice("abcdefghij").encode() * draw.randint(1, 9) for _ in range(n)]
        whole = rules._repeated_in_windows(words)
        seen = Counter(zip(words, words[1:], words[2:]))
        covered = {at + k for at in range(n - 2) if seen[tuple(words[at:at + 3])] > 1 for k in range(3)}
        assert whole == len(covered) > 0
    assert rules._repeated_in_windows([str(i).encode() for i in range(30_000)]) == 0
