"""The n-gram join against all pairs."""

import random
import re

import numpy as np
import pytest

from meritrix.llm import ngram_join


def gram_set(text, n):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)])


def plain(rows, n, percent):
    """doc ids to (size, component) by all pairs; ids must be unique."""
    sets = {i: gram_set(t, n) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links, ids = set(), sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                links.add((b, a))
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in sets}, links, sets


@pytest.fixture
def near_copies():
    """Chains and stars of near copies, copies, shared passages, short and empty texts."""
    draw = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    rows, passage = [], [draw.choice(words) for _ in range(40)]

    def edited(base, k):
        out = list(base)
        for _ in range(k):
            out[draw.randrange(len(out))] = draw.choice(words)
        return out

    for size in (12, 30, 60, 130, 200):
        base = [draw.choice(words) for _ in range(size)]
        for _ in range(14):
            rows.append(edited(base, draw.randint(0, max(1, size // 30))))
        chain = base
        for _ in range(8):
            chain = edited(chain, 1)
            rows.append(chain)
    rows += [passage + [draw.choice(words) for _ in range(draw.randint(0, 60))] for _ in range(30)]
    rows += [["A", "b"], ["a", "B"], ["a"], ["a", "b", "c"], ["x"] * 50, ["x"] * 60]
    rows += [[f"s{j}" for j in range(k)] for k in (10, 11, 12, 13)]
    texts = [" ".join(r) for r in rows] + [None, "", " \n\t", "é É", "é É"] + [" ".join(rows[0])] * 6
    draw.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (1, 50), (3, 100)])
def test_components_equal_all_pairs(spark, near_copies, n, percent):
    frame = spark.createDataFrame([(i, t, 0) for i, t in near_copies], "doc_id bigint, text string, n int").repartition(4)
    expected, _, _ = plain(near_copies, n, percent)
    got = ngram_join.components(frame, n=n, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected and len(got) == len(expected)


def test_links_equal_all_pairs(spark, near_copies):
    frame = spark.createDataFrame(near_copies, "doc_id bigint, text string")
    _, links, sets = plain(near_copies, 3, 90)
    names = {}
    for i in sorted(sets):
        names.setdefault(sets[i], i)
    expected = {(names[sets[a]], names[sets[b]]) for a, b in links if sets[a] != sets[b]}
    got = {tuple(sorted((r.id_a, r.id_b))): r for r in ngram_join.links(frame, n=3, percent=90).collect()}
    assert set(got) == {tuple(sorted(p)) for p in expected} and len(got) > 20
    for (a, b), r in got.items():
        assert r.overlap == len(sets[a] & sets[b]) and {r.size_a, r.size_b} == {len(sets[a]), len(sets[b])}


def test_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(7, text), (7, text), (None, text), (9, text + " end"), (None, None), (None, None), (3, ""), (3, "")]
    got = ngram_join.components(spark.createDataFrame(rows, "doc_id bigint, text string"), n=3, percent=90).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == [
        (-1, 0, -1), (-1, 0, -1), (-1, 28, 7), (3, 0, 3), (3, 0, 3), (7, 28, 7), (7, 28, 7), (9, 29, 7)]
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.components(none, n=3, percent=90).count() == 0
    lone = ngram_join.components(spark.createDataFrame([(1, "a b c d")], "doc_id bigint, text string"), n=3, percent=90)
    assert [tuple(r) for r in lone.collect()] == [(1, 2, 1)]


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    draw = random.Random(1)
    raw = " ".join("x" * draw.randint(1, 90) for _ in range(500)).encode() + b"\n\n"
    whole = ngram_join.word_hashes(raw)
    monkeypatch.setattr(ngram_join, "PIECE", 64)
    assert np.array_equal(ngram_join.word_hashes(raw), whole) and len(whole) == 500
    assert ngram_join.word_hashes(b"Aa aA aa")[0] == ngram_join.word_hashes(b"aa")[0]


def test_connected_on_a_long_path(spark):
    ids = [bytes([i]) for i in range(40)]
    order = ids[::2] + ids[1::2]
    edges = spark.createDataFrame([(bytearray(a), bytearray(b)) for a, b in zip(order, order[1:])], "a binary, b binary")
    got = {bytes(r.id): bytes(r.component) for r in ngram_join.connected(edges).collect()}
    assert got == {i: ids[0] for i in ids}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected, _, _ = plain([(r.doc_id, r.text) for r in docs.collect()], 3, 90)
    got = ngram_join.components(docs, n=3, percent=90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert len({r.component_id for r in got}) < len(got)
