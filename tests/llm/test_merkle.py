"""The Merkle manifest against trees built in plain Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from meritrix.llm import merkle, queries

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
DOCS = "text string, doc_id bigint, lang string, source string, n_chars bigint, `group` string, node int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 16])) for i in range(0, len(below), 16)])
    return levels


def path_of(levels, index):
    steps = []
    for nodes in levels[:-1]:
        start = index // 16 * 16
        run = nodes[start:start + 16]
        steps.append((run[:index - start], run[index - start + 1:]))
        index //= 16
    return steps


def plain_digests(rows):
    """rows of COLUMNS -> sorted output rows"""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, plain_leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda x: x[:3])
        trees[source] = levels_of([leaf for _, _, leaf, _ in groups[source]])
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for at, source in enumerate(order):
        for index, (_, _, leaf, row) in enumerate(groups[source]):
            path = path_of(trees[source], index) + path_of(top, at)
            now = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                now = plain_leaf((*row[:4], "".join(c.lower() if c < "\x80" else c for c in row[4])))
            for before, after in path:
                now = h("".join(before) + now + "".join(after))
            proof = h("".join("".join(b) + "".join(a) for b, a in path))
            out.append((row[0], leaf, trees[source][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, **options):
    """Through the operator, with the changes of the registered query and clashing extra columns."""
    docs = spark.createDataFrame([(t, i, lang, s, n, "clash", 1) for i, s, lang, n, t in rows], DOCS).repartition(3)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    changed = F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0,
                     merkle.leaf([*COLUMNS[:4], F.translate("text", upper, lower)]))
    made = merkle.digests(merkle.manifest(docs, COLUMNS, changed=changed, **options))
    return sorted((tuple(r) for r in made.collect()), key=str)


def texts(n, seed):
    draw = random.Random(seed)
    return [draw.choice([None, "", "Ab é", "x" * 3_000, "Same", "plain", f"T{i}"]) for i in range(n)]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16, "b": 17}, {None: 3, "": 2, "é": 256, "z": 257}, {str(i): 1 + i % 3 for i in range(40)}])
def test_digests_equal_plain_trees(spark, sizes):
    draw, rows = random.Random(7), []
    for source, n in sizes.items():
        for text in texts(n, n):
            rows.append((draw.choice([None, draw.randint(0, 40)]), source, draw.choice([None, "en"]), draw.choice([None, 5]), text))
    rows += rows[:3]
    assert run(spark, rows) == plain_digests(rows)


def test_groups_beyond_a_block(spark):
    """Blocks of 256 and of 16 nodes: several rounds, last blocks with one node, full and partial ones."""
    rows = [(i, source, None, i, f"T{i % 9}") for source, n in (("a", 257), ("b", 256), ("c", 4_097), ("d", 1)) for i in range(n)]
    random.Random(1).shuffle(rows)
    for height in (1, 2):
        assert run(spark, rows, height=height) == plain_digests(rows)


def test_a_block_boundary_and_many_copies(spark):
    """One source with more than 4,096 leaves, half of them copies of one row."""
    rows = [(i, "hot", "en", 1, f"Text {i}") for i in range(2_100)] + [(7, "hot", "en", 1, "Copy")] * 2_100
    rows += [(1, "long", None, 0, "Ä" * 400_000 + "B")]
    assert run(spark, rows) == plain_digests(rows)


def test_witnesses_fold_to_the_root(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", f"t{i}") for i in range(100)], "doc_id int, source string, text string")
    made = merkle.witnesses(merkle.manifest(docs, ["doc_id", "text"])).collect()
    assert sorted(r.id for r in made) == list(range(100))
    for r in made:
        assert merkle.fold(bytes(r.leaf), [(s.at, bytes(s.others)) for s in r.path]) == bytes(r.root)
        assert merkle.fold(bytes(32), [(s.at, bytes(s.others)) for s in r.path]) != bytes(r.root)


def test_an_empty_table_has_no_rows(spark):
    assert run(spark, []) == []


def test_the_query_detects_what_was_changed(spark):
    made = queries.op12_merkle(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    upper = docs.where("text rlike '[A-Z]' AND crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0")
    assert made.where("NOT verified").count() == upper.count() > 0
    assert made.count() == docs.count()
