"""Chat windows and sharding against plain Python."""

import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import xxhash

from meritrix.llm import chat, queries, sharding

TURNS = "conv_id bigint, turn bigint, role string, text string, formatted string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_digests(rows):
    """conv_id to (n_turns, turns_sha256, loss_chars, loss_sha256)."""
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def sample():
    draw = random.Random(2)
    pieces = ["<|im_end|>", "<|im_start|>", "<\\|x", "<\\\\|", "\\", "<", "|", "\n", "$1", "é", "😀", "word ", "<|im_end|>\n"]
    text = lambda: "".join(draw.choice(pieces) for _ in range(draw.randint(0, 40)))
    rows = []
    for conv in range(60):
        for turn in range(draw.randint(1, 30)):
            role = "system" if turn == 0 and draw.random() < 0.5 else draw.choice(["user", "assistant", "assistant"])
            rows.append((conv, turn, role, draw.choice([text(), text(), None, ""])))
    rows += [(100, t, "assistant" if t % 2 else "user", "long " * 900) for t in range(12)]
    rows += [(101, t * 1000 - 5000, "assistant", f"t{t}") for t in range(200)]
    rows += [(102, None, "assistant", "b"), (102, None, "assistant", "a"), (102, 1, "tool\nx|<%é", "c"), (102, 1, None, "d")]
    rows += [(103, 1, "assistant", "same")] * 3 + [(None, 1, "assistant", "n"), (None, 0, "user", "u")]
    draw.shuffle(rows)
    return rows


def test_chat_reads_back_what_went_in(spark):
    rows = sample()
    frame = spark.createDataFrame([(*r, "clash") for r in rows], TURNS).repartition(5)
    for budget, history in ((chat.BUDGET, chat.HISTORY), (60, 25), (1, 0)):
        made = chat.windows(frame, budget=budget, history=history)
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.read_back(made)).collect()}
        assert got == plain_digests(rows), budget


def test_windows_keep_the_system_turn_and_their_budget(spark):
    rows = [(1, 0, "system", "rules", "")] + [(1, t, "assistant" if t % 2 else "user", f"turn {t} " * 5, "") for t in range(1, 80)]
    made = chat.windows(spark.createDataFrame(rows, TURNS), budget=100, history=40).orderBy("window").collect()
    assert len(made) > 5
    cost = lambda piece: math.ceil(len(piece.encode()) / 4)
    for at, w in enumerate(made):
        pieces = [p + chat.END for p in w.formatted.split(chat.END)[:-1]]
        assert pieces[0].startswith("<|im_start|>system\nrules")
        history = pieces[1:w.n_repeated] if at else []
        assert sum(map(cost, history)) <= 40 and (not at or history)
        assert sum(map(cost, pieces[w.n_repeated:-1])) <= 100
        assert all("assistant\n" in w.formatted[s.start - 10:s.start] for s in w.loss_spans)
        targets = "".join(w.formatted[s.start:s.end] for s in w.loss_spans)
        assert targets == "".join(p[len("<|im_start|>assistant\n"):-len(chat.END)] for p in pieces[w.n_repeated:] if "assistant" in p)


def test_escape_is_reversible(spark):
    draw = random.Random(9)
    texts = ["".join(draw.choice("<|\\ax") for _ in range(draw.randint(0, 12))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape("t")).withColumn("b", chat.unescape("e"))
    for row in frame.collect():
        assert row.b == row.t and "<|" not in row.e


def test_chat_of_empty_tables(spark):
    assert chat.digests(chat.read_back(chat.windows(spark.createDataFrame([], TURNS)))).count() == 0


def test_chat_query_uses_no_python(spark):
    plan = queries.QUERIES["op6_chat"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    plan += queries.QUERIES["op7_sharding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def plain_shard(key, n, weights=None):
    """The hash of a bigint and an int is xxHash64 of each, chained by the seed."""
    first = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
    draws = []
    for shard in range(n):
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), first)
        draws.append((-math.log(((h >> 11) + 0.5) * 2.0 ** -53) / (weights[shard] if weights else 1.0), shard))
    return min(draws)[1]


def test_shards_equal_plain_rendezvous(spark):
    rows = [(i * 7919, "é" * (i % 9), 1) for i in range(3000)] + [(5, None, 1)] * 40 + [(None, "x", 1), (None, "y", 2)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, shard int").repartition(6)
    got = sharding.assign(frame, [1.0] * 16, grown=[1.0] * 17).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert (r.shard, r.grown_shard) == (plain_shard(r.doc_id, 16), plain_shard(r.doc_id, 17))
        assert r.grown_shard in (r.shard, 16) and r.law == "key"
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    sizes = {(r.doc_id, r.size, r.text_crc32) for r in got}
    assert sizes == {(k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t, _ in rows}
    moved = sum(r.grown_shard == 16 for r in got) / len(got)
    assert 0.03 < moved < 0.1


def test_weights_draw_rows_in_proportion(spark):
    frame = spark.range(8000).selectExpr("id AS doc_id", "'x' AS text")
    got = Counter(r.shard for r in sharding.assign(frame, [1.0, 2.0, 5.0]).collect())
    assert abs(got[0] / 8000 - 1 / 8) < 0.02 and abs(got[2] / 8000 - 5 / 8) < 0.03
    assert {r.shard for r in sharding.assign(frame.limit(5), [3.0]).collect()} == {0}
    assert sharding.assign(frame.where("false"), [1.0, 1.0]).count() == 0
