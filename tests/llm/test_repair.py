"""Repair of conversations against plain search and forward dynamic programming."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from meritrix.llm import queries, repair

ROWS = "conv_id bigint, turn bigint, role string, text string, codes string, n int"
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if role is None else role), (" " if text is None else text)
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(turns):
    seen, found = set(), []
    for _, role, text in turns:
        tail = text.rstrip(" \t\n\x0b\x0c\r")
        found.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def cheapest(turns, found):
    """Forward: the least (cost, audit) for each prefix and the initials' state."""
    def state_of(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def insert(best):
        for _ in range(3):
            for state, (cost, audit) in list(best.items()):
                for initial in "ua":
                    to = state_of(state, initial)
                    if to is not None:
                        best[to] = min(best.get(to, (10**9, "")), (cost + 5, audit + "I"))
        return best

    best = insert({"": (0, "")})
    for (_, role, _), fault in zip(turns, found):
        after = {}
        for state, (cost, audit) in best.items():
            options = [("D", state, 2)]
            if fault not in ("blank", "duplicate"):
                late = 5 if fault else 0
                options += [("K", state_of(state, role[:1]), late)]
                options += [("R", state_of(state, initial), 1 + late) for initial in "ua"]
            for letter, to, price in options:
                if to is not None:
                    after[to] = min(after.get(to, (10**9, "")), (cost + price, audit + letter))
        best = insert(after)
    return min(best[s] for s in ("", "a") if s in best)


def replay(turns, audit):
    out, state, i = [], "", 0
    for letter in audit:
        turn = None if letter == "I" else turns[i]
        i += letter != "I"
        if letter == "D":
            continue
        fitting = "assistant" if state == "u" else "user"
        role = turn[1] if letter == "K" else fitting
        out.append((letter, role, "" if letter == "I" else turn[2]))
        state = role[0]
    return out


def plain(rows, convs):
    """rows (conv, turn, role, text) after damage -> one result row per conversation"""
    by_conv = {c: [] for c in convs}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, role, text))
    out = []
    for conv, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).digest()))
        found = faults(turns)
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit = cheapest(turns, found)
        made = replay(turns, audit)
        assert LEGAL.fullmatch("".join(role[0] for _, role, _ in made))
        text = "\n".join(f"{role}:{text}" for _, role, text in made)
        out.append((conv, gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, convs=None, **options):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROWS).repartition(4)
    known = spark.createDataFrame([(c,) for c in (convs if convs is not None else {r[0] for r in rows})], "conv_id bigint")
    return sorted((tuple(r) for r in repair.digests(frame, known, **options).collect()), key=str)


def sample(n, seed, roles, texts, conv=1, spread=1):
    draw = random.Random(seed)
    return [(conv, t * draw.randint(1, spread), draw.choice(roles), draw.choice(texts) or f"text {t}.") for t in range(n)]


ROLES = ["user", "assistant", "assistant", "system", "tool", " ", "", "users"]
TEXTS = [None, None, None, "same.", "cut", " \t\x0b", "", "end! \n", "é?", "."]


def test_short_conversations_equal_plain_search(spark):
    rows = [r for c in range(150) for r in sample(c % 9, c, ROLES, TEXTS, conv=c, spread=3)]
    rows += [(None, None, "user", "a."), (None, 3, "user", "a."), (None, None, "user", "a."), (500, None, "user", "x" * 200_000 + ".")]
    convs = set(range(151)) | {None, 500}
    assert run(spark, rows, convs) == plain(rows, convs)


def test_exhaustive_search_agrees_with_the_recursion():
    """All edit sequences with up to four inserts, over all short code sequences."""
    viterbi, letters_of = repair.Viterbi(), {0: "D", 1: "D"}
    for codes in itertools.product([0, 2, 3, 4, 6, 8], repeat=3):
        best = None
        for edits in itertools.product(*[letters_of.get(c, "DKR") for c in codes]):
            for gaps in itertools.product(range(3), repeat=4):
                if sum(gaps) > 4:
                    continue
                audit = "".join("I" * g + e for g, e in zip(gaps, edits)) + "I" * gaps[3]
                state, cost, i = repair.START, 0, 0
                for letter in audit:
                    code = codes[i] if letter != "I" and i < len(codes) else 0
                    i += letter != "I"
                    cost += {"D": 2, "K": 0, "R": 1, "I": 5}[letter] + (5 if letter in "KR" and code & 1 else 0)
                    if letter == "K":
                        state = repair.KEPT[(code - repair.OPEN) // 2][state]
                    elif letter != "D":
                        state = repair.NEXT[state]
                    if state is None:
                        break
                if state in (repair.START, repair.PAIR):
                    best = min(best or (10**9, ""), (cost, audit))
        assert tuple(reversed(viterbi.solve(bytes(codes)))) == best


@pytest.mark.parametrize("roles", [["user"], ["assistant"], ["tool"], ["user", "assistant"], ROLES])
def test_one_long_conversation_in_many_chunks(spark, roles):
    """Rows of one role never converge by themselves: the fix-up spans have to grow."""
    texts = [None] if len(roles) < 3 else TEXTS
    rows = sample(1_500, len(roles), roles, texts) + sample(3, 9, ROLES, TEXTS, conv=2)
    assert run(spark, rows, chunk=7) == plain(rows, {1, 2})


def test_copies_of_one_row_and_equal_turns(spark):
    rows = [(1, 5, "user", "same.")] * 900 + [(1, 5, "assistant", "b.")] * 40 + [(1, None, "user", "")] * 300
    rows += [(1, 5, "user", f"t{i}.") for i in range(50)] + [(2, t, "user", "same.") for t in range(400)]
    for chunk in (16, repair.CHUNK):
        assert run(spark, rows, chunk=chunk) == plain(rows, {1, 2})


def test_repaired_turns_are_whole(spark):
    rows = [r for c in range(40) for r in sample(c, c, ROLES, TEXTS, conv=c)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROWS)
    got = {}
    for r in sorted(repair.repaired(frame, chunk=6).collect(), key=lambda r: (r.conv_id, r.place)):
        got.setdefault(r.conv_id, []).append((r.edit, r.role, r.text))
    for conv in range(1, 40):
        turns = sorted(((t, r, x) for c, t, r, x in rows if c == conv),
                       key=lambda t: (t[0], t[1].encode(), hashlib.sha256(t[2].encode()).digest()))
        assert got.get(conv, []) == replay(turns, cheapest(turns, faults(turns))[1])


def test_damage_is_the_stated_one(spark):
    rows = [(c, t, r, x) for c in range(60) for t, r, x in [(0, "system", "s!"), (1, "user", None), (2, None, "a? b."), (None, "user", "x.")]]
    rows += [(None, None, "user", "u."), (None, 4, None, None)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], ROWS)
    assert sorted(map(tuple, repair.damage(frame).collect()), key=str) == sorted(plain_damage(rows), key=str)


def test_empty_tables(spark):
    assert run(spark, []) == []
    assert run(spark, [], {7, None}) == plain([], {7, None})


def test_the_query_equals_plain_search(spark):
    made = queries.op11_repair(spark, "/root/testdata/sf0.001").collect()
    given = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert sorted((tuple(r) for r in made), key=str) == plain(plain_damage(map(tuple, given)), {r.conv_id for r in given})
