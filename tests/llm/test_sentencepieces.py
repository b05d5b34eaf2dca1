"""SentencePiece encoding and decoding against the library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from meritrix.llm import queries, sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def agenda():
    with open(MODEL, "rb") as file:
        return sentencepieces.Agenda(sentencepieces.read_model(file.read()))


def texts():
    draw = random.Random(3)
    bits = ["a", "e", "the", " ", "  ", "\n", "\t", "▁", "é", "日", "😀", "́", ".", "\x00", "�", "ing", " the",
            "<s>", "<0x41>", "<unk>", "XX", "1", ",", "e.g.", '"', "'s", ").", "&&", "²", "”", "(", "…", "-", "_"]
    made = ["".join(draw.choice(bits) for _ in range(draw.randint(0, 40))) for _ in range(1500)]
    made += ["".join(chr(draw.choice([draw.randint(0, 0xD7FF), draw.randint(0xE000, 0x10FFFF)])) for _ in range(9))
             for _ in range(500)]
    return [*made, "", " ", "\n", "a", "▁", None, "same", "same", "x" * 70_000, "ab " * 30_000, " " * 5_000, "é\n" * 20_000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_rows_equal_the_library(spark, library):
    given = texts()
    rows = [(i if i % 7 else None, "clash", t) for i, t in enumerate(given)]
    docs = spark.createDataFrame(rows, "doc_id bigint, ids string, text string").repartition(3)
    made = sentencepieces.round_trip_digests(docs, MODEL, check=True).collect()
    want = []
    for doc_id, _, text in rows:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.agrees) for r in made]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_any_ids_decode_as_the_library_does(agenda, library):
    draw = random.Random(5)
    kinds = [lambda: draw.randint(0, 31_999), lambda: draw.randint(3, 258), lambda: draw.choice([0, 1, 2, 259, 261, 28705])]
    for _ in range(5_000):
        ids = [draw.choice(kinds)() for _ in range(draw.randint(0, 12))]
        assert agenda.decode(list(map(str, ids))) == library.decode(ids), ids


def test_parts_never_change_the_ids(agenda):
    """The agenda over a whole text gives what it gives part by part."""
    for text in texts()[:1200]:
        whole = "▁" + (text or "").replace(" ", "▁")
        assert agenda.merge(whole) == [i for part in agenda.parts(whole) for i in agenda.merge(part)]


def test_a_piece_across_words_switches_the_parts_off(agenda):
    pieces = [("<unk>", 0.0, sentencepieces.UNKNOWN), *((f"<0x{b:02X}>", 0.0, sentencepieces.BYTE) for b in range(256)),
              ("a", 0.0, 1), ("b", 0.0, 1), ("▁", 0.0, 1), ("a▁", -1.0, 1), ("a▁b", -2.0, 1)]
    other = sentencepieces.Agenda(pieces)
    assert other.parts("▁a▁b") == ["▁a▁b"]
    assert [pieces[i][0] for i in other.merge("▁a▁b")] == ["▁", "a▁b"]


def test_the_check_finds_a_wrong_part(agenda, library):
    parts = sentencepieces._Parts(agenda, library)

    def encoded(texts):
        return [",".join(map(parts.__getitem__, agenda.parts("▁" + t.replace(" ", "▁")))) for t in texts]

    first = ["one two\nthree", "  four\n "]
    assert parts.agree(first, encoded(first)) == [True, True] and parts.trusted
    parts.clear()
    parts["▁two"] = "5"  # as if the agenda had gone wrong
    parts.fresh.append("▁two")
    texts = ["one two", "one", "three"]
    assert parts.agree(texts, encoded(texts)) == [False, True, True] and not parts.trusted
    assert parts.agree(["two"], encoded(["two"])) == [False]


def test_other_models_are_refused():
    with open(MODEL, "rb") as file:
        model = file.read()
    unigram = model.replace(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01")
    assert unigram != model
    with pytest.raises(ValueError, match="does not know"):
        sentencepieces.read_model(unigram)


def test_an_empty_table_gives_an_empty_result(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert sentencepieces.round_trip_digests(docs, MODEL).collect() == []


def test_the_query_agrees_everywhere(spark):
    made = queries.op13_sentencepiece(spark, "/root/testdata/sf0.001")
    assert set(made.columns) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"}
    assert made.where("NOT agrees").count() == 0 and made.count() > 0
