"""The pipeline, stage by stage, against brute force."""

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from meritrix.llm import bpe, pii
from tests.llm.test_ngram_join import plain
from tests.llm.test_text_operators import plain_hits

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))


def rows_of(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_every_stage_over_a_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == [
        "language identification", "n-gram Jaccard join", "benchmark decontamination", "personal data", "byte-level BPE"]

    kept = stages["language identification"](spark, docs, SF).cache()
    assert kept.columns == docs.columns
    assert {i: r.text for i, r in rows_of(kept).items()}.items() <= {i: r.text for i, r in rows_of(docs).items()}.items()
    assert kept.count() >= 0.99 * docs.count()

    single = stages["n-gram Jaccard join"](spark, kept, SF).cache()
    groups, _, _ = plain([(r.doc_id, r.text) for r in kept.collect()], pipeline.NGRAM, pipeline.PERCENT)
    assert single.columns == docs.columns and set(rows_of(single)) == {g for _, g in groups.values()}
    assert single.count() < kept.count()

    clean = stages["benchmark decontamination"](spark, single, SF).cache()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = plain_hits([(r.doc_id, r.text) for r in single.collect()], items)
    assert clean.columns == docs.columns and set(rows_of(clean)) == {i for i, h in hits.items() if not h[4]}

    masked = stages["personal data"](spark, clean, SF).cache()
    finder, changed = pii.Finder(), 0
    before = rows_of(clean)
    for doc_id, row in rows_of(masked).items():
        text = before[doc_id].text
        assert row.text == pii.masked(text, finder.spans(text)) and row.n_chars == len(row.text)
        changed += row.text != text
    assert masked.columns == docs.columns and masked.count() == clean.count() and changed

    final = rows_of(stages["byte-level BPE"](spark, masked, SF))
    assert {i: r.ids for i, r in final.items()} == {i: library.encode_ordinary(r.text) for i, r in rows_of(masked).items()}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in final.values())


def test_run_equals_its_stages(spark):
    got = rows_of(pipeline.run(spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert got == rows_of(docs) and got


ENGLISH = "the old house near the river was quiet while the rain fell on the roof and nobody of the family came home before the night"
GERMAN = "das alte haus am fluss war still und der regen fiel auf das dach als niemand von der familie vor der nacht nach hause kam"


def test_odd_rows_in_every_stage(spark, tmp_path, library):
    rows = [(i, f"{ENGLISH} number {i} {' '.join(f'only{i}word{k}' for k in range(30))}", "en", "s", 1) for i in range(1, 30)]
    rows += [(100 + i, f"{GERMAN} nummer {i} {' '.join(f'nur{i}wort{k}' for k in range(30))}", "de", "s", 1) for i in range(1, 30)]
    rows += [(200, None, "en", "s", 0), (201, "", None, None, 0), (202, "12 34 !", "en", "s", 1)]  # no language
    rows += [(300, rows[0][1], None, None, None), (1, rows[0][1], "en", "s", 1)]  # copies of 1
    rows += [(301, rows[1][1] + " end", "en", "s", 1), (None, rows[2][1], None, "s", 1)]  # near 2; a copy of 3
    question = "which of these nine short words never appears in training data at all"
    rows += [(400, f"{rows[3][1].replace('only4', 'Q4')} Which of THESE nine, short words never appears in training data at all!", "en", "s", 1)]
    rows += [(401, f"{rows[4][1].replace('only5', 'Q5')} mail me.you@site.example.org or +49 30 1234567.", "en", "s", 1)]
    frame = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], f"{SCHEMA}, class string, score double").repartition(3)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, question), (2, None), (None, "")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [*range(1, 30), *range(101, 130), 401]
    by_id = {r.doc_id: library.decode(r.ids) for r in got}
    assert by_id[401].endswith("mail <EMAIL> or <PHONE>.") and by_id[1] == rows[0][1]
    assert all(r.round_trip for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0, name


def test_texts_of_a_language_that_no_label_teaches_go(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").where("length(text) >= 40")
    foreign, stage = "lang = 'es'", dict(pipeline.STAGES)["language identification"]
    untaught = docs.selectExpr("doc_id", "text", f"CASE WHEN NOT ({foreign}) THEN lang END AS lang", "source", "n_chars")
    kept = {r.doc_id for r in stage(spark, untaught, SF).collect()}
    own, other = ({r.doc_id for r in docs.where(c).collect()} for c in (f"NOT ({foreign})", foreign))
    assert len(other) > 90 and len(kept & other) <= 0.02 * len(other)
    assert len(kept & own) >= 0.99 * len(own)


def test_short_clean_texts_stay_and_short_foreign_ones_go(spark):
    learned = [(i, t, lang, "s", 1) for i, (t, lang) in enumerate([(ENGLISH, "en"), (GERMAN, "de")] * 20)]
    short = {100: "the rain", 101: "der regen fiel", 102: "house", 103: "the old house was quiet before the night"}
    foreign = {200: "la pluie tombait sur le toit", 201: "Дождь шёл всю ночь", 202: "nadie volvió a casa antes de la noche " * 50}
    rows = learned + [(i, t, None, "s", 1) for i, t in {**short, **foreign}.items()]
    kept = rows_of(dict(pipeline.STAGES)["language identification"](spark, spark.createDataFrame(rows, SCHEMA), SF))
    assert set(kept) == {r[0] for r in learned} | set(short)
    assert {i: kept[i].lang for i in short} == {100: "en", 101: "de", 102: "en", 103: "en"}
