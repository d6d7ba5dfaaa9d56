"""One table of edge rows through the operators on documents and the stages."""

import collections

import pytest

import corpus_pipeline
from lakesync.llm import fingerprints, language_id, packing, quality, queries, secrets_scan, spelling
from lakesync.llm import near_dedup
from tests.conftest import SF_CHECK

BIG = 9007199254740993  # not a double
PROSE = "the house and the garden of the old town are near the river "
# columns named as internal or result columns
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, _text string, spans string, "
          "lang_pred string, clean string, row long, file string, node long, uid long, label string")
TEXTS = [(BIG, PROSE * 3), (None, PROSE * 3 + "x"), (4, None), (5, ""), (6, " \n\t "), (7, "!?"), (8, PROSE), (8, PROSE), (8, "another text"),
         (None, None), (9, PROSE * 4000), (10, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + PROSE)]


def edge_rows(spark, texts=TEXTS):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 0.5, "a", "b", "c", "d", 1, "f", 2, 3, str(k)) for k, (i, t) in enumerate(texts)], SCHEMA)


def ids(df):
    return collections.Counter(r["doc_id"] for r in df.collect())


OPERATORS = {
    "language": lambda d: language_id.identify(d, language_id.fit(d)),
    "secrets": lambda d: secrets_scan.scan(d),
    "near": lambda d: near_dedup.near_duplicates(d),
    "fingerprints": lambda d: fingerprints.fingerprint_documents(d),
    "quality": lambda d: quality.classify(d, d.select("doc_id").selectExpr("doc_id", "1 as quality")),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, name):
    docs = edge_rows(spark)
    assert ids(OPERATORS[name](docs)) == collections.Counter(i for i, _ in TEXTS)
    assert OPERATORS[name](edge_rows(spark, [])).count() == 0


def test_pieces_of_edge_rows(spark):
    rows = packing.pack_documents(edge_rows(spark), queries.tokenizer_path()).collect()
    assert collections.Counter(r["doc_id"] for r in rows if r["piece"] == 0) == collections.Counter(i for i, _ in TEXTS)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack_documents(edge_rows(spark, []), queries.tokenizer_path()).count() == 0


def test_words_of_edge_rows(spark):
    assert spelling.spelling_variants(edge_rows(spark)).count() > 0
    assert spelling.spelling_variants(edge_rows(spark, [])).count() == 0


STAGE_ROWS = {  # rows kept, by their place in TEXTS
    "language_id": {0, 1, 6, 7, 8, 10, 11},
    "secret_scan": set(range(len(TEXTS))),
}


@pytest.mark.parametrize("name", ["language_id", "near_dedup", "decontamination", "secret_scan"])
def test_stages_keep_rows_and_columns(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = edge_rows(spark)
    out = stage(spark, docs, SF_CHECK)
    assert out.columns == docs.columns
    rows = {int(r["label"]): r for r in out.collect()}
    assert set(rows) <= set(range(len(TEXTS)))
    if name in STAGE_ROWS:
        assert set(rows) == STAGE_ROWS[name]
    if name == "near_dedup":  # the texts of many PROSE (one set), and the copies of doc 8, keep one each; empty ones all stay
        assert len(rows) == len(TEXTS) - 3 and {2, 3, 4, 9, 10} <= set(rows) and not {0, 1} & set(rows)
    for k, r in rows.items():
        text = TEXTS[k][1]
        assert r["doc_id"] == TEXTS[k][0] and (r["score"], r["clean"], r["row"], r["file"], r["node"]) == (0.5, "d", 1, "f", 2)
        assert r["text"] == text or (name == "secret_scan" and secrets_scan.REDACTED in r["text"])
    assert stage(spark, edge_rows(spark, []), SF_CHECK).count() == 0


def test_packing_stage(spark):
    stage = dict(corpus_pipeline.STAGES)["best_fit_packing"]
    assert ids(stage(spark, edge_rows(spark), SF_CHECK).where("piece = 0")) == collections.Counter(i for i, _ in TEXTS)


def test_decontamination_judges_rows_not_ids(spark):
    bench = spark.read.parquet(f"{SF_CHECK}/benchmark.parquet")
    item = max((r["text"] for r in bench.collect()), key=len)
    docs = edge_rows(spark, [(1, "before " + item), (1, PROSE), (None, item + " after"), (None, PROSE), (2, None), (3, "")])
    out = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, SF_CHECK)
    assert out.columns == docs.columns and sorted(r["label"] for r in out.collect()) == ["1", "3", "4", "5"]
