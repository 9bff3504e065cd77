"""The pipeline stage by stage, each against a plain version on its own input."""

import pytest
from test_decontamination import brute_force
from test_dedup_and_join import plain_join
from test_packing import check_places, plain_best_fit

import corpus_pipeline
from deskline.llm.common import table_of
from deskline.llm.queries import table, toxicity_model
from deskline.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs, found = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out = table_of(stage(spark, docs, SF), name)
        found.append((name, docs, out))
        docs = out
    return {name: (before, after) for name, before, after in found}


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_columns(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(results)
    for name, (before, after) in list(results.items())[:-1]:
        assert after.columns == before.columns
        assert set(after.collect()) <= set(before.collect())


def test_toxicity(spark, results):
    before, after = results["toxicity"]
    model = toxicity_model(before, table(spark, SF, "labels"))
    clean = {r.id for r in toxicity(before, model).collect() if not r.predicted}
    assert {i for i, _ in texts(after)} == clean and len(clean) < before.count()


def test_exact_dedup(results):
    before, after = map(texts, results["exact_dedup"])
    first = {}
    for i, t in sorted(before):
        first.setdefault(t, i)
    assert sorted(after) == sorted((i, t) for t, i in first.items())


def test_near_copies(results):
    before, after = map(texts, results["ngram_jaccard"])
    assert sorted(i for i, _ in after) == sorted(i for i, (_, c) in plain_join(before, 5, 80).items() if i == c)


def test_decontamination(spark, results):
    before, after = map(texts, results["decontamination"])
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    leaks = {i for i, _ in brute_force(before, items)}
    assert leaks and sorted(i for i, _ in after) == sorted(i for i, _ in before if i not in leaks)


def test_packing(results):
    before, after = results["best_fit_packing"]
    rows = after.collect()
    assert {r.doc_id for r in rows} == {i for i, _ in texts(before)}
    assert check_places(rows, 2048) <= plain_best_fit([r.length for r in rows], 2048)


def test_run(spark, results):
    rows = corpus_pipeline.run(spark, SF).collect()
    wanted = results["best_fit_packing"][1].collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in wanted)


ODD = [
    (1, None, "en", None, 0),
    (2, "", None, "s", 0),
    (2, "", None, "s", 0),
    (None, "no id here", "en", "s", None),
    (3, "long text " * 50_000, "en", "s", 1),
]


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "empty"])
def test_stages_bear_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumnRenamed("n_chars", "kept")
    for name, stage in corpus_pipeline.STAGES:
        out = table_of(stage(spark, docs, SF), name)
        if name == "best_fit_packing":
            assert (out.count() > 0) == bool(rows)
        else:
            assert out.columns == docs.columns
            docs = out
    assert docs.count() == (3 if rows else 0)
