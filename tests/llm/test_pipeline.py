import random

import pytest

import corpus_pipeline as cp
from llm.test_line_dedup import brute as brute_lines
from llm.test_ngram_join import brute as brute_links


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and gave at sf0.001."""
    from conftest import SF001

    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = {}
    for name, stage in cp.STAGES:
        after = cp.materialize(stage(spark, docs, SF001), name)
        out[name] = ({r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in after.collect()}, after.columns)
        docs = after
    return out


def test_columns(stages):
    for name, (_, _, columns) in stages.items():
        assert columns[:5] == list(cp.COLUMNS) and (len(columns) == 5) == (name != "sentencepiece")


def test_quality_keeps_what_labels_call_good(spark, stages):
    from conftest import SF01
    from llm.conftest import load

    before, after, _ = stages["quality_classifier"]
    assert all(after[i] == before[i] for i in after)
    # sf0.001 has too few positives to learn from
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    before = {r["doc_id"] for r in docs.collect()}
    after = {r["doc_id"] for r in cp.quality_filter(spark, docs, SF01).collect()}
    labels = {r["doc_id"]: r["quality"] for r in load(f"{SF01}/labels.parquet")}
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.95 * len(good) and sum(i in after for i in bad) <= 0.2 * len(bad)


def test_lines(stages):
    before, after, _ = stages["line_dedup"]
    want = brute_lines([(i, r["text"]) for i, r in before.items()])
    assert {i: t for i, _, _, t in want} == {i: r["text"] for i, r in after.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())


def test_near_duplicates(stages):
    before, after, _ = stages["ngram_jaccard_join"]
    want = {i for i, c, _, _ in brute_links([(i, r["text"]) for i, r in before.items()]) if i == c}
    assert set(after) == want and all(after[i] == before[i] for i in after)


def test_decontamination(stages):
    from conftest import SF001
    from llm.conftest import load
    from llm.test_decontamination import brute

    items = [(r["item_id"], r["text"]) for r in load(f"{SF001}/benchmark.parquet")]
    before, after, _ = stages["benchmark_decontamination"]
    hit = {i: n for i, _, n, _ in brute([(i, r["text"]) for i, r in before.items()], items)}
    assert any(hit.values())
    for i, r in before.items():
        assert hit[i] or after[i] == r
    assert not any(n for _, _, n, _ in brute([(i, r["text"]) for i, r in after.items() if hit[i]], items))


def test_encoding(stages):
    before, after, _ = stages["sentencepiece"]
    assert set(before) == set(after)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) and r["text"] == before[i]["text"] for i, r in after.items())


def test_ids_are_written_before_they_are_decoded(spark):
    """Else each task of the last stage has two Python workers in a row."""
    from conftest import SF001

    out = cp.encode(spark, spark.read.parquet(f"{SF001}/documents.parquet"), SF001)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_odd_rows(spark, odd_docs, odd_rows, no_docs, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = odd_docs
    for name, stage in cp.STAGES:
        docs = cp.materialize(stage(spark, docs, sf), name)
        assert cp.materialize(stage(spark, no_docs, sf), name).count() == 0
    ids = [r["doc_id"] for r in docs.collect()]
    assert set(ids) <= {i for i, _ in odd_rows}


def test_run(spark):
    from conftest import SF001

    assert cp.run(spark, SF001).count() > 0
