import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_packing import check_places, ids_of
from test_simhash import slow_classes, slow_print

from salesmart.llm import toxicity
from salesmart.llm.common import table, without


def test_stages(spark, sf, tmp_path):
    """Each stage against a plain version, on what its predecessor kept."""
    docs = table(spark, sf, "documents")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"{number}")
        stage(spark, docs, sf).write.parquet(path)
        before, docs = {tuple(r) for r in docs.collect()}, spark.read.parquet(path)
        after = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
        texts = {r[0]: r[1] for r in before}
        if name == "toxicity":
            scores = toxicity.score(table(spark, sf, "documents"), toxicity.train(table(spark, sf, "documents"), table(spark, sf, "labels")))
            assert {r.doc_id for r in after} == {r.doc_id for r in scores.filter("predicted = 0").collect()}
            assert {tuple(r) for r in after} <= before and len(after) > 0.8 * len(before)
        elif name == "exact_dedup":
            least = {}
            for i, t in texts.items():
                least.setdefault(_squeeze(t), set()).add(i)
            assert {r.doc_id for r in after} == {min(ids) for ids in least.values()}
            assert {tuple(r) for r in after} <= before
        elif name == "simhash_near_dedup":
            classes = slow_classes([(i, slow_print(t)) for i, t in texts.items()])
            assert {r.doc_id for r in after} == set(classes.values()) and {tuple(r) for r in after} <= before
        elif name == "mixing":
            for r in after:
                assert r.n_chars == len(r.text) and (r.text == texts[r.doc_id] or " ".join(texts[r.doc_id].split()).find(r.text) >= 0)
        else:
            check_places(after)
            assert sum(r.length for r in after) == sum(len(ids_of(r[1])) for r in previous)
        previous = after


def _squeeze(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text)


def test_run_is_registered(spark, sf):
    from salesmart.llm.queries import ORACLE, QUERIES

    assert "pipeline" in QUERIES and corpus_pipeline.ORACLE_SQL is None and "pipeline" not in ORACLE
    assert QUERIES["pipeline"](spark, sf).columns[:2] == ["doc_id", "piece"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[1:]])
def test_stages_take_odd_rows(spark, sf, stage):
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, "x y", "en", None, 3), (2, "x y", "en", None, 3), (3, "long " * 30000, "en", "a", 1)]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, kept boolean")
    assert stage(spark, docs, sf).count() > 0
    assert stage(spark, docs.filter(F.lit(False)), sf).count() == 0


def test_without(spark):
    rows = spark.range(500).withColumn("gone_id", F.lit("x")).unionByName(spark.sql("SELECT cast(null AS bigint) AS id, 'y' AS gone_id"))
    gone = spark.range(0, 500, 3)
    for bits in (1, 23):
        kept = {r.id for r in without(rows, gone, "id", bits).collect()}
        assert kept == {None, *(i for i in range(500) if i % 3)}
