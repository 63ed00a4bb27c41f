import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import toxicity
from salesmart.llm.queries import QUERIES

BAD = ["scum", "idiot", "moron", "trash", "pathetic"]


def prose(rng, n, bad=0, function_words=("the", "of", "and")):
    words = [rng.choice(function_words) if rng.random() < 0.2 else "".join(rng.choice(["th", "er", "on", "ing", "ea"]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    for _ in range(bad):
        words[rng.randrange(n)] = rng.choice(BAD).title() + rng.choice(["", ".", ","])
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return [(prose(rng, rng.randrange(20, 200), bad=2 * (k % 3 == 0)), int(k % 3 == 0)) for k in range(500)]


@pytest.fixture(scope="module")
def model(texts):
    y = np.array([label for _, label in texts])
    fitted = toxicity.fit([t for t, _ in texts[:350]], y[:350], steps=250)
    return toxicity.calibrate(fitted, [t for t, _ in texts[350:]], y[350:])


def slow_margin(model, text):
    """The network word by word."""
    vectors = []
    for w in text.split():
        places = [p % toxicity.SLOTS for p in toxicity.pieces(w)[:4]]
        vectors.append(model.embeddings[places].mean(axis=0))
    n = max(1, len(vectors))
    vectors += [np.zeros(toxicity.DIM, np.float32)] * (n + 2 - len(vectors))
    best, at = [], 0
    for width in toxicity.WIDTHS:
        f = [model.filters[:, at + k * toxicity.FILTERS : at + (k + 1) * toxicity.FILTERS] for k in range(width)]
        at += width * toxicity.FILTERS
        best.append(np.max([sum(vectors[i + k] @ f[k] for k in range(width)) for i in range(n)], axis=0))
    return float(np.maximum(np.concatenate(best) + model.bias, 0) @ model.weights + model.offset)


def test_fast_network_equals_slow_one(model, texts, monkeypatch):
    monkeypatch.setattr(toxicity, "KEPT", 40)
    for block in (1 << 16, 7):
        scorer = toxicity.Scorer(model, block)
        for t in ["", " ", "one", "the scum", *(t for t, _ in texts[:25])]:
            assert abs(scorer.margin(t)[0] - slow_margin(model, t)) < 1e-3


def test_held_out_accuracy(model):
    rng = random.Random(77)
    scorer = toxicity.Scorer(model)
    fresh = [(prose(rng, 100, bad=2 * (k % 2)), k % 2) for k in range(200)]
    assert np.mean([(scorer.score(t) >= 0.5) == y for t, y in fresh]) > 0.95
    long = prose(rng, 20000)
    assert scorer.score(long) < 0.5 <= scorer.score(long + " scum and idiot, moron trash")


def test_border():
    assert toxicity.border(np.array([0.0, 1, 2, 3]), np.array([0, 0, 1, 1])) == 1.5
    assert toxicity.border(np.array([0.0, 1, 5, 9]), np.array([0, 1, 0, 1])) == 7.0


def test_languages_have_their_own_thresholds(model):
    scorer = toxicity.Scorer(model)
    spoken = [scorer.margin(t)[1] for t in ("the of and", "der die und", "le et les", "el y los", "zz yy", "")]
    assert [toxicity.LANGUAGES[s] for s in spoken] == ["en", "de", "fr", "es", "other", "other"]


def test_query(spark, sf):
    rows = QUERIES["op3_toxicity"](spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_pipeline_of_labels_and_edge_cases(spark, texts):
    rows = [(i, t, "en", 0.5) for i, (t, _) in enumerate(texts)] + [(900, None, None, None), (901, "", "x", 0.0), (901, "", "x", 0.0), (None, "scum idiot moron", "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    marks = [(i, y) for i, (_, y) in enumerate(texts)] + [(900, None), (None, 1), (901, 7), (5000, 1), (3, 0), (3, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    truth = {i: y for i, (_, y) in enumerate(texts)}
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.9
    kept = toxicity.keep(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.predicted == 0)
    none = docs.filter(F.lit(False))
    assert toxicity.score(none, model).count() == 0 and toxicity.train(none, labels) is None
    assert {r.score for r in toxicity.score(docs, toxicity.train(docs, labels.filter("toxic = 0"))).collect()} == {0.0}


def test_thresholds_do_not_change_with_the_sample(spark):
    rng = random.Random(3)
    # Of 400 texts with the mild word a quarter is toxic, but of the sample's (as many of each label) most are.
    kinds = [("mild", 0)] * 300 + [("mild", 1)] * 100 + [("", 0)] * 900 + [("scum", 1)] * 30
    rng.shuffle(kinds)
    rows = [(i, f"{prose(rng, 30)} {word} {prose(rng, 10)}", y) for i, (word, y) in enumerate(kinds)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    for sample in (80, 4000):
        scorer = toxicity.Scorer(toxicity.train(docs, labels, sample=sample))
        rejected = [scorer.score(text) >= 0.5 for _, text, _ in rows if " mild " in text]
        assert np.mean(rejected) < 0.25


def test_all_learnable_rows_calibrate(spark, texts, model, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_CHARS", 500)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels: seen.extend(texts) or model)
    monkeypatch.setattr(toxicity, "calibrate_on_all", lambda model, counts, fitted: (counts, fitted))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)], "doc_id int, toxic int")
    counts, fitted = toxicity.train(docs, labels, sample=50)
    learnable = [(t, y) for i, (t, y) in enumerate(texts) if zlib.crc32(str(i).encode()) % 5]
    assert len(fitted) == len(seen) and max(map(len, seen)) <= 500 and 0 < len(seen) < 100
    for y in (0, 1):
        own = counts[counts["label"] == y]
        assert own["count"].sum() + np.sum(fitted == y) == sum(label == y for _, label in learnable)
        assert own[own["long"]]["count"].sum() == sum(label == y and len(t) > 500 for t, label in learnable) > 0


def test_border_of_ranges_and_weights():
    low, high, y = np.array([0.0, 0.5, 2.0, 3.0]), np.array([1.0, 0.7, 2.5, 3.0]), np.array([0, 1, 0, 1])
    assert toxicity.border(low, y, np.array([5.0, 1, 3, 2]), high) == 2.75
    assert toxicity.border(low, y, np.array([1.0, 3, 1, 2]), high) == -0.5


def test_labels_of_held_out_rows_are_not_learnt(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = [(i, y) for i, (_, y) in enumerate(texts)]
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    a, b = (toxicity.train(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert np.array_equal(a.embeddings, b.embeddings) and np.array_equal(a.thresholds, b.thresholds)
