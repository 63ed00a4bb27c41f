import random
import re
from collections import Counter

import pytest
from brute import table
from pyspark.sql import functions as F

from salesmart.llm import mixing
from salesmart.llm.queries import QUERIES


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight, what lies above a cap dealt out again until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return full | share
        full |= {s: most * sizes[s] for s in above}


def check(rows, docs, near, most=3):
    assert sorted((repr(r.doc_id), r.source or "", r.size) for r in rows) == sorted((repr(i), s or "", size(t)) for i, s, t in docs)
    sizes = Counter()
    for _, s, t in docs:
        sizes[s] += size(t)
    want, taken = targets(sizes), Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) <= 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= most * r.size
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= near * t + 2 * mixing.BLOCK, (s, t, taken[s])


def test_query(spark, sf):
    rows = QUERIES["op9_mixing"](spark, sf).collect()
    check(rows, table(sf, "documents", "doc_id, source, text"), 0.05)
    again = QUERIES["op9_mixing"](spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.fixture(scope="module")
def corpus():
    """A hot source, small ones that reach their cap, a null source, empty texts."""
    rng = random.Random(12)
    docs = []
    for s, n in (("hot", 300), ("é", 60), ("small", 3), (None, 30), ("Z", 80), ("nothing", 2)):
        for _ in range(n):
            words = 0 if s == "nothing" else rng.choice([0, 1, 5, 90, 300, 900])
            docs.append((len(docs), s, " ".join(f"d{len(docs)}w{k}" for k in range(words)) or rng.choice(["", None, " \n"])))
    docs.append((len(docs), "hot", " ".join(f"d{len(docs)}w{k}" for k in range(40000))))
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(i, s, t, 1, "x") for i, s, t in docs], "doc_id long, source string, text string, src int, taken string")


def test_targets_and_caps(spark, corpus):
    check(mixing.taken(frame(spark, corpus)).collect(), corpus, 0.05)


def test_mix_returns_what_is_taken(spark, corpus):
    docs = frame(spark, corpus)
    taken = {r.doc_id: r.taken for r in mixing.taken(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got, texts = Counter(), {i: (t or "").split() for i, _, t in corpus}
    for r in mixed.collect():
        words = r.text.split()
        at = texts[r.doc_id].index(words[0])
        assert texts[r.doc_id][at : at + len(words)] == words and r.taken == "x"
        got[r.doc_id] += len(words)
    assert {i: n for i, n in taken.items() if n} == dict(got)


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 7, 100, 257):
        x = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("bigint"), F.lit(1), F.lit(2)).alias("y"))
        assert sorted(r.y for r in x.collect()) == list(range(n))
    moved = spark.range(1000).select(mixing._permuted(F.col("id"), F.lit(1000).cast("bigint"), F.lit(1)).alias("y")).collect()
    assert sum(abs(r.y - i) for i, r in enumerate(moved)) / 1000 > 250


def test_shards_follow_the_weights(spark, corpus):
    docs = frame(spark, corpus)
    sources = mixing.targets(mixing._sized(docs, "doc_id", "source", "text"))
    slots = mixing.slots(spark, sources, shard=64).collect()
    shares = {r.src: r.expected for r in sources.collect()}
    by_shard = Counter(r.out_shard for r in slots)
    assert len(by_shard) > 5
    counts = Counter((r.out_shard, r.src) for r in slots)
    for (_, src), n in counts.items():
        expected = shares[src] / len(by_shard)
        assert abs(n - expected) < 8
    assert len({counts[k, 0] for k in by_shard}) > 1  # random, not just rounded
    assert len({(r.src, r["pass"], r.block) for r in slots}) == len(slots)


def test_edge_cases(spark, corpus):
    none = frame(spark, corpus).filter(F.lit(False))
    assert mixing.taken(none).count() == 0 and mixing.mix(none).count() == 0
    blank = frame(spark, [(1, "a", None), (2, None, ""), (3, "a", " ")])
    assert {r.taken for r in mixing.taken(blank).collect()} == {0} and mixing.mix(blank).count() == 0
    # Rows that share id, source and text are one document; a null id is an id.
    twice = [(1, "a", "one two three"), (1, "a", "one two three"), (None, "a", "four five"), (1, "b", "six")]
    rows = mixing.taken(frame(spark, twice)).collect()
    check(rows, [twice[0], *twice[2:]], 1)
    assert sorted(r.text for r in mixing.mix(frame(spark, twice)).distinct().collect()) <= sorted({"one two three", "four five", "six"})
