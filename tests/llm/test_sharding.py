import random
import zlib

import pytest
from brute import table
from pyspark.sql import functions as F

from salesmart.llm import sharding
from salesmart.llm.queries import QUERIES


def plain_best_fit(sizes, capacity):
    rooms, place = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i]]
        if fits:
            _, place[i] = min(fits)
        else:
            place[i] = len(rooms)
            rooms.append(capacity)
        rooms[place[i]] -= sizes[i]
    return place


@pytest.mark.parametrize("seed", range(5))
def test_tree_packs_like_a_plain_scan(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, rng.randrange(1, 120)]) for _ in range(300)]
    mine, plain = sharding.best_fit_decreasing(sizes, 100), plain_best_fit(sizes, 100)
    # Bins without room leave the tree, and nothing else differs.
    assert mine == plain


def test_fewest_bytes_is_nearly_even():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 1000) for _ in range(2000)]
    place = sharding.fewest_bytes(sizes, 16)
    fill = [sum(s for s, p in zip(sizes, place, strict=True) if p == b) for b in range(16)]
    assert max(place) == 15 and max(fill) <= 1.001 * sum(sizes) / 16


@pytest.mark.parametrize(
    ("shares", "alone"), [([0.07], 1), ([0.1], 1), ([1 / 3], 1), ([0.9], 1), ([0.999], 1), ([0.3, 0.2, 0.05], 3), ([0.0626, 0.0624], 1)]
)
def test_groups_above_an_even_shard_leave_the_others_even(shares, alone):
    rng = random.Random(2)
    small = [rng.randrange(1, 1000) for _ in range(3000)]
    hot = [int(sum(small) * s / (1 - sum(shares))) for s in shares]
    sizes = small + hot
    place = sharding.fewest_bytes(sizes, 16)
    fill = sorted(sum(s for s, p in zip(sizes, place, strict=True) if p == b) for b in range(16))
    even = fill[: 16 - alone]
    assert set(place) == set(range(16)) and even[-1] <= 1.002 * even[0]
    assert fill[16 - alone :] == sorted(hot)[len(hot) - alone :]


def test_few_coarse_groups_use_all_shards():
    for n in range(16, 60):
        place = sharding.fewest_bytes([7] * n, 16)
        fill = [place.count(b) for b in range(16)]
        assert min(fill) >= 1 and max(fill) == -(-n // 16)
    assert sorted(sharding.fewest_bytes([5, 5, 90], 16)) == [0, 1, 2]


def check(rows, texts):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts
    )
    shards, slots = {}, {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shards.values())
    return {b: sum(r.size for r in rows if r.shard == b) for b in slots}


def test_query(spark, sf):
    rows = QUERIES["op4_sharding"](spark, sf).collect()
    texts = table(sf, "documents", "doc_id, text")
    fill = check(rows, texts)
    assert set(fill) == set(range(16)) and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    even = sum(fill.values()) / 16
    assert max(fill.values()) <= 1.02 * max(even, max(len(t.encode()) for _, t in texts))


def test_a_third_of_all_rows_one_text(spark):
    rng = random.Random(6)
    texts = [(i, "copy " * 30 if i % 3 == 0 else f"{i} " + "x" * rng.randrange(250)) for i in range(6000)]
    rows = sharding.shard(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    fill = check(rows, texts)
    hot = fill.pop(next(r.shard for r in rows if r.doc_id == 0))
    assert len(fill) == 15 and hot == 2000 * 151
    assert max(fill.values()) <= 1.01 * min(fill.values())


def test_edge_cases(spark):
    texts = [(1, None), (2, ""), (3, "a" * 5000), (4, "copy"), (4, "copy"), (None, "x")] + [(10 + i, f"text {i}") for i in range(400)]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in texts], "doc_id long, text string, shard int, text_key string")
    rows = sharding.shard(docs.filter("doc_id is not null"), shards=4).collect()
    check(rows, [x for x in texts if x[0] is not None])
    assert sharding.shard(docs).count() == len(texts)
    assert sharding.shard(docs.filter(F.lit(False))).count() == 0
    few = sharding.shard(docs.filter("doc_id >= 10"), capacity=200).collect()
    fill = check(few, [x for x in texts if (x[0] or 0) >= 10])
    assert max(fill.values()) <= 200 and len(fill) <= sum(fill.values()) / 200 * 1.15 + 2
