import random

import pytest
import xxhash
from brute import classes, table
from pyspark.sql import functions as F

from salesmart.llm import simhash
from salesmart.llm.components import components
from salesmart.llm.queries import QUERIES


def slow_print(text, width=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def slow_classes(prints, max_bits=3):
    """prints: list of (id, fingerprint)."""
    values = sorted(set(p for _, p in prints))
    links = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= max_bits]
    root = classes(values, links)
    least = {}
    for i, p in prints:
        least[root[p]] = min(i, least.get(root[p], i))
    return {(i, p): least[root[p]] for i, p in prints}


def test_query_against_brute_force(spark, sf):
    mine = {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in QUERIES["op5_simhash_near_dedup"](spark, sf).collect()}
    prints = [(i, slow_print(t)) for i, t in table(sf, "documents", "doc_id, text")]
    assert mine == slow_classes(prints)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clustered(seed):
    rng = random.Random(seed)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 40])):
            x = centre
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    return sorted(values)


@pytest.mark.parametrize("max_bits,crowd", [(3, 4096), (3, 4), (2, 3), (1, 2), (0, 2), (5, 4096)])
def test_links_connect_what_is_near(spark, max_bits, crowd):
    """Also with lists so crowded that they take the way over points."""
    values = clustered(max_bits * 100 + crowd)
    prints = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    links = [(r.a, r.b) for r in simhash.links(prints, max_bits, crowd).collect()]
    near = [(signed(a), signed(b)) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= max_bits]
    nodes = [signed(v) for v in values]
    assert classes(nodes, links) == classes(nodes, near)


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(60)] + [(1000 + rng.randrange(40), 500) for _ in range(60)] + [(7, 7), (-3, 2000), (2000, -9)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = classes({n for link in links for n in link}, links)
    assert got == {n: r for n, r in want.items() if n != r}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edge_cases(spark):
    texts = [None, "", " \t\n", "One two", "one\x0btwo", "ONE TWO three four", "x " * 30000, "x " * 30001, "Ä b c", "ä b c"]
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(3, "One two", "x", "y"), (None, "lone", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string")
    got = simhash.near_duplicates(docs).collect()
    prints = [(r[0], slow_print(r[1])) for r in rows if r[0] is not None]
    assert {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in got if r.doc_id is not None} == slow_classes(prints)
    assert len(got) == len(rows)
    assert simhash.near_duplicates(docs.filter(F.lit(False))).count() == 0


def test_blocks_do_not_matter():
    data = ("Aa bb\tcc\x0cdd " * 700).encode()
    assert list(simhash.word_blocks(data, 10)) != [data.split()]
    assert sum(simhash.word_blocks(data, 10), []) == data.split()
    assert simhash.fingerprint(data) == signed(slow_print(data.decode()))
