import hashlib
import math
import random
import re
from collections import Counter

from brute import table
from pyspark.sql import functions as F

from salesmart.llm import common, fingerprints
from salesmart.llm.queries import QUERIES


def words(text):
    return Counter(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def jaccard(a, b):
    a, b = words(a), words(b)
    return sum((a & b).values()) / max(1, sum((a | b).values())) if a or b else 1.0


def edited(docs):
    """(id, text, edited text, next text) by falling id."""
    docs = sorted(((i, t or "") for i, t in docs), reverse=True)
    return [(i, t, t[: len(t) - len(t) // 3] + docs[(k + 1) % len(docs)][1][: len(t) // 3], docs[(k + 1) % len(docs)][1]) for k, (i, t) in enumerate(docs)]


def check(rows, docs, bound):
    want = edited(docs)
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(got) == len(want)
    off, by_text = [], {}
    for i, t, e, n in want:
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        by_text.setdefault(t, set()).add(r.fingerprint)
        by_text.setdefault(e, set()).add(r.edited_fingerprint)
        off += [r.near_edited - jaccard(t, e), r.near_next - jaccard(t, n)]
        halves = [[f[k : k + 4] for k in range(0, len(f), 4)] for f in (r.fingerprint, r.edited_fingerprint)]
        assert r.near_edited == sum(a == b for a, b in zip(*halves)) / len(halves[0])
    assert all(len(f) == 1 for f in by_text.values())
    return sum(off) / len(off), math.sqrt(sum(x * x for x in off) / len(off))


def test_query(spark, sf):
    rows = QUERIES["op8_document_fingerprints"](spark, sf).collect()
    mean, spread = check(rows, table(sf, "documents", "doc_id, text"), 0.1)
    assert abs(mean) < 0.02 and spread < 0.5 / math.sqrt(fingerprints.SAMPLES)


def test_collisions_follow_weighted_jaccard(spark):
    """Documents over few words with many weights: the mean error must vanish."""
    rng = random.Random(6)
    docs = [(i, " ".join(w for w in "abcdef" for _ in range(rng.choice([0, 1, 2, 5, 9])))) for i in range(300)]
    rows = fingerprints.fingerprint(spark.createDataFrame(docs, "doc_id long, text string"), samples=24).collect()
    got = {r.doc_id: r for r in rows}
    off = [got[i].near_next - jaccard(t, n) for i, t, _, n in edited(docs)]
    assert abs(sum(off) / len(off)) < 0.03


def test_edge_cases(spark):
    rows = [(1, None, 9), (2, "", 9), (3, "a", 9), (4, "ab", 9), (5, "äöü ñ", 9), (6, " \n ", 9), (7, "word " * 20000, 9), (8, "x" * 50000, 9), (9, "same text here", 9), (10, "same text here", 9), (0, "tail\tof\x0ball", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = fingerprints.fingerprint(docs).collect()
    check(got, [r[:2] for r in rows], 1)
    # Repeated rows are one document, and a null id comes last.
    more = docs.unionByName(docs.filter("doc_id in (1, 9)")).unionByName(spark.createDataFrame([(None, "the last one", 1)], docs.schema))
    ids = sorted(str(r.doc_id) for r in fingerprints.fingerprint(more).collect())
    assert ids == sorted([*(str(r[0]) for r in rows), "None"])
    assert fingerprints.fingerprint(docs.filter(F.lit(False))).count() == 0
    one = fingerprints.fingerprint(docs.filter("doc_id = 9")).first()
    assert one.near_next == 1.0


def test_tasks_are_bounded_and_few_tasks_give_the_same(spark, monkeypatch):
    assert common.tasks_for(0, fingerprints.PART) == 1
    assert common.tasks_for(30_000_000_000, fingerprints.PART) == 7501
    assert common.tasks_for(10**14, fingerprints.PART) == common.TASKS
    random.seed(4)
    rows = [(n, " ".join(random.choices("abcdefgh", k=random.randrange(40)))) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(fingerprints, "PART", 100)
    many = sorted(map(tuple, fingerprints.fingerprint(docs, samples=4).collect()))
    monkeypatch.setattr(common, "TASKS", 2)
    assert sorted(map(tuple, fingerprints.fingerprint(docs, samples=4).collect())) == many and len(many) == 60
