import hashlib
import re

import oracle_check
import pytest
from pyspark.sql import functions as F

from salesmart.llm import exact_dedup
from salesmart.llm.queries import ORACLE, QUERIES

ROWS = [
    (1, "a b", "x"), (2, "a\t\n b", "y"), (3, "a b ", "z"), (0, "a\x0bb", "w"), (4, None, "n"), (5, "", "e"), (6, " ", "e"), (7, "\r\n", "e"),
    (8, "tail " * 30000 + "x", None), (9, "tail " * 30000 + "y", None), (10, "tail  " * 30000 + "x", None), (11, "a b", None), (None, "no id", "q"),
    (None, "lone", "q"), (12, "no id", "q"), (13, "a b", "q"), (13, "a b", "q"),
]


def frame(spark):
    return spark.createDataFrame([(i, t, s, 1, True) for i, t, s in ROWS], "doc_id long, text string, source string, n_bytes int, kept boolean")


def groups():
    by = {}
    for i, t, _ in ROWS:
        by.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    return by


@pytest.mark.parametrize("hash_all,bits,prefix", [(True, 23, 64), (False, 23, 3), (True, 1, 64), (False, 2, 1)])
def test_mark_against_brute_force(spark, hash_all, bits, prefix):
    """With a bitmap of two places nearly every row survives the refinement; results stay the same."""
    got = exact_dedup.mark(frame(spark), hash_all=hash_all, bits=bits, prefix=prefix).collect()
    want = []
    for text, ids in groups().items():
        least = min(ids, key=lambda i: (i is not None, i or 0))
        first = True
        for i in sorted(ids, key=lambda i: (i is not None, i or 0)):
            want.append((i, least, len(ids), first))
            first = False
    key = str
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=key) == sorted(want, key=key)
    hashes = {hashlib.sha256(t.encode()).hexdigest() for t in groups()}
    assert {r.text_sha256 for r in got} - {None} <= hashes
    assert not hash_all or {r.text_sha256 for r in got} == hashes


def test_distinct_keeps_whole_rows(spark):
    got = exact_dedup.distinct(frame(spark))
    assert got.columns == frame(spark).columns
    rows = got.collect()
    assert len(rows) == len(groups())
    whole = {(i, t, s, 1, True) for i, t, s in ROWS}
    assert all(tuple(r) in whole for r in rows)
    assert {r.doc_id for r in rows} == {min(ids, key=lambda i: (i is not None, i or 0)) for ids in groups().values()}


def test_empty(spark):
    none = frame(spark).filter(F.lit(False))
    assert exact_dedup.mark(none).count() == 0 and exact_dedup.distinct(none).count() == 0


def test_query_against_sql(spark, sf):
    assert oracle_check.compare(QUERIES["op1_exact_dedup"](spark, sf), oracle_check.duck(sf), ORACLE["op1_exact_dedup"]) is None
