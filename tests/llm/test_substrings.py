import random

import numpy as np
import xxhash
from brute import table
from pyspark.sql import functions as F

from salesmart.llm import substrings
from salesmart.llm.queries import QUERIES

GEAR = [int(g) for g in substrings.GEAR]


def slow_chunks(data, reach=substrings.REACH, longest=substrings.LONGEST):
    """The same rule, byte by byte: (first, last, words, normalised text)."""
    plain = bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in data)
    words, at = [], None
    for i, b in enumerate(plain + b" "):
        if b != 32 and at is None:
            at = i
        elif b == 32 and at is not None:
            words.append((at, i))
            at = None
    value = [0]
    for begin, _ in words[1:]:
        h = 0
        for b in plain[max(0, begin - 16) : begin]:
            h = ((h << 2) + GEAR[b]) % 2**32
        value.append(h * 2654435761 % 2**32)
    cuts = [0]
    for k in range(1, len(words)):
        left, right = value[max(1, k - reach) : k], value[k + 1 : k + 1 + reach]
        if all(value[k] > v for v in left) and all(value[k] >= v for v in right):
            cuts.append(k)
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(words)]):
        for c in range(a, b, longest):
            d = min(b, c + longest)
            out.append((words[c][0], words[d - 1][1], d - c, plain[words[c][0] : words[d - 1][1]]))
    return out


def slow_spans(docs, within, least=substrings.LEAST):
    kept, cut = {}, {i: slow_chunks((t or "").encode()) for i, t in docs}
    for i, parts in cut.items():
        for p in parts:
            kept[p[3]] = min(i, kept.get(p[3], i))
    out = []
    for i, parts in cut.items():
        seen, run = set(), []
        for p in [*parts, None]:
            if p and (kept[p[3]] != i or within and p[3] in seen):
                run.append(p)
            else:
                if run and sum(r[2] for r in run) >= least:
                    out.append((i, run[0][0], run[-1][1] - run[0][0], sum(r[2] for r in run), len(run), sorted({kept[r[3]] for r in run})))
                run = []
            if p:
                seen.add(p[3])
    return sorted(out)


def tuples(rows):
    return sorted((r.doc_id, r.start, r.length, r.words, r.chunks, list(r.keep_ids)) for r in rows)


def test_query_against_brute_force(spark, sf):
    docs = table(sf, "documents", "doc_id, text")
    got = QUERIES["op7_substring_dedup"](spark, sf).collect()
    assert tuples(got) == slow_spans(docs, True) and got
    assert all(r.keep_id in r.keep_ids for r in got)
    across = substrings.spans(spark.read.parquet(f"{sf}/documents.parquet"), within=False).collect()
    assert tuples(across) == slow_spans(docs, False) and across


def test_query_within_against_brute_force(spark, sf):
    docs = table(sf, "documents", "doc_id, text")
    got = QUERIES["op7_substring_dedup_within"](spark, sf).collect()
    assert tuples(got) == slow_spans(docs, True)
    assert all(r.own == (r.doc_id in r.keep_ids) for r in got)
    # Passages that are in no other document.
    assert any(list(r.keep_ids) == [r.doc_id] for r in got)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def test_planted_passages_and_clean_documents(spark):
    rng = random.Random(4)
    docs, planted = [], {}
    for p in range(60):
        passage = prose(rng, 51 + p % 10)
        for _ in range(2):
            planted.setdefault(p, []).append(len(docs))
            docs.append((len(docs), prose(rng, rng.randrange(5, 300)) + rng.choice([" ", "\n", "\n\n"]) + passage + " " + prose(rng, rng.randrange(0, 200))))
    clean = [(1000 + i, prose(rng, 400)) for i in range(40)]
    got = substrings.spans(spark.createDataFrame(docs + clean, "doc_id long, text string")).collect()
    pairs = {(r.keep_id, r.doc_id) for r in got}
    assert {tuple(ids) for ids in planted.values()} == pairs


def test_an_insertion_moves_no_other_chunk():
    rng = random.Random(8)
    text = prose(rng, 500)
    a, b = slow_chunks(text.encode()), slow_chunks(("new words here " + text).encode())
    assert len({p[3] for p in a} - {p[3] for p in b}) <= 3


def test_fast_chunks_equal_slow_ones():
    rng = random.Random(9)
    texts = [b"", b" \n", b"one", b"  lead", b"a " * 1000, "é ü\tß\x0b日本 語".encode() * 9, b"x" * 5000, prose(rng, 900).encode(), b"a b\r\nc  d "]
    texts += [prose(rng, n).encode() for n in range(12)]
    for t in texts:
        first, last, words, digest = substrings.chunks(t)
        want = slow_chunks(t)
        assert list(zip(first, last, words)) == [w[:3] for w in want]
        assert list(digest.view(np.uint64)) == [xxhash.xxh3_64_intdigest(w[3]) for w in want]


def test_edge_cases_and_cleaning(spark):
    rng = random.Random(10)
    passage = prose(rng, 80)
    rows = [
        (5, "Start. " + passage + " end", "x", 1), (2, passage, "y", 2), (7, None, "z", 3), (8, "", "z", 4), (9, passage + " " + passage, None, 5),
        (11, "word " * 30000, "long", 6), (12, prose(rng, 20000), "long", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, start int")
    plain = [(r[0], r[1]) for r in rows]
    for within in (True, False):
        assert tuples(substrings.spans(docs, within=within, bits=16).collect()) == slow_spans(plain, within)
    found = substrings.spans(docs, within=False)
    out = {r.doc_id: r for r in substrings.cleaned(docs, found).collect()}
    assert out[2].text == passage and out[7].text is None and out[8].text == "" and out[12].words == "long"
    assert len(out[5].text.split()) < 25 and out[5].text.startswith("Start.") and out[5].text.endswith("end")
    assert substrings.cleaned(docs, found).columns == docs.columns
    # A repeated row is one document; a null id stays behind all others.
    more = docs.unionByName(docs.filter("doc_id = 12")).unionByName(spark.createDataFrame([(None, passage, "n", 0)], docs.schema))
    ids = [r.doc_id for r in substrings.spans(more, within=False).collect()]
    assert sorted(map(str, ids)) == ["5", "9", "None"]
    assert substrings.spans(docs.filter(F.lit(False))).count() == 0
    assert substrings.cut_out(b"keep this drop keep", [(10, 4)]) == b"keep this keep"
