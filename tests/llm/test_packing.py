import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from brute import table
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesmart.llm import packing
from salesmart.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def check_places(rows, length=2048):
    """Sequences are gapless and none is too long; returns their fills."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return [sum(s for _, s in parts) for parts in by.values()]


def test_query(spark, sf):
    rows = QUERIES["op2_best_fit_packing"](spark, sf).collect()
    want = []
    for i, t in table(sf, "documents", "doc_id, text"):
        ids = ids_of(t)
        for p, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((i, p, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    fills = check_places(rows)
    assert len(fills) <= -(-sum(fills) // 2048) + 1


WORDS = [
    "don't", "Ünïcode", "é", "ÉCOLE.", "word,", "Word", "ΣΑΣ", "x2", "...", "a.b", "<|endoftext|>", "<|endoftext|>.", "\x85", "a b",
    "İstanbul", "naïve!?", "éa", "日本語", "it's", "'re", "½", "ﬁn", "\x1cq", "ǅ", "ẞ.", "१२", "🙂", "a" * 300, "​z", "word'", "word***", "Word_", "x's'", "#a", "a'll.", "..", ".,", "a.", "b,", "9.", "end...", "(x).", ",", "“q”.",
]


def test_ids_are_the_tokenizers(monkeypatch):
    """Also with tables and blocks so small that they are full all the time."""
    for name, value in (("WORDS", 12), ("BLOCK", 4)):
        monkeypatch.setattr(packing, name, value)
    rng = random.Random(1)
    encode = packing.Encoder(public_tokenizers.path(packing.VOCABULARY)).encode
    ascii_words = [w for w in WORDS if w.isascii() and "<" not in w]
    for k in range(120):
        texts = ["".join(rng.choice(WORDS if k % 2 else ascii_words) + rng.choice([" ", "\n", "\t ", "\x0b"]) for _ in range(rng.randrange(40))) for _ in range(3)]
        assert [np.frombuffer(e, "<u4").tolist() for e in encode([t.encode() for t in texts])] == [ids_of(t)[:-1] for t in texts]


def test_a_word_is_looked_up_once_a_block(monkeypatch):
    """Words between any ASCII white space, empty texts, and texts that only together exceed a block."""
    encoder, asked = packing.Encoder(public_tokenizers.path(packing.VOCABULARY)), []
    look_up = encoder.look_up
    monkeypatch.setattr(encoder, "look_up", lambda words: asked.append(words) or look_up(words))
    texts = ["one two one", "", " \x0btwo\x0c\rtwo ", "\n", "Two*** one!!! \x1cq \x85é É"]

    def check():
        assert [np.frombuffer(e, "<u4").tolist() for e in encoder.encode([t.encode() for t in texts])] == [ids_of(t)[:-1] for t in texts]

    check()
    assert all(len(words) == len(set(words)) for words in asked) and len(asked) == 1
    monkeypatch.setattr(packing, "BLOCK", 20)
    check()
    assert len(asked) > 2


def test_edge_cases_and_sequences(spark):
    rows = [(1, None, 5), (2, "", 6), (3, "word " * 5000, 7), (4, "tie", 8), (4, "tie", 8), (None, "no id", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, piece int")
    got = packing.pack_documents(docs, keep_ids=True).collect()
    fills = check_places(got)
    assert len(fills) == 3 and sum(fills) == sum(len(ids_of(r[1])) for r in rows)
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in got if r.doc_id == 3) == [(3, 0, 0, 2048), (3, 1, 2048, 2048), (3, 2, 4096, 905)]
    packed = packing.pack_documents(docs, keep_ids=True, length=64)
    out = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert out[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)
    assert packing.pack_documents(docs.filter(F.lit(False))).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_search_empties_bins(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, [2047, 900, 1100, 700, 2000, 300][seed], 400)
    start = [[int(i)] for i in range(len(sizes))]  # the worst start: a bin for each
    search = packing.Search(sizes, start, 2048)
    squares = (search.fill**2).sum()
    place = search.run()
    fill = np.bincount(place, weights=sizes)
    assert fill.max() <= 2048 and (fill**2).sum() >= squares
    best = len(packing.best_fit(sizes, 2048))
    assert np.count_nonzero(fill) <= best * 1.03 + 1


def test_search_beats_best_fit():
    sizes = np.array([6, 5, 5, 4, 4, 4, 2])  # 30 in bins of 10: three suffice, best fit takes four
    bins = packing.best_fit(sizes, 10)
    place = packing.Search(sizes, bins, 10).run()
    assert len(set(place)) <= len(bins)
    swap = packing.Search(np.array([7, 3, 5, 5]), [[0], [1, 2], [3]], 10).run()
    assert len(set(swap)) == 2


def test_control_characters_before_marks():
    """Whatever stands before a comma or full stop, the ids are the tokenizer's."""
    rng = random.Random(6)
    encode = packing.Encoder(public_tokenizers.path(packing.VOCABULARY)).encode
    odd = [chr(c) for c in (*range(32), 127)]
    near = [*odd, *odd, ",", ".", ", ", ". ", ".\n", " ", "a", "Word", "0", "9,", "(", "'", *(w for w in WORDS if len(w) < 8 and "<" not in w)]
    texts = ["\x1c, 0", "\x7f. a", *("".join(rng.choice(near) for _ in range(rng.randrange(1, 9))) for _ in range(100_000))]
    for start in range(0, len(texts), 5000):
        part = texts[start : start + 5000]
        want = TOKENIZER.encode_batch_fast(part, add_special_tokens=False)
        got = encode([t.encode() for t in part])
        for t, w, g in zip(part, want, got, strict=True):
            assert np.frombuffer(g, "<u4").tolist() == w.ids, repr(t)
