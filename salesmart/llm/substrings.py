"""Substring dedup: content-defined chunks by a gear rolling hash, deduplicated by digest.

The gear hash of the last 16 bytes is taken where a word begins.  A chunk ends
where it is largest among the ``REACH`` word beginnings on either side, so a
boundary depends on nothing but the text around it: an insertion shifts no
other chunk.  A chunk has more than ``REACH`` words and about twice as many;
where no boundary shows up (a repeated word) it is cut every ``LONGEST`` words.

A digest's text stays in the document with the smallest id; elsewhere (with
``within``, also later in the same document) its chunks are repeats.  Runs of
repeated chunks of at least ``LEAST`` words are reported as one span.  Runs
lose up to a chunk at either end, so ``LEAST`` lies below the passages of over
50 words that are to be caught, and far above what texts share by chance.

Digests that occur twice go into a bitmap of fixed size, and only rows that it
lets through are moved to be matched.  The digest has 64 bits: a chance match
is one chunk, which is no span.

Null text counts as empty, white space is one kind of space, a run without it
is one word.  Rows that share an id count as one document.  A null id stays
behind all others.  An empty table gives an empty result.  Other columns are
ignored by ``spans`` and kept by ``cleaned``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import bitmap_of, col, on_worker, text_of, with_flag
from salesmart.workspace import settle

REACH = 3
LONGEST = 64
LEAST = 20
BITS = 26

#: The gear: a random number for each byte value.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 1) for b in range(256)], np.uint32)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: Each kind of white space as a space.
PLAIN = np.where(SPACES, 32, np.arange(256)).astype(np.uint8)


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: h = (h << 2) + GEAR[byte], which forgets a byte after 16."""
    h = GEAR[data]
    for k in (1, 2, 4, 8):
        h[k:] = h[k:] + (h[:-k] << np.uint32(2 * k))
    return h


def chunks(data: bytes, reach: int = REACH, longest: int = LONGEST) -> tuple[np.ndarray, ...]:
    """Of each chunk: first byte, byte after the last, number of words, digest."""
    raw = PLAIN[np.frombuffer(data, np.uint8)]
    space = SPACES[raw]
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    begins, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(begins)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, none, none
    value = rolling(raw)[begins[1:] - 1] * np.uint32(2654435761)
    peak = np.ones(n - 1, bool)
    for k in range(1, min(reach, n - 2) + 1):
        peak[k:] &= value[k:] > value[:-k]
        peak[:-k] &= value[:-k] >= value[k:]
    cuts = np.concatenate([[0], np.flatnonzero(peak) + 1, [n]])
    if (np.diff(cuts) > longest).any():
        cuts = np.concatenate([*(np.arange(a, b, longest) for a, b in zip(cuts[:-1], cuts[1:], strict=True)), [n]])
    first, last = begins[cuts[:-1]], ends[cuts[1:] - 1]
    plain = raw.tobytes()
    digest = np.fromiter((xxhash.xxh3_64_intdigest(plain[a:b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)), np.uint64, len(first))
    return first, last, np.diff(cuts), digest.view(np.int64)


def chunk_batches(batches, reach, longest):
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for low in range(0, len(texts), 256):
            rows, parts, again = [], [], []
            for k in range(low, min(low + 256, len(texts))):
                part = chunks(texts[k].as_py(), reach, longest)
                parts.append(part)
                rows.append(len(part[0]))
                repeat = np.ones(len(part[3]), bool)
                repeat[np.unique(part[3], return_index=True)[1]] = False
                again.append(repeat)
            source = pa.array(np.repeat(np.arange(low, low + len(rows)), rows))
            first, last, words, digest = (np.concatenate([p[c] for p in parts]) for c in range(4))
            number = np.concatenate([np.arange(r) for r in rows])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(source), batch.column(1).take(source), pa.array(number, pa.int32()), pa.array(first, pa.int64()),
                    pa.array(last, pa.int64()), pa.array(words, pa.int32()), pa.array(digest, pa.int64()), pa.array(np.concatenate(again)),
                ],
                ["row", "doc_id", "number", "first", "last", "words", "digest", "again"],
            )


def spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, within: bool = True, least: int = LEAST, reach: int = REACH,
    longest: int = LONGEST, bits: int = BITS,
) -> DataFrame:
    """One row per repeated span: doc_id, start and length (bytes), words, chunks, keep_id (where most of it stays), keep_ids (all).

    ``within`` adds own: does the document itself keep a part of the span?
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"row long, doc_id {kind}, number int, first long, last long, words int, digest long, again boolean"
    cut = settle(rows.mapInArrow(on_worker(chunk_batches, reach=reach, longest=longest), schema), "chunks")
    shared = settle(
        cut.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "shared"
    )
    bitmap = settle(bitmap_of(shared.select("digest"), "digest", bits), "bitmap")
    met = with_flag(cut, bitmap, "digest", bits, "suspect").filter("suspect").drop("suspect").join(shared, "digest")
    elsewhere = ~F.col("doc_id").eqNullSafe(F.col("keep_id"))
    repeats = met.filter(elsewhere | F.col("again") if within else elsewhere)
    own = [F.max(~elsewhere).alias("own")] if within else []
    island = F.col("number") - F.row_number().over(Window.partitionBy("row").orderBy("number"))
    return (
        repeats.withColumn("island", island).groupBy("row", "island")
        .agg(
            F.first("doc_id").alias("doc_id"), F.min("first").alias("start"), (F.max("last") - F.min("first")).alias("length"),
            F.sum("words").alias("words"), F.count(F.lit(1)).alias("chunks"), F.mode("keep_id").alias("keep_id"),
            F.array_sort(F.collect_set("keep_id")).alias("keep_ids"), *own,
        )
        .filter(F.col("words") >= least).drop("row", "island")
    )


def cut_out(data: bytes, found: list[tuple[int, int]]) -> bytes:
    """The text without the spans (first byte, length); what is left and right of one stays apart by one space."""
    out, at = [], 0
    for start, length in sorted(found):
        out.append(data[at:start].rstrip() if at < start else b"")
        at = max(at, start + length)
    out.append(data[at:])
    return b" ".join(p.strip() if k else p for k, p in enumerate(out) if p.strip() or not k).strip()


def clean_batches(batches, text):
    for batch in batches:
        texts, found = batch.column(text).cast(pa.binary()).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()
        new = [t if t is None or not f else cut_out(t, [(s["start"], s["length"]) for s in f]) for t, f in zip(texts, found, strict=True)]
        columns = list(batch.columns[:-1])
        columns[text] = pa.array(new, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])


def cleaned(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the spans that ``spans`` found; ids must be unique."""
    by_doc = settle(
        found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length")).alias("found")).withColumnRenamed("doc_id", "found_in"), "found"
    )
    joined = docs.select(F.struct(*map(col, docs.columns)).alias("row"), col(id_col).alias("found_in")).join(by_doc, "found_in", "left")
    names = [f"c{k}" for k in range(len(docs.columns))]
    flat = joined.select(*(F.col("row").getField(c).alias(n) for c, n in zip(docs.columns, names, strict=True)), "found")
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(docs.columns, names, strict=True))
    return flat.mapInArrow(on_worker(clean_batches, text=docs.columns.index(text_col)), schema).toDF(*docs.columns)
