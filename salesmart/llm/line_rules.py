"""Quality rules: document statistics, and lines that too many documents of a host share.

One pass over the whole texts takes the statistics of each document and a
128-bit digest of each of its lines, normalised: A-Z in lower case, each digit
as 0, words joined by one space.  Documents with equal text on one host are one
document from here on.  A line is counted once per document and host; it is
removed from a host if more than ``MIN_DOCS`` documents of the host have it and
these are more than ``MAX_SHARE`` of its documents.  A document fails the base
rules if it has fewer than ``MIN_WORDS`` words or if words in repeated windows
of three are more than ``MAX_REPEATS`` of them; it is depleted if the removed
lines hold more than ``MAX_REMOVED`` of its words.  What neither fails nor is
depleted is kept.

Counts are sums that meet on the map side, so a line, copy or host that holds a
third of all rows sends a row per task.  A bitmap of fixed size tells, where the
documents lie, which lines may be removed; only these are matched exactly, with
written tables that Spark splits where a key is hot.  Texts move only in
``clean``, and only those that lose a line.

Null text counts as empty: no words, so it fails.  A null host is a host of its
own.  Very long texts are read whole, some megabytes of words at a time.  Ties
do not matter: limits are strict.  Repeated rows each get a row and count as
one document.  An empty table gives an empty result.  Other columns, whatever
their names, are ignored by ``judge`` and kept by ``clean``.
"""

from __future__ import annotations

from collections import Counter
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import bitmap_of, col, on_worker, text_of, with_flag, word_blocks
from salesmart.workspace import settle

#: Base rules.
MIN_WORDS = 50
MAX_REPEATS = 50  # per cent of the words
#: A line goes when it is in more documents of a host than both limits allow.
MIN_DOCS = 10
MAX_SHARE = 1  # per cent of the host's documents
#: How much of a document removed lines may hold.
MAX_REMOVED = 50  # per cent of the words
#: Size of the bitmap of removed lines, as a power of two (1 MB).
BITS = 23

WINDOW = 3
SYMBOLS = [c.encode() for c in "#*$%&|<>"]
SPACES = [bytes([c]) for c in (32, 9, 10, 11, 12, 13)]
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


# ---- one document --------------------------------------------------------------------------


def repeated(numbers: np.ndarray) -> int:
    """How many words lie in a window of three that comes twice or more."""
    n = len(numbers) - WINDOW + 1
    if n < 2:
        return 0
    window, kinds = numbers[:n].astype(np.int64), int(numbers.max()) + 1
    for k in range(1, WINDOW):
        # Windows are numbered anew at each step, so that products stay small.
        window = np.unique(window * kinds + numbers[k : n + k], return_inverse=True)[1]
    often = np.bincount(window)[window] > 1
    covered = np.zeros(len(numbers), bool)
    for k in range(WINDOW):
        covered[k : n + k] |= often
    return int(covered.sum())


def statistics(data: bytes) -> tuple[int, ...]:
    """The base statistics of a text, in the order of ``STATISTICS``."""
    known: dict[bytes, int] = {}
    numbers = [np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)) for words in word_blocks(data)]
    numbers = np.concatenate(numbers) if numbers else np.empty(0, np.int32)
    # A code point has one byte that does not continue another.
    continuing = 0 if data.isascii() else int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80))
    chars = len(data) - continuing - sum(map(data.count, SPACES))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(numbers), chars, sum(map(data.count, SYMBOLS)), len(lines) - len(set(lines)), repeated(numbers)


def line_key(line: bytes) -> bytes:
    """Digest of a normalised line; empty for a line without words."""
    words = line.translate(LOWER).split()
    return blake2b(b" ".join(words), digest_size=16).digest() if words else b""


def line_words(data: bytes) -> Counter:
    """Digests of the lines of a text, and how many words lines of each digest hold."""
    found = Counter()
    for line in data.split(b"\n"):
        key = line_key(line)
        if key:
            found[key] += len(line.split())
    return found


def outline_batches(batches):
    """id, host, key of the text, text -> id, host, key, statistics, lines with their words."""
    kind = pa.list_(pa.struct([("line", pa.binary()), ("words", pa.int64())]))
    for batch in batches:
        texts = batch.column(3).cast(pa.binary())
        # Some texts at a time, as a batch of long ones has many lines.
        for first in range(0, len(texts), 256):
            part = [t.as_py() for t in texts.slice(first, 256)]
            numbers = np.array([statistics(t) for t in part], np.int64).reshape(-1, len(STATISTICS))
            lines = [[{"line": k, "words": n} for k, n in line_words(t).items()] for t in part]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(first, 256) for k in range(3)), *(pa.array(numbers[:, k]) for k in range(len(STATISTICS))),
                 pa.array(lines, kind)],
                ["doc_id", "host_key", "text_key", *STATISTICS, "lines"],
            )


def cut_batches(batches):
    """Rows of (text, lines to go, anything else): the text without these lines."""
    for batch in batches:
        cut = []
        for text, gone in zip(batch.column(0).cast(pa.binary()), batch.column(1), strict=True):
            gone = set(gone.as_py())
            cut.append(b"\n".join(line for line in text.as_py().split(b"\n") if line_key(line) not in gone).decode())
        yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string()), *batch.columns[1:]], batch.schema.names)


# ---- all documents -------------------------------------------------------------------------


def host_key(host_col: str) -> Column:
    """The host; a null host meets itself in joins, and not an empty one."""
    host = col(host_col).cast("string")
    return F.when(host.isNull(), "").otherwise(F.concat(F.lit("h"), host))


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def outlines(docs: DataFrame, id_col: Column, text_col: str, host_col: str) -> DataFrame:
    """One written row per row of ``docs``: id, host, key of the text, statistics and lines."""
    text = text_of(text_col)
    rows = docs.select(id_col.alias("doc_id"), host_key(host_col).alias("host_key"), text_key(text).alias("text_key"), text.alias("text"))
    numbers = ", ".join(f"{n} long" for n in STATISTICS)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, host_key string, text_key binary, {numbers}, lines array<struct<line: binary, words: long>>"
    return settle(rows.mapInArrow(on_worker(outline_batches), schema), "outlines")


def frequent_lines(texts: DataFrame, min_docs: int = MIN_DOCS, max_share: int = MAX_SHARE) -> DataFrame:
    """host_key, line of all lines above the limits; ``texts`` has each text of a host once."""
    sizes = texts.groupBy("host_key").agg(F.count(F.lit(1)).alias("n_docs"))
    counted = texts.select("host_key", F.explode("lines.line").alias("line")).groupBy("host_key", "line").agg(F.count(F.lit(1)).alias("n"))
    above = counted.filter(F.col("n") > min_docs).join(sizes, "host_key").filter(F.col("n") * 100 > F.col("n_docs") * max_share)
    return settle(above.select("host_key", "line"), "frequent")


def removed(rows: DataFrame, min_docs: int, max_share: int, bits: int) -> DataFrame:
    """host_key, text_key, gone (lines that go), n_removed (words in them) of each text that loses a line."""
    texts = settle(
        rows.select("host_key", "text_key", "lines").groupBy("host_key", "text_key").agg(F.first("lines").alias("lines")), "texts"
    )
    frequent = frequent_lines(texts, min_docs, max_share)
    key = F.struct("host_key", "line").alias("key")
    bitmap = settle(bitmap_of(frequent.select(key), "key", bits), "bitmap")
    lines = texts.select("host_key", "text_key", F.explode("lines").alias("l")).select("host_key", "text_key", "l.line", "l.words")
    suspects = with_flag(lines.withColumn("key", key), bitmap, "key", bits, "suspect").filter("suspect").drop("key", "suspect")
    met = settle(suspects, "suspects").join(frequent, ["host_key", "line"])
    return settle(
        met.groupBy("host_key", "text_key").agg(F.collect_list("line").alias("gone"), F.sum("words").alias("n_removed")), "removed"
    )


def with_removed(rows: DataFrame, gone: DataFrame) -> DataFrame:
    told = rows.drop("lines").join(gone, ["host_key", "text_key"], "left")
    return told.withColumn("n_removed", F.coalesce("n_removed", F.lit(0).cast("bigint")))


def verdicts(rows: DataFrame, min_words: int, max_repeats: int, max_removed: int) -> DataFrame:
    n = F.col("n_words")
    failed = (n < min_words) | (F.col("n_repeat_words") * 100 > n * max_repeats)
    depleted = F.col("n_removed") * 100 > n * max_removed
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", *, min_docs: int = MIN_DOCS,
    max_share: int = MAX_SHARE, max_removed: int = MAX_REMOVED, min_words: int = MIN_WORDS, max_repeats: int = MAX_REPEATS, bits: int = BITS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the statistics, n_removed (words in removed lines), base_failed, kept."""
    rows = outlines(docs, col(id_col), text_col, host_col)
    told = with_removed(rows, removed(rows, min_docs, max_share, bits).drop("gone"))
    return verdicts(told, min_words, max_repeats, max_removed).select("doc_id", *STATISTICS, "n_removed", "base_failed", "kept")


def clean(
    docs: DataFrame, text_col: str = "text", host_col: str = "source", *, min_docs: int = MIN_DOCS, max_share: int = MAX_SHARE,
    max_removed: int = MAX_REMOVED, min_words: int = MIN_WORDS, max_repeats: int = MAX_REPEATS, bits: int = BITS,
) -> DataFrame:
    """The documents that are kept, with all their columns, their texts without the removed lines."""
    rows = outlines(docs, F.lit(0), text_col, host_col).drop("doc_id")
    told = with_removed(rows, removed(rows, min_docs, max_share, bits))
    # Texts that are kept as they are need no row here.
    changed = settle(
        verdicts(told, min_words, max_repeats, max_removed).filter(~F.col("kept") | (F.col("n_removed") > 0))
        .groupBy("host_key", "text_key").agg(F.first("kept").alias("kept"), F.first("gone").alias("gone")),
        "changed",
    )
    key = F.struct("host_key", "text_key").alias("key")
    bitmap = settle(bitmap_of(changed.select(key), "key", bits), "bitmap")
    whole = docs.select(F.struct(*map(col, docs.columns)).alias("row"), host_key(host_col).alias("host_key"), text_key(text_of(text_col)).alias("text_key"))
    flagged = with_flag(whole.withColumn("key", key), bitmap, "key", bits, "suspect").drop("key")
    met = flagged.filter("suspect").join(changed, ["host_key", "text_key"], "left").filter(F.coalesce("kept", F.lit(True)))
    same = flagged.filter("not suspect").select("row").unionByName(met.filter("gone is null").select("row"))
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit("")).alias("text")
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("gone", T.ArrayType(T.BinaryType())), met.schema["row"]])
    cut = met.filter("gone is not null").select(text, "gone", "row").mapInArrow(on_worker(cut_batches), schema)
    columns = [F.col("text").alias(text_col) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    return same.select("row.*").unionByName(cut.select(*columns))
