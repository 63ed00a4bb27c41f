"""Document fingerprints by consistent weighted sampling, with DataFrame functions only.

A document is its words with their counts as weights.  For each of ``SAMPLES``
samples and each word, a hash of both gives r and c from Gamma(2, 1) and b
uniform in [0, 1); with t = floor(ln w / r + b) the word's rank is
ln c - r (t - b + 1), and the word of least rank is the sample.  The rank is a
function of sample, word and t alone, so two documents have equal least ranks
exactly when they drew the same (word, t).  That happens with a probability
equal to the generalised Jaccard similarity of their weights.  A fingerprint
is 16 bits of a hash of each least rank, and likeness the share of equal ones.

Text is moved once, to partitions of about ``PART`` characters by document (of
more beyond 2^15 partitions, where sums and sorts spill to disk), and all counting and sampling of a document then happens where it is; what a
document lends to its neighbour's edited text moves a second time.

Documents follow each other by falling id, then text hash; after the last
comes the first.  Null text counts as empty; texts without words are alike and
unlike all others.  Rows that share id and text are one document.  A null id
comes last.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import WHITE, col, tasks_for, text_of
from salesmart.workspace import settle

SAMPLES = 32
PART = 4_000_000

#: A document's key, never null, so that joins and groups by it share one partitioning.
KEY = ["doc_key", "text_hash"]


def _uniform(bits: Column, low: int, width: int) -> Column:
    """In (0, 1), from ``width`` bits of a hash."""
    return (F.shiftrightunsigned(bits, low).bitwiseAND(F.lit((1 << width) - 1)) + F.lit(0.5)) * F.lit(2.0**-width)


def _ranks(word: Column, sample: int, *log_weights: Column) -> list[Column]:
    """The rank of a word in a sample under each weight."""
    one, two = F.xxhash64(word, F.lit(2 * sample)), F.xxhash64(word, F.lit(2 * sample + 1))
    r = -F.log(_uniform(one, 0, 32) * _uniform(one, 32, 32))
    log_c = F.log(-F.log(_uniform(two, 0, 22) * _uniform(two, 22, 22)))
    b = _uniform(two, 44, 20)
    return [log_c - r * (F.floor(w / r + b) - b + 1) for w in log_weights]


def _signature(ranks: list[Column]) -> Column:
    """16 bits of each least rank; none (no words) is a value of its own."""
    return F.array(*(F.xxhash64(F.coalesce(r, F.lit(float("-inf")))).bitwiseAND(F.lit(0xFFFF)).cast("int") for r in ranks))


def text(signature: Column) -> Column:
    """A fingerprint as hexadecimal digits, four a sample."""
    return F.array_join(F.transform(signature, lambda v: F.lower(F.lpad(F.hex(v), 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of samples that are equal."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    return same / F.size(a)


def _words(part: Column) -> Column:
    return F.split(part, WHITE)


def signatures(rows: DataFrame, carried: list[str], samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of ``rows`` (``KEY``; words shared by two texts, of the first, of the second as word arrays).

    ``rows`` must be partitioned by ``KEY``.  Gives ``KEY``, the ``carried``
    columns (longs), signature and edited_signature.  Words that are empty
    strings are passed over.
    """
    n = len(carried)
    places = F.array(*(F.lit("") for _ in carried))
    ends = rows.withColumns({"end_both": F.size("both") + n, "end_own": F.size("both") + F.size("own") + n})
    flat = ends.select(*KEY, *carried, "end_both", "end_own", F.posexplode(F.concat(places, "both", "own", "other")).alias("at", "word"))
    flat = flat.filter(f"at < {n} or word != ''")
    # The first places bring what is carried through the sums; edited = -1 tells them from words.
    mark = F.col("at") < n
    value = F.coalesce(*(F.when(F.col("at") == k, F.col(c)) for k, c in enumerate(carried)))
    first = (F.col("at") < F.col("end_own")).cast("bigint")
    second = ((F.col("at") < F.col("end_both")) | (F.col("at") >= F.col("end_own"))).cast("bigint")
    counted = flat.select(
        *KEY, F.when(mark, F.col("at").cast("bigint")).otherwise(F.xxhash64("word")).alias("word"),
        F.when(mark, value).otherwise(first).alias("first"), F.when(mark, F.lit(-1).cast("bigint")).otherwise(second).alias("second"),
    )
    counted = counted.groupBy(*KEY, "word").agg(F.sum("first").alias("first"), F.sum("second").alias("second"))
    is_word = F.col("second") >= 0
    logs = counted.withColumns(
        {
            "log_first": F.when(is_word & (F.col("first") > 0), F.log(F.col("first").cast("double"))),
            "log_second": F.when(F.col("second") > 0, F.log(F.col("second").cast("double"))),
        }
    )
    least = []
    for k in range(samples):
        ranks = _ranks(F.col("word"), k, F.col("log_first"), F.col("log_second"))
        least += [F.min(ranks[0]).alias(f"a{k}"), F.min(ranks[1]).alias(f"b{k}")]
    back = [F.max(F.when(~is_word & (F.col("word") == k), F.col("first"))).alias(c) for k, c in enumerate(carried)]
    summed = logs.groupBy(*KEY).agg(*back, *least)
    return summed.select(
        *KEY, *carried, _signature([F.col(f"a{k}") for k in range(samples)]).alias("signature"),
        _signature([F.col(f"b{k}") for k in range(samples)]).alias("edited_signature"),
    )


def successors(keys: DataFrame) -> DataFrame:
    """Each document (``KEY``, doc_id) with the key that follows by falling id and hash, in a circle; no task holds all."""
    order = [F.desc_nulls_last("doc_id"), F.desc("text_hash")]
    placed = settle(
        keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "ordered"
    ).withColumn("part", F.shiftright("place", 33))
    key = F.struct(*KEY)
    heads = placed.groupBy("part").agg(F.min_by(key, "place").alias("head"))
    row = Window.orderBy("part")  # one row per sort task
    whole = row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select("part", F.coalesce(F.lead("head").over(row), F.first("head").over(whole)).alias("after"))
    inside = F.lead(key).over(Window.partitionBy("part").orderBy("place"))
    found = placed.withColumn("next", inside).join(heads, "part").withColumn("next", F.coalesce("next", "after"))
    return settle(found.drop("place", "part", "after"), "successors")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, samples: int = SAMPLES) -> DataFrame:
    """One row per document.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, and the
    likeness of the fingerprint to the edited text's (near_edited) and to the
    next document's (near_next).  In the edited text the last third gives way
    to the beginning of the next document.
    """
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    zero = F.lit(0).cast(rows.schema["doc_id"].dataType)
    hashed = F.when(F.col("doc_id").isNull(), F.xxhash64("text", F.lit("no id"))).otherwise(F.xxhash64("text"))
    rows = rows.withColumns({"doc_key": F.coalesce("doc_id", zero), "text_hash": hashed})
    order = successors(rows.select("doc_id", *KEY, F.length("text").cast("bigint").alias("n_chars")).distinct())
    total = order.agg(F.sum("n_chars")).first()[0] or 0
    here = rows.drop("doc_id").repartition(tasks_for(total, PART), *KEY).dropDuplicates(KEY)
    third = F.floor(F.col("n_chars") / 3).cast("int")
    asked = order.select(
        *(F.col("next").getField(k).alias(k) for k in KEY), F.col("doc_key").alias("asker_key"), F.col("text_hash").alias("asker_hash"),
        third.alias("third"),
    )
    lent = here.join(asked, KEY).select(
        F.col("asker_key").alias("doc_key"), F.col("asker_hash").alias("text_hash"), "third", F.left("text", F.col("third")).alias("lent")
    )
    joined = here.join(lent, KEY).withColumn("n_chars", F.length("text").cast("bigint"))
    joined = joined.withColumn("start", F.left("text", (F.col("n_chars") - F.col("third")).cast("int")))
    # A word that the cut goes through belongs to what follows on either side.
    tail = F.length(F.regexp_extract(F.reverse("start"), r"^[^\x20\x09-\x0D]*", 0))
    parts = joined.withColumn("tail", tail).select(
        *KEY, "n_chars", F.sha2(F.concat("start", "lent"), 256).alias("sha"),
        _words(F.left("start", F.length("start") - F.col("tail"))).alias("both"),
        _words(F.substr("text", F.length("start") - F.col("tail") + 1)).alias("own"),
        _words(F.concat(F.right("start", F.col("tail")), "lent")).alias("other"),
    )
    quarters = {f"sha{k}": F.conv(F.substring("sha", 16 * k + 1, 16), 16, -10).cast("bigint") for k in range(4)}
    signed = settle(signatures(parts.withColumns(quarters), ["n_chars", *quarters], samples), "signatures")

    following = signed.select(F.struct(*KEY).alias("next"), F.col("signature").alias("next_signature"))
    found = signed.join(order.select("doc_id", *KEY, "next"), KEY).join(following, "next")
    return found.select(
        "doc_id", "n_chars", F.lower(F.concat(*(F.lpad(F.hex(c), 16, "0") for c in quarters))).alias("edited_sha256"),
        text(F.col("signature")).alias("fingerprint"), text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
