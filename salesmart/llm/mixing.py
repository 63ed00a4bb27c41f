"""Mixing sources to target weights, with DataFrame functions only.

* Each source's documents, in a fixed random order, form one stream of words,
  cut into blocks of ``BLOCK`` words.
* Targets share the sum of all sizes by weight; a target stops at ``MOST``
  times its source's size and the rest share what is left over.
* The mix is a number of output shards.  In each, a source gets the whole part
  of its expected number of blocks, and a multinomial draw with the
  probabilities of the left fractions deals the remaining slots.  The mix
  therefore is random per shard and near its targets in total.
* The j-th slot of a source takes, in pass j div n over its n blocks, the block
  that a pseudorandom permutation of that pass maps j mod n to (a
  "swap or not" network, a bijection for every n).  A pass takes no block
  twice, and slots beyond ``MOST`` passes are dropped.
* Slots meet blocks by index, and blocks their documents.

All draws are hashes of a seed and an index: reruns and lost tasks give the
same mix.  Only numbers move in ``taken``; ``mix`` moves each text once.  Word
offsets come from totals of hash buckets, so no task holds a whole source.
Tables of sources have a row per source and are joined by what Spark measures.

Null text counts as empty, an empty text is never taken, a null source is a
source of its own and comes last.  Rows that share id, source and text are one
document.  Empty tables give empty results.  Other columns are ignored by
``taken`` and kept by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import WORD, col, running, spread_for, tasks_for, text_of
from salesmart.workspace import settle

BLOCK = 64
SHARD = 1024
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3
SEED = 11
ROUNDS = 16

#: Cells of the unit interval, to find the source of a draw by an equality join.
CELLS = 1024
#: Slots that one row of a plan, and about one task, grows into.
CHUNK = 1 << 16

KEY = ["doc_id", "src", "text_hash"]


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def _sized(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return settle(
        docs.select(
            col(id_col).alias("doc_id"), col(source_col).cast("string").alias("source"), words(text).alias("size"),
            F.xxhash64(text).alias("text_hash"),
        ).distinct(),
        "sizes",
    )


def targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST, block: int = BLOCK) -> DataFrame:
    """One row per source: src (its number), source, source_size, blocks, target, expected (slots in the mix)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    named = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = named.withColumn("src", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("src") % len(weights) + 1).cast("int")).cast("double")
    named = named.withColumns({"weight": weight, "cap": F.col("source_size") * F.lit(float(most))})
    # Water filling: by rising cap per weight, the first source that stays under its cap sets the level.
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "src")
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole)
    capped = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    named = named.withColumn("level", (total - capped) / left)
    level = F.max(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.col("level"))).over(whole)
    blocks = F.ceil(F.col("source_size") / block)
    return settle(
        named.withColumn("target", F.least("cap", level * F.col("weight"))).select(
            "src", "source", "source_size", blocks.cast("bigint").alias("blocks"), "target",
            F.when(F.col("source_size") > 0, F.col("target") * blocks / F.col("source_size")).otherwise(F.lit(0.0)).alias("expected"),
        ),
        "targets",
    )


def _uniform(*parts: Column) -> Column:
    """In [0, 1), from a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _explode_upto(n: Column, step: int = 1) -> Column:
    """0, step, ... below n; no row for n = 0."""
    return F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1, F.lit(step).cast("bigint"))))


def _permuted(x: Column, n: Column, *key: Column) -> Column:
    """Where a permutation of 0 .. n - 1, chosen by ``key``, takes x."""

    def step(at: Column, k: Column) -> Column:
        other = F.pmod(F.xxhash64(F.lit("pivot"), k, *key) - at, n)
        swap = F.xxhash64(F.greatest(at, other), k, *key).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("bigint"), step)


def slots(spark, sources: DataFrame, *, shard: int = SHARD, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per slot of the mix: out_shard, src, pass, block."""
    expected = sources.agg(F.sum("expected")).first()[0] or 0.0
    shards = max(1, round(expected / shard))
    each = F.col("expected") / F.lit(float(shards))
    shared = settle(
        sources.select("src", "blocks", F.floor(each).alias("base"), (each - F.floor(each)).alias("part")), "shares"
    )
    # The multinomial draw of each shard: which source gets a slot that no whole number deals.
    parts = shared.agg(F.sum("part")).first()[0] or 0.0
    upto = Window.orderBy("src").rowsBetween(Window.unboundedPreceding, 0)
    edges = shared.filter("part > 0").withColumn("high", F.sum("part").over(upto) / F.lit(parts or 1.0))
    edges = edges.withColumn("low", F.lag("high", 1, 0.0).over(Window.orderBy("src")))
    edges = edges.withColumn("high", F.when(F.lead("src").over(Window.orderBy("src")).isNull(), F.lit(1.0)).otherwise(F.col("high")))
    cell = F.explode(F.sequence(F.floor(F.col("low") * CELLS), F.least(F.floor(F.col("high") * CELLS), F.lit(CELLS - 1).cast("bigint"))))
    cells = edges.select("src", "low", "high", cell.alias("cell"))
    number = F.floor(F.lit(parts) + _uniform(F.lit("number"), F.lit(seed), F.col("out_shard")))
    draws = spark.range(shards).withColumnRenamed("id", "out_shard").select("out_shard", _explode_upto(number).alias("draw"))
    draws = draws.withColumn("u", _uniform(F.lit("draw"), F.lit(seed), F.col("out_shard"), F.col("draw")))
    draws = draws.withColumn("cell", F.floor(F.col("u") * CELLS).cast("bigint"))
    drawn = settle(draws.join(cells, "cell").filter("u >= low and u < high").select("out_shard", "draw", "src"), "draws")
    spread = spread_for(round(shards * (parts + 1)))
    extra = running(drawn, ["src"], ["out_shard", "draw"], {"rank": F.lit(1)}, spread).join(shared, "src")
    extra = extra.select("out_shard", "src", "blocks", (F.lit(shards) * F.col("base") + F.col("rank")).alias("j"))
    chunks = shared.select("src", "blocks", "base", (F.lit(shards) * F.col("base")).cast("bigint").alias("n"))
    chunks = chunks.select("*", _explode_upto(F.col("n"), CHUNK).alias("chunk"))
    # A number of partitions keeps Spark from merging rows that are still few and small.
    chunks = chunks.repartition(tasks_for(shards * shard, CHUNK), "src", "chunk")
    steady = chunks.select("*", _explode_upto(F.least(F.col("n") - F.col("chunk"), F.lit(CHUNK))).alias("k"))
    steady = steady.withColumn("j", F.col("chunk") + F.col("k"))
    steady = steady.select(F.floor(F.col("j") / F.col("base")).cast("bigint").alias("out_shard"), "src", "blocks", "j")
    dealt = steady.unionByName(extra).filter(F.col("j") < F.col("blocks") * most)
    dealt = dealt.withColumn("pass", F.floor(F.col("j") / F.col("blocks")).cast("int"))
    block = _permuted(F.col("j") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("src"), F.col("pass"))
    return dealt.select("out_shard", "src", "pass", block.alias("block"))


def _placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents with the number of their source and their first word's place in its stream."""
    numbered = settle(
        sized.join(sources.select("source", "src"), sized["source"].eqNullSafe(sources["source"])).select("doc_id", "src", "text_hash", "size"),
        "numbered",
    )
    return running(numbered, ["src"], ["text_hash", "doc_id"], {"start": "size"}, spread_for(numbered.count()))


def _blocks(placed: DataFrame, block: int) -> DataFrame:
    """A row per document and block that it reaches into: which of the document's words are in it."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    rows = placed.filter("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
    return rows.select(
        *KEY, "size", "block", F.greatest(F.col("block") * block - F.col("start"), F.lit(0)).alias("low"),
        F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")).alias("high"),
    )


def taken(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", *, weights: Sequence[float] = WEIGHTS,
    most: int = MOST, block: int = BLOCK, shard: int = SHARD, seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target (its source's), taken (its words in the mix)."""
    sized = _sized(docs, id_col, source_col, text_col)
    sources = targets(sized, weights, most, block)
    times = slots(docs.sparkSession, sources, shard=shard, most=most, seed=seed).groupBy("src", "block").agg(F.count(F.lit(1)).alias("times"))
    placed = settle(_placed(sized, sources), "placed")
    met = _blocks(placed, block).join(times, ["src", "block"], "left")
    part = F.coalesce(F.col("times"), F.lit(0)) * (F.col("high") - F.col("low"))
    counted = met.groupBy(*KEY, "size").agg(F.sum(part).alias("taken"))
    empty = placed.filter("size = 0").select(*KEY, "size", F.lit(0).cast("bigint").alias("taken"))
    return counted.unionByName(empty).join(sources, "src").select("doc_id", "source", "size", "source_size", "target", "taken")


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", *, weights: Sequence[float] = WEIGHTS,
    most: int = MOST, block: int = BLOCK, shard: int = SHARD, seed: int = SEED,
) -> DataFrame:
    """The mix as rows of ``docs``: for each pass, a document whole, or its taken runs of words.

    Neighbouring blocks of a pass are joined again, so only documents at the
    edge of what is taken are cut.  Cut texts have single spaces.
    """
    sized = _sized(docs, id_col, source_col, text_col)
    sources = targets(sized, weights, most, block)
    placed = settle(_placed(sized, sources), "placed")
    chosen = slots(docs.sparkSession, sources, shard=shard, most=most, seed=seed).select("src", "pass", "block")
    met = _blocks(placed, block).join(chosen, ["src", "block"])
    inside = Window.partitionBy(*KEY, "pass").orderBy("block")
    runs = (
        met.withColumn("island", F.col("block") - F.row_number().over(inside))
        .groupBy(*KEY, "size", "pass", "island").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    runs = settle(runs.join(sources.select("src", "source"), "src"), "runs")
    fields = {c: F.col("row").getField(c) for c in docs.columns}
    text = F.coalesce(fields[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*map(col, docs.columns)).alias("row")).select(
        "row", fields[id_col].alias("doc_id"), fields[source_col].cast("string").alias("source"), F.xxhash64(text).alias("text_hash")
    ).dropDuplicates(["doc_id", "source", "text_hash"])
    same = [rows[c].eqNullSafe(runs[c]) for c in ("doc_id", "source", "text_hash")]
    whole = (F.col("low") == 0) & (F.col("high") == F.col("size"))
    some = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.col("low") + 1, F.col("high") - F.col("low")), " ")
    cut = F.when(whole, fields[text_col]).otherwise(some)
    return rows.join(runs, same).select(*((cut if c == text_col else v).alias(c) for c, v in fields.items()))
