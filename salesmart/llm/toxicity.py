"""Toxicity: a convolutional text classifier in numpy over hashed word embeddings.

A word is the mean of four hashed embeddings (the word, its first four and
five characters, its last four).  Filters of widths 1 to 3 run over all words
of a text, each keeps its maximum, and a logistic unit weighs the maxima.
Thresholds are calibrated by language: the language is guessed from the
function words of the text itself, and a score is the logistic of the distance
to the threshold of that language, so 0.5 always is the border.

Training: a bounded sample of labelled rows (``SAMPLE``) of at most
``TRAIN_CHARS`` characters comes to the driver and is trained on in a fixed
number of steps; one part of it is left for calibration.  Everything else is
scored in tasks, whole texts, with the model (a few MB) as a broadcast.

Calibration: all learnable labelled rows that were not trained on, of any
length, are scored in tasks, and counts of their margins by language and label
come to the driver.  Rows that were trained on are stood for by the others of
their label and kind of length, so the counts have the ratios of all learnable
rows, however large the sample was.
A projection of each word onto all filters is kept per worker, so the
convolution is a sum of looked-up rows.

Null text counts as empty and gets a score as well.  Rows with a null or
unknown label are not learnt from; of several labels of one id the largest
counts.  Without labels of both kinds there is no model and all scores are 0.
Repeated rows get equal scores.  ``score`` ignores other columns, ``keep``
passes them through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.llm.common import bitmap_of, col, give_back, holdings, on_worker, text_of, with_flag
from salesmart.workspace import settle

#: Most labelled rows of each label that are learnt from, and their longest text.
SAMPLE = 4000
TRAIN_CHARS = 20_000
#: Share of the sample that only calibrates: one in ...
CALIBRATE = 4
#: Margins are counted in steps of 1/STEP up to RANGE on either side, which bounds what comes to the driver.
STEP = 64
RANGE = 64
BITS = 26

SLOTS = 1 << 17
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
STEPS = 400
BATCH = 64
#: Words whose projections a worker keeps.
KEPT = 100_000

#: Frequent function words that tell the languages apart.
FUNCTION_WORDS = {
    "en": ("the", "of", "and", "to", "is", "was", "that", "for", "with", "are", "this"),
    "de": ("der", "die", "und", "den", "von", "das", "mit", "sich", "auf", "ist", "ein", "eine", "nicht"),
    "fr": ("le", "les", "et", "des", "une", "du", "dans", "est", "pour", "que", "qui", "sur"),
    "es": ("el", "los", "las", "y", "del", "se", "por", "con", "para", "una", "su", "al"),
}
LANGUAGES = (*FUNCTION_WORDS, "other")
OTHER = len(LANGUAGES) - 1
LANGUAGE_OF = {w: i for i, words in enumerate(FUNCTION_WORDS.values()) for w in words}
PUNCTUATION = ".,;:!?\"'()[]{}<>«»„“”…|-–—*#_/\\"


def pieces(word: str) -> tuple[int, int, int, int, int]:
    """Hashes of a word, of its first four and five and its last four bytes, and the language it speaks for."""
    w = word.lower().strip(PUNCTUATION)
    b = w.encode()
    return crc32(b), crc32(b[:4], 1), crc32(b[:5], 2), crc32(b[-4:], 3), LANGUAGE_OF.get(w, OTHER)


def hashed(words) -> tuple[np.ndarray, np.ndarray]:
    """Embedding places and language of each word."""
    found = np.array([pieces(w) for w in words], np.int64).reshape(-1, 5)
    return found[:, :4] % SLOTS, found[:, 4]


@dataclass
class Model:
    embeddings: np.ndarray  # SLOTS x DIM
    filters: np.ndarray  # DIM x (positions of all widths x FILTERS)
    bias: np.ndarray  # widths x FILTERS
    weights: np.ndarray  # widths x FILTERS
    offset: float
    thresholds: np.ndarray  # one per language

    def pooled(self, rows: np.ndarray) -> np.ndarray:
        """Maxima of all filters over a text; a column of ``rows`` is a word's projection, the last two are padding."""
        n, best, at = max(1, rows.shape[1] - 2), [], 0
        for width in WIDTHS:
            total = rows[at : at + FILTERS, :n]
            for k in range(1, width):
                at += FILTERS
                total = total + rows[at : at + FILTERS, k : n + k]
            at += FILTERS
            best.append(total.max(axis=1))
        return np.concatenate(best)

    def margin(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled + self.bias, 0) @ self.weights + self.offset


class Words(dict):
    """Numbers for words; new ones wait in ``fresh``.  Number 0 is padding."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self) + 1
        self.fresh.append(word)
        return number


class Scorer:
    """A model with the projections of the words met so far."""

    def __init__(self, model: Model, block: int = 1 << 16):
        self.model, self.block = model, block
        self.reset()

    def reset(self) -> None:
        self.words = Words()
        self.rows = np.zeros((self.model.filters.shape[1], 1 << 12), np.float32)
        self.speaks = np.full(1 << 12, OTHER, np.int8)

    def _learn(self) -> None:
        fresh, self.words.fresh = self.words.fresh, []
        if fresh:
            places, spoken = hashed(fresh)
            vectors = self.model.embeddings[places].mean(axis=1)
            need = len(self.words) + 1
            if need > len(self.speaks):
                more = max(need, 2 * len(self.speaks)) - len(self.speaks)
                self.rows = np.pad(self.rows, ((0, 0), (0, more)))
                self.speaks = np.pad(self.speaks, (0, more))
            self.rows[:, need - len(fresh) : need] = (vectors @ self.model.filters).T
            self.speaks[need - len(fresh) : need] = spoken

    def margin(self, text: str) -> tuple[float, int]:
        """Distance to the common border, and the language guessed."""
        words, found, votes = text.split(), None, np.zeros(len(LANGUAGES), np.int64)
        for start in range(0, max(1, len(words)), self.block):
            part = words[start : start + self.block + max(WIDTHS) - 1]
            if len(self.words) > KEPT:
                self.reset()
            numbers = np.zeros(min(self.block, max(1, len(words) - start)) + max(WIDTHS) - 1, np.int64)
            numbers[: len(part)] = np.fromiter(map(self.words.__getitem__, part), np.int64, len(part))
            self._learn()
            best = self.model.pooled(self.rows.take(numbers, axis=1))
            found = best if found is None else np.maximum(found, best)
            votes += np.bincount(self.speaks[numbers[: self.block]], minlength=len(votes))
        spoken = int(votes[:-1].argmax()) if votes[:-1].any() else OTHER
        return float(self.model.margin(found)), spoken

    def score(self, text: str) -> float:
        margin, spoken = self.margin(text)
        return float(1 / (1 + np.exp(-np.clip(margin - self.model.thresholds[spoken], -50, 50))))


# ---- training ------------------------------------------------------------------------------


class Adam:
    def __init__(self, shape, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(shape), np.zeros(shape), 0, rate

    def step(self, values: np.ndarray, slope: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (slope - self.m)
        self.v += 0.001 * (slope**2 - self.v)
        values -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _encoded(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    words = Words()
    numbers = [np.fromiter(map(words.__getitem__, t.split() or [""]), np.int64) for t in texts]
    return numbers, np.concatenate([np.zeros((1, 4), np.int64), hashed(words)[0]])


def fit(texts: list[str], labels: np.ndarray, seed: int = 7, steps: int = STEPS) -> Model:
    """Train on texts of both labels; the thresholds are still zero."""
    rng = np.random.default_rng(seed)
    numbers, places = _encoded(texts)
    spans = [(w, k) for w in WIDTHS for k in range(w)]
    filters = rng.normal(0, 0.5, (DIM, len(spans) * FILTERS))
    kinds = len(WIDTHS) * FILTERS
    bias, weights, offset = np.zeros(kinds), rng.normal(0, 0.5, kinds), np.zeros(1)
    embeddings = np.zeros((SLOTS, DIM))
    seen = np.unique(places[1:])
    embeddings[seen] = rng.normal(0, 0.05, (len(seen), DIM))
    history = np.full(SLOTS, 1e-6)
    steppers = [Adam(x.shape, 0.01) for x in (filters, bias, weights, offset)]
    groups = [np.flatnonzero(labels == y) for y in (0, 1)]
    reach = max(WIDTHS) - 1
    for _ in range(steps):
        chosen = np.concatenate([rng.choice(g, BATCH // 2) for g in groups])
        lengths = np.array([len(numbers[i]) for i in chosen])
        starts = np.concatenate([[0], np.cumsum(lengths + reach)[:-1]])
        flow = np.zeros(int((lengths + reach).sum()) + reach, np.int64)
        for s, i in zip(starts, chosen, strict=True):
            flow[s : s + len(numbers[i])] = numbers[i]
        unique, place = np.unique(flow, return_inverse=True)
        vectors = embeddings[places[unique]].mean(axis=1)
        vectors[unique == 0] = 0
        rows = (vectors @ filters)[place]
        n = len(flow) - reach
        inside = np.zeros(n, bool)
        for s, k in zip(starts, lengths, strict=True):
            inside[s : s + k] = True
        pooled, top = np.empty((BATCH, kinds)), np.empty((BATCH, kinds), np.int64)
        for j, width in enumerate(WIDTHS):
            total = np.zeros((n, FILTERS))
            for c, (w, k) in enumerate(spans):
                if w == width:
                    total += rows[k : n + k, c * FILTERS : (c + 1) * FILTERS]
            total[~inside] = -np.inf
            for d, (s, k) in enumerate(zip(starts, lengths, strict=True)):
                at = total[s : s + k].argmax(axis=0)
                top[d, j * FILTERS : (j + 1) * FILTERS] = s + at
                pooled[d, j * FILTERS : (j + 1) * FILTERS] = total[s + at, np.arange(FILTERS)]
        active = pooled + bias
        hidden = np.maximum(active, 0)
        p = 1 / (1 + np.exp(-np.clip(hidden @ weights + offset[0], -50, 50)))
        slope = (p - labels[chosen]) / BATCH
        # A slope below zero passes a little, so that no filter is lost for good.
        to_pooled = slope[:, None] * weights * np.where(active > 0, 1, 0.05)
        to_filters = np.zeros_like(filters)
        to_vectors = np.zeros_like(vectors)
        for c, (w, k) in enumerate(spans):
            j = WIDTHS.index(w)
            columns = slice(c * FILTERS, (c + 1) * FILTERS)
            at = place[top[:, j * FILTERS : (j + 1) * FILTERS] + k]  # BATCH x FILTERS
            g = to_pooled[:, j * FILTERS : (j + 1) * FILTERS]
            to_filters[:, columns] += np.einsum("bfd,bf->df", vectors[at], g)
            np.add.at(to_vectors, at.ravel(), (g[:, :, None] * filters[:, columns].T[None]).reshape(-1, DIM))
        changed = np.flatnonzero(to_vectors.any(axis=1) & (unique != 0))
        slots = places[unique[changed]]
        pulls = np.repeat(to_vectors[changed] / 4, 4, axis=0)
        flat = slots.ravel()
        np.add.at(history, flat, (pulls**2).mean(axis=1))
        np.add.at(embeddings, flat, -0.1 * pulls / np.sqrt(history[flat])[:, None])
        for stepper, values, s in zip(
            steppers, (filters, bias, weights, offset), (to_filters, to_pooled.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])), strict=True
        ):
            stepper.step(values, s + 1e-4 * values)
    return Model(
        embeddings.astype(np.float32), filters.astype(np.float32), bias.astype(np.float32), weights.astype(np.float32),
        float(offset[0]), np.zeros(len(LANGUAGES), np.float32),
    )


def border(low: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None, high: np.ndarray | None = None) -> float:
    """The border with the fewest errors, in the middle of the widest gap that has as few; a margin may be a range."""
    weights, high = np.ones(len(low)) if weights is None else weights, low if high is None else high
    order = np.argsort(low, kind="stable")
    low, y, weights, top = low[order], labels[order], weights[order], np.maximum.accumulate(high[order])
    starts = np.concatenate([[True], low[1:] > top[:-1]])  # ranges that meet cannot be parted
    place = np.cumsum(starts) - 1
    first, last = low[starts], top[np.append(starts[1:], True)]
    toxic, clean = (np.bincount(place, weights * (y == label)) for label in (1, 0))
    errors = np.concatenate([[0], np.cumsum(toxic)]) + np.concatenate([np.cumsum(clean[::-1])[::-1], [0]])
    left, right = np.concatenate([[first[0] - 1], last]), np.concatenate([first, [last[-1] + 1]])
    gaps = np.where(errors <= errors.min() + 1e-9 * weights.sum(), right - left, -1)
    k = int(gaps.argmax())
    return float((left[k] + right[k]) / 2)


def set_borders(model: Model, spoken, labels, low, high, count, weights, least: int = 10) -> Model:
    """Set the threshold of each language that has ``least`` texts of both labels; others get the common one."""
    for i in range(len(LANGUAGES)):
        own = spoken == i
        enough = min(count[own & (labels == y)].sum() for y in (0, 1)) >= least
        rows = own if enough else np.ones(len(labels), bool)
        if len(np.unique(labels[rows])) == 2:
            model.thresholds[i] = border(low[rows], labels[rows], weights[rows], high[rows])
    return model


def calibrate(model: Model, texts: list[str], labels: np.ndarray, least: int = 10) -> Model:
    """Thresholds from a few texts on the driver."""
    scorer = Scorer(model)
    found = [scorer.margin(t) for t in texts]
    margins, spoken, one = np.array([m for m, _ in found]), np.array([s for _, s in found]), np.ones(len(found))
    return set_borders(model, spoken, labels, margins, margins, one, one, least)


def known_labels(docs: DataFrame, labels: DataFrame, id_col: str, learn) -> DataFrame:
    """label_id (of the type that ids of ``docs`` have) and label of all rows that may be learnt from."""
    kind = docs.select(col(id_col)).schema[0].dataType
    return settle(
        labels.select(F.col("doc_id").try_cast(kind).alias("label_id"), F.col("toxic").cast("int").alias("label"))
        .filter(F.col("label_id").isNotNull() & F.col("label").isin(0, 1) & learn(F.col("label_id")))
        .groupBy("label_id").agg(F.max("label").alias("label")),
        "known",
    )


def labelled(docs: DataFrame, known: DataFrame, id_col: str, text_col: str, sample: int) -> tuple[list, list[str], np.ndarray]:
    """Up to ``sample`` rows of each label in a fixed random order, on the driver."""
    halves = [known.filter(F.col("label") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(sample) for y in (0, 1)]
    chosen = halves[0].unionByName(halves[1])  # at most 2 x sample rows, so its broadcast is bounded
    rows = (
        docs.select(col(id_col).alias("label_id"), text_of(text_col).alias("text")).filter(F.length("text") <= TRAIN_CHARS)
        .join(F.broadcast(chosen), "label_id").dropDuplicates(["label_id"]).toPandas().sort_values("label_id")
    )
    return rows["label_id"].tolist(), list(rows["text"]), rows["label"].to_numpy()


def margin_batches(batches, model):
    holdings("toxicity")
    scorer = Scorer(model.value)
    for batch in batches:
        found = [scorer.margin(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([m for m, _ in found], pa.float64()), pa.array([s for _, s in found], pa.int32())],
            ["label_id", "long", "margin", "spoken"],
        )


def margin_counts(docs: DataFrame, known: DataFrame, model: Model, fitted: list, id_col: str, text_col: str):
    """Counts of all known rows but the ``fitted`` ids by language, label, kind of length and step of the margin, on the driver.

    A bitmap of fixed size tells labelled rows where they are, so no text is
    moved; of several texts of one id the one with the least margin counts.
    """
    spark = docs.sparkSession
    rows = docs.select(col(id_col).alias("label_id"), text_of(text_col).alias("text"))
    bitmap = settle(bitmap_of(known.select("label_id"), "label_id", BITS), "bitmap")
    met = with_flag(rows, bitmap, "label_id", BITS, "suspect").filter("suspect")
    kind, shared = rows.schema["label_id"].dataType, spark.sparkContext.broadcast(model)
    margins = met.select("label_id", (F.length("text") > TRAIN_CHARS).alias("long"), "text").mapInArrow(
        on_worker(margin_batches, model=shared), f"label_id {kind.simpleString()}, long boolean, margin double, spoken int"
    )
    one = margins.groupBy("label_id").agg(F.min(F.struct("margin", "spoken", "long")).alias("found")).join(known, "label_id")
    seen = spark.createDataFrame([(i,) for i in fitted], T.StructType([T.StructField("label_id", kind)]))  # at most 2 x sample rows
    step = F.least(F.greatest(F.floor(F.col("margin") * STEP), F.lit(-STEP * RANGE)), F.lit(STEP * RANGE))
    return (
        one.join(F.broadcast(seen), "label_id", "left_anti").select("label", "found.*").withColumn("step", step)
        .groupBy("spoken", "label", "long", "step")
        .agg(F.count(F.lit(1)).alias("count"), F.min("margin").alias("low"), F.max("margin").alias("high"))
        .toPandas().sort_values(["spoken", "label", "long", "step"], ignore_index=True)
    )


def calibrate_on_all(model: Model, counts, fitted_labels: np.ndarray) -> Model:
    """Thresholds from counts; rows that were trained on (all short) are stood for by the other short ones of their label."""
    label, long, count = counts["label"].to_numpy(), counts["long"].to_numpy(bool), counts["count"].to_numpy(np.float64)
    weights = count.copy()
    for y in (0, 1):
        short = (label == y) & ~long
        if short.any():
            weights[short] *= 1 + np.sum(fitted_labels == y) / count[short].sum()
    return set_borders(model, counts["spoken"].to_numpy(), label, counts["low"].to_numpy(), counts["high"].to_numpy(), count, weights)


def held_out(doc_id) -> F.Column:
    """Rows that are never learnt from: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample: int = SAMPLE,
    learn=lambda doc_id: ~held_out(doc_id),
) -> Model | None:
    known = known_labels(docs, labels, id_col, learn)
    ids, texts, y = labelled(docs, known, id_col, text_col, sample)
    check = np.array([crc32(b"calibrate" + str(i).encode()) % CALIBRATE == 0 for i in ids], bool)
    if not len(y) or len(np.unique(y[~check])) < 2:
        return None
    model = fit([t for t, c in zip(texts, check, strict=True) if not c], y[~check])
    counts = margin_counts(docs, known, model, [i for i, c in zip(ids, check, strict=True) if not c], id_col, text_col)
    return calibrate_on_all(model, counts, y[~check])


# ---- scoring -------------------------------------------------------------------------------


def score_batches(batches, model):
    holdings("toxicity")
    scorer = Scorer(model.value)
    for batch in batches:
        scores = [scorer.score(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])


def clean_flags(texts, model):
    """Arrays of texts -> is a text not rejected?"""
    holdings("toxicity")
    scorer = Scorer(model.value)
    for part in texts:
        yield pa.array([scorer.score(t.as_py()) < 0.5 for t in part], pa.bool_())
    del scorer
    give_back()


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, score, predicted."""
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    if model is None:
        scored = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)
        kind = rows.schema["doc_id"].dataType.simpleString()
        scored = rows.mapInArrow(on_worker(score_batches, model=shared), f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, whole.  Only texts go to the workers and flags come back."""
    if model is None:
        return docs
    flags = on_worker(clean_flags, model=docs.sparkSession.sparkContext.broadcast(model))
    flags.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return docs.filter(F.arrow_udf(flags, "boolean")(text_of(text_col)))
