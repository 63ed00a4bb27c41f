"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents become token ids and a closing id; only what is longer than a
sequence is cut.  Full pieces are sequences of their own.  The rest is dealt
by row into groups of about ``GROUP`` pieces, so no key can crowd a group, and
each group is packed in one task: best fit by decreasing length, then a local
search.  The search takes the emptiest sequence and moves its documents into
fuller ones, exchanges one for one, or two for one, always so that the sum of
squared fills grows, until the sequence is empty or nothing helps.  It stops
early at the least number of sequences that the lengths allow.  A group wastes
at most a part of a sequence, so the loss does not grow with the data.

Text is split at white space; ids of words are kept per worker, as the
tokenizer encodes each word for itself.  Words of letters share one entry
whatever their capitals and closing punctuation.

Null text counts as empty and is one piece with the closing id only.  Repeated
rows are packed each.  An empty table gives an empty result.  Other columns of
documents are ignored; ``pack`` keeps all columns of its pieces.
"""

from __future__ import annotations

import os
import re
import unicodedata
from itertools import accumulate, chain
from string import punctuation
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import col, holdings, on_worker, text_of, word_blocks
from salesmart.workspace import settle

LENGTH = 2048
CLOSING = 0
GROUP = 4096
VOCABULARY = "word_bpe_49k.json"

#: Words whose ids a worker keeps (up to twice as many for a while), and bytes of text that are looked up at a time.
WORDS = 200_000
BLOCK = 1_000_000
ENDS = punctuation.encode()  # of plain words
#: What is neither letter, digit nor white space before a final mark, control characters too, belongs to it.
RUNS = re.compile(rb"[^0-9A-Za-z\x09-\x0D\x20][.,][\x20\n]")
ENDED = re.compile(rb"(?<=[a-z])([.,])(?=[\x20\x09-\x0D])")


# ---- ids -----------------------------------------------------------------------------------


def _split(ids: np.ndarray, edges: np.ndarray) -> list[bytes]:
    return [ids[a:b].tobytes() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def simpler(text: bytes) -> bytes:
    """A text of the same ids with fewer different words.

    ASCII letters in lower case, and a comma or full stop that stands alone at
    the end of a word set apart, as the tokenizer does both.  A text that may
    spell a special token stays as it is.
    """
    if b"<|" in text:
        return text
    text = text.lower()
    if text.isascii() and not RUNS.search(text):
        for mark in (b".", b","):
            for space in (b" ", b"\n"):
                text = text.replace(mark + space, b" " + mark + space)
        return text
    return ENDED.sub(rb" \1", text)


class Kept:
    """About ``most`` entries; when they are full, those not asked for since the last time go."""

    def __init__(self, most: int):
        self.most, self.now, self.older = most, {}, {}

    def missing(self, keys: set) -> set:
        """Which keys have no entry; all others are in ``now`` afterwards."""
        if len(self.now) + len(keys) > self.most:
            self.now, self.older = {}, self.now
        fresh = keys.difference(self.now)
        unknown = fresh.difference(self.older)
        older = self.older
        self.now.update((k, older[k]) for k in fresh - unknown)
        return unknown


class Encoder:
    """Ids of words (UTF-8); unknown words are encoded together.

    A plain word is letters and perhaps closing punctuation.  The tokenizer
    puts text into composed form and lower case and splits letters from
    punctuation, so its ids are those of its stem and of its end.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        # Stems and ends are already as the tokenizer would make them, so the merges alone are left to do.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.words = Kept(WORDS)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[n for token, n in vocabulary.items() if token.endswith("</w>")]] = True

    @staticmethod
    def parts(word: bytes) -> tuple[bytes, bytes] | None:
        """Stem and end of a plain word."""
        stem = word.rstrip(ENDS)
        if stem.isalpha():  # ASCII letters only
            return stem.lower(), word[len(stem) :]
        text = stem.decode()
        low = text.lower()
        composed = unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)
        # Python lowers a final capital sigma by its place, the tokenizer does not.
        plain = composed and text.isalpha() and low.isalpha() and "\u03a3" not in text
        return (low.encode(), word[len(stem) :]) if plain else None

    def _ids(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each of some words."""
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        edges = np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(words) + 1))
        return _split(np.array(found.ids, "<u4"), edges)

    def _plain_ids(self, parts: list[bytes]) -> list[bytes]:
        """The same for stems and ends, which all close with the first token that closes a word."""
        ids = np.array(self.merges.encode_batch_fast([b" ".join(parts).decode()], add_special_tokens=False)[0].ids, "<u4")
        edges = np.concatenate([[0], np.flatnonzero(self.closes[ids]) + 1])
        if len(edges) != len(parts) + 1:
            raise ValueError("the vocabulary does not close each word with a token that ends in </w>")
        return _split(ids, edges)

    def learn(self, words: set[bytes]) -> None:
        """Give each of the words an entry."""
        fresh = self.words.missing(words)
        now = self.words.now
        stems = [w for w in fresh if w.isalpha() and w.islower()]  # most are stems as they are
        if stems:
            now.update(zip(stems, self._plain_ids(stems), strict=True))
            fresh.difference_update(stems)
        cut = {w: self.parts(w) for w in fresh}
        odd = [w for w, pair in cut.items() if pair is None]
        if odd:
            now.update(zip(odd, self._ids([w.decode() for w in odd]), strict=True))
        parts = set(chain.from_iterable(pair for pair in cut.values() if pair))
        parts.discard(b"")
        if parts:
            parts = list(parts)
            ids = dict(zip(parts, self._plain_ids(parts), strict=True))
            now.update((w, ids[p[0]] + ids[p[1]] if p[1] else ids[p[0]]) for w, p in cut.items() if p)

    def look_up(self, words: list[bytes]) -> list[bytes]:
        found = list(map(self.words.now.get, words))
        unknown = [k for k, ids in enumerate(found) if ids is None]
        self.learn({words[k] for k in unknown})
        now = self.words.now
        for k in unknown:
            found[k] = now[words[k]]
        return found

    def _together(self, texts: list[bytes]) -> list[bytes]:
        """Ids of some texts; each different word is looked up once."""
        as_text = pa.array(texts, pa.binary()).view(pa.string())  # the split reads bytes alone
        lists = pc.ascii_split_whitespace(as_text)
        words = lists.flatten().dictionary_encode()
        found = self.look_up(words.dictionary.view(pa.binary()).to_pylist())
        ends = np.fromiter(accumulate(map(len, found), initial=0), np.int64, len(found) + 1) // 4
        which = words.indices.to_numpy()
        sizes = np.diff(ends)[which]
        until = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(until[-1]) + np.repeat(ends[which] - until[:-1], sizes)
        return _split(np.frombuffer(b"".join(found), "<u4")[at], until[lists.offsets.to_numpy()])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts."""
        return self._encode(list(map(simpler, texts)))

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        """Of simpler texts; they are halved until they fit a block, and a longer text is taken in blocks."""
        if sum(map(len, texts)) <= BLOCK:
            return self._together(texts)
        if len(texts) > 1:
            half = len(texts) // 2
            return self._encode(texts[:half]) + self._encode(texts[half:])
        return [b"".join(b"".join(self.look_up(words)) for words in word_blocks(texts[0], BLOCK))]


def encoder(vocabulary: str) -> Encoder:
    """The encoder of a vocabulary file, or of a public one by its name; loaded once per worker."""
    held = holdings("packing")
    if vocabulary not in held:
        import public_tokenizers

        held[vocabulary] = Encoder(vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary))
    return held[vocabulary]


def piece_batches(batches, vocabulary, length, closing, keep_ids):
    encode, end = encoder(vocabulary).encode, np.array([closing], "<u4").tobytes()
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for first in range(0, len(texts), 128):
            rows, piece, start, size, crc, ids = [], [], [], [], [], []
            for row, data in enumerate(encode(texts.slice(first, 128).to_pylist()), first):
                data += end
                for number, at in enumerate(range(0, len(data), 4 * length)):
                    part = data[at : at + 4 * length]
                    rows.append(row)
                    piece.append(number)
                    start.append(at // 4)
                    size.append(len(part) // 4)
                    crc.append(crc32(part))
                    if keep_ids:
                        ids.append(part)
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(size, pa.int64()), pa.array(crc, pa.int64()), *([pa.array(ids, pa.binary())] if keep_ids else []),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])


def pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, vocabulary: str = VOCABULARY, length: int = LENGTH,
    closing: int = CLOSING, keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and the ids (32-bit little-endian) if asked for."""
    rows = docs.select(col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if keep_ids else "")
    return rows.mapInArrow(
        on_worker(piece_batches, vocabulary=vocabulary, length=length, closing=closing, keep_ids=keep_ids), schema
    )


# ---- sequences -----------------------------------------------------------------------------


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Items by decreasing size, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by room left
    taken = np.zeros(capacity + 1, np.int64)  # how many there are
    for item in np.argsort(-sizes, kind="stable"):
        size = int(sizes[item])
        fits = taken[size:].argmax() + size if size <= capacity else 0
        if taken[fits] and fits >= size:
            taken[fits] -= 1
            b = by_room[fits].pop()
            bins[b].append(int(item))
            room = fits - size
        else:
            b, room = len(bins), capacity - size
            bins.append([int(item)])
        by_room[room].append(b)
        taken[room] += 1
    return bins


class Search:
    """Swaps documents between underfull bins so that squared fill grows and bins empty."""

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.place = np.empty(len(sizes), np.int64)
        for b, items in enumerate(bins):
            self.place[items] = b
        self.fill = np.bincount(self.place, weights=sizes, minlength=len(bins)).astype(np.int64)

    def _best(self, given: int, source: int, others: np.ndarray) -> int:
        """The item of ``others`` that ``given`` tokens of the source should be exchanged for, or -1."""
        bins = self.place[others]
        gain = given - self.sizes[others]
        good = (gain > 0) & (gain <= self.capacity - self.fill[bins]) & (self.fill[bins] + gain > self.fill[source])
        if not good.any():
            return -1
        value = np.where(good, gain * (self.fill[bins] - self.fill[source] + gain), -1)
        return int(others[value.argmax()])

    def _shift(self, source: int, target: int, out: list[int], back: list[int]) -> None:
        self.place[out], self.place[back] = target, source
        moved = int(self.sizes[out].sum() - self.sizes[back].sum())
        self.fill[source] -= moved
        self.fill[target] += moved

    def _improve(self, source: int) -> bool:
        own = np.flatnonzero(self.place == source)
        own = own[np.argsort(-self.sizes[own], kind="stable")]
        room = self.capacity - self.fill
        for item in own:  # move
            size = int(self.sizes[item])
            good = (room >= size) & (self.fill + size > self.fill[source]) & (self.fill > 0)
            good[source] = False
            if good.any():
                self._shift(source, int(np.where(good, self.fill, -1).argmax()), [item], [])
                return True
        others = np.flatnonzero((self.fill[self.place] < self.capacity) & (self.place != source))
        if len(others):
            for item in own:  # one for one
                found = self._best(int(self.sizes[item]), source, others)
                if found >= 0:
                    self._shift(source, int(self.place[found]), [item], [found])
                    return True
            for i, a in enumerate(own):  # two for one
                for b in own[i + 1 :]:
                    found = self._best(int(self.sizes[a] + self.sizes[b]), source, others)
                    if found >= 0:
                        self._shift(source, int(self.place[found]), [a, b], [found])
                        return True
        return False

    def run(self) -> np.ndarray:
        """The bin of each item."""
        least = -(-int(self.sizes.sum()) // self.capacity)
        stuck = np.zeros(len(self.fill), bool)
        while True:
            open_ = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity) & ~stuck)
            if np.count_nonzero(self.fill) <= least or not len(open_):
                return self.place
            source = int(open_[self.fill[open_].argmin()])
            while self.fill[source] and self._improve(source):
                pass
            stuck[source] = True


def pack_group(table: pa.Table, capacity: int) -> pa.Table:
    """Place the pieces of one group."""
    sizes = table.column("length").to_numpy().astype(np.int64)
    place = Search(sizes, best_fit(sizes, capacity), capacity).run()
    order = np.lexsort((np.arange(len(sizes)), place))
    ends = np.cumsum(sizes[order])
    first = np.concatenate([[True], place[order][1:] != place[order][:-1]])
    starts = ends - sizes[order]
    offset = np.empty(len(sizes), np.int64)
    offset[order] = starts - np.maximum.accumulate(np.where(first, starts, 0))
    number = place + (table.column("pack_group").to_numpy().astype(np.int64) << 32)
    return table.drop_columns(["pack_group"]).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offset))


def pack(cut: DataFrame, *, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (their ``length`` is 1 to ``length``); all their columns are kept."""
    rows = settle(cut.withColumn("pack_row", F.monotonically_increasing_id()), "pieces")
    part = rows.filter(F.col("length") < length)
    groups = 1 + part.count() // group
    full = rows.filter(F.col("length") == length).select(
        *map(col, cut.columns), (-1 - F.col("pack_row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    dealt = part.withColumn("pack_group", F.pmod(F.xxhash64("pack_row"), F.lit(groups))).drop("pack_row")
    schema = cut.schema.add("sequence_id", "long").add("offset", "long")
    packed = dealt.groupBy("pack_group").applyInArrow(on_worker(pack_group, capacity=length), schema)
    return full.unionByName(packed)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from packed pieces that kept their ids: sequence_id, length, ids (binary)."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p)).alias("ids"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Tokenise and pack."""
    return pack(pieces(docs, id_col, text_col, **options))
