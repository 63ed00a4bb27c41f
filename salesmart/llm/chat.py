"""Chat formatting into budgeted windows.

A turn becomes ``[INST]role[/INST]text</s>``.  Control strings inside a role
or text get a backslash after their first character, and one more for each
backslash already there, so that removing one gives the text back.

Windows are spans of whole turns.  Prefix sums of the turns' tokens cut a
conversation into segments of at most ``SEGMENT`` budgets (and one turn), by
totals of ranges of turns, so that no task needs a whole conversation.  In a
segment, windows are filled greedily: each opens with the system turn of the
conversation, repeats as many last turns as ``HISTORY`` tokens hold, and goes
on with new turns while the budget lasts, with one new turn at least.  A turn
above the budget is not cut.

The loss mask marks the texts of new assistant turns.  Repeated turns are
masked, so each assistant text counts once.

Turns of a conversation are ordered by turn, then role and text; null turns
come first.  A null text counts as empty, a null role as an empty one.
Repeated rows are turns of their own.  A null conv_id is a conversation.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import WORD, col, on_worker, running
from salesmart.workspace import settle

BUDGET = 512
HISTORY = 128
SEGMENT = 64
#: Turns of one range of the prefix sums.
RANGE = 1024

#: The template's control strings.
OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROL = r"/?INST\]|/?s>"
#: Words that the template adds to a turn.
FRAME = 3

_ESCAPE = re.compile(rf"([<\[])(\\*)({CONTROL})")
_UNESCAPE = re.compile(rf"([<\[])\\(\\*)({CONTROL})")
_TURN = re.compile(rf"{re.escape(OPEN)}(.*?){re.escape(MIDDLE)}(.*?){re.escape(CLOSE)}", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: f"{m[1]}\\{m[2]}{m[3]}", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: f"{m[1]}{m[2]}{m[3]}", text)


def _window(opening: list, new: list) -> tuple[str, list[dict]]:
    """The text of a window of turns (role, text, tokens) and its loss spans."""
    parts, loss, at = [], [], 0
    for k, (role, text, _) in enumerate(chain(opening, new)):
        head, body = f"{OPEN}{escape(role)}{MIDDLE}", escape(text)
        if k >= len(opening) and role == "assistant":
            loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), loss


def windows(turns: list, at: int, system: tuple | None, opens: bool, budget: int, history: int):
    """Windows (text, number of repeated turns, loss spans) over ``turns[at:]``; earlier turns may be repeated.

    ``opens``: the first turn is the conversation's system turn itself.
    """
    floor = 0
    while at < len(turns):
        low, used = at, 0 if system is None else system[2]
        new = turns[at][2]
        while low > floor and sum(t[2] for t in turns[low - 1 : at]) <= history and used + new + turns[low - 1][2] <= budget:
            low -= 1
            used += turns[low][2]
        end, used = at + 1, used + new
        while end < len(turns) and used + turns[end][2] <= budget:
            used += turns[end][2]
            end += 1
        opening = ([] if system is None else [system]) + turns[low:at]
        text, loss = _window(opening, turns[at:end])
        yield text, len(opening), loss
        if opens:
            system, opens, floor = turns[0], False, 1
        at = end


#: What a row is to its segment.
SYSTEM, HISTORIC, NEW = "system", "history", "new"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def format_segment(table: pa.Table, budget: int, history: int) -> pa.Table:
    """Windows of one segment of a conversation."""
    rows = sorted(table.select(["number", "place", "role", "text", "tokens"]).to_pylist(), key=lambda r: r["number"])
    turns = {p: [(r["role"], r["text"], r["tokens"]) for r in rows if r["place"] == p] for p in (SYSTEM, HISTORIC, NEW)}
    opens = bool(turns[NEW]) and rows[0]["number"] == 0 and rows[0]["place"] == NEW and turns[NEW][0][0] == "system"
    system = turns[SYSTEM][0] if turns[SYSTEM] else None
    out = list(windows(turns[HISTORIC] + turns[NEW], len(turns[HISTORIC]), system, opens, budget, history))
    keys = {c: pa.array(table.column(c).slice(0, 1).to_pylist() * len(out), table.schema.field(c).type) for c in ("conv_id", "segment")}
    return pa.table(
        {
            **keys, "window": pa.array(range(len(out)), pa.int32()), "formatted": pa.array([o[0] for o in out], pa.string()),
            "repeated": pa.array([o[1] for o in out], pa.int32()), "loss": pa.array([o[2] for o in out], SPANS),
        }
    )


def format_chats(
    chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *,
    budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT,
) -> DataFrame:
    """One row per window: conv_id, segment, window, formatted, repeated (turns at its start that are repeats), loss spans in it."""
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    turns = settle(
        chats.select(
            col(conv_col).alias("conv_id"), F.coalesce(F.concat(F.lit("c"), col(conv_col).cast("string")), F.lit("-")).alias("conv_key"),
            col(turn_col).cast("bigint").alias("turn"), F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"),
            text.alias("text"), (F.regexp_count(text, F.lit(WORD)) + FRAME).cast("bigint").alias("tokens"),
        ),
        "turns",
    )
    range_ = F.coalesce(F.floor(F.col("turn") / RANGE), F.lit(-(1 << 62)))
    sums = {"number": F.lit(1), "before": F.col("tokens")}
    placed = running(turns, ["conv_key"], ["turn", "role", "text"], sums, bucket=range_).drop("turn")
    span = budget * segment
    placed = settle(placed.withColumn("segment", F.floor(F.col("before") / span)), "placed")
    first = (F.col("number") == 0) & (F.col("role") == "system")
    late = placed.filter((F.col("before") >= (F.col("segment") + 1) * span - history) & ~first)
    system = placed.filter(first).drop("segment").join(placed.filter("segment > 0").select("conv_key", "segment").distinct(), "conv_key")
    dealt = (
        placed.withColumn("place", F.lit(NEW))
        .unionByName(late.withColumns({"place": F.lit(HISTORIC), "segment": F.col("segment") + 1}))
        .unionByName(system.withColumn("place", F.lit(SYSTEM)))
    )
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, segment long, window int, formatted string, repeated int, loss array<struct<start: long, end: long>>"
    return dealt.groupBy("conv_key", "segment").applyInArrow(on_worker(format_segment, budget=budget, history=history), schema)


# ---- reading back --------------------------------------------------------------------------


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


class Digest:
    """What a conversation's windows say, in order; keeps hashes, not texts."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, repeated: int, loss: list[dict]) -> None:
        for role, text in turns_of(formatted)[repeated:]:
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGEST = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def digest_batches(batches):
    """Over windows sorted by conversation, segment and window."""
    now = None
    for batch in chain(batches, [None]):
        done, kind = [], None if batch is None else batch.schema.field("conv_id").type
        for r in batch.to_pylist() if batch is not None else []:
            if now is None or now.conv_id != r["conv_id"]:
                done += [now] if now else []
                now = Digest(r["conv_id"])
            now.add(r["formatted"], r["repeated"], r["loss"])
        if batch is None and now:
            done, kind = [now], last
        last = kind
        if done:
            columns = zip(*(d.row() for d in done), strict=True)
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], DIGEST)


def digest(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from its windows; a long conversation streams through its task."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return ordered.mapInArrow(on_worker(digest_batches), schema)
