import hashlib
import random

import pytest
from brute import table
from pyspark.sql import functions as F

from salesmart.llm import chat
from salesmart.llm.queries import QUERIES


def slow_digests(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = [t for _, _, r, t in turns if r == "assistant"]
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(),
            sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest(),
        )
    return out


def digests(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_query_reads_back_all(spark, sf):
    rows = QUERIES["op10_chat_formatting"](spark, sf).collect()
    said = "</s>[INST] ok [/INST]"
    want = table(sf, "conversations", "conv_id, turn, role, text") + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    assert digests(rows) == slow_digests(want) and len(rows) == len(set(r[0] for r in want))
    assert all(r.formatted_chars > r.loss_chars for r in rows)


NASTY = ["[INST]", "[/INST]", "</s>", "<s>", "<\\s>", "[\\\\/INST]", "<", "[", "\\", "/s>", "ok", "\n", "é", "]", "INST]", "</"]


def test_escape_is_reversible():
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice(NASTY) for _ in range(rng.randrange(8)))
        assert chat.unescape(chat.escape(text)) == text
        assert not any(c in chat.escape(text) for c in ("[INST]", "[/INST]", "</s>", "<s>"))
        window, loss = chat._window([], [(text, text, 1), ("assistant", text, 1)])
        assert chat.turns_of(window) == [(text, text), ("assistant", text)]
        assert chat.unescape(window[loss[-1]["start"] : loss[-1]["end"]]) == text


@pytest.mark.parametrize("budget,history,segment", [(512, 128, 64), (30, 12, 1), (20, 0, 2), (60, 60, 3), (1, 5, 1)])
def test_windows(spark, budget, history, segment):
    rng = random.Random(budget)
    rows = []
    for conv in range(12):
        n = [1, 2, 40, 200][conv % 4]
        for turn in range(n):
            role = "system" if turn == 0 and conv % 3 == 0 else ["user", "assistant"][turn % 2]
            rows.append((conv, turn * 40, role, " ".join(rng.choice(NASTY) for _ in range(rng.randrange(14)))))
    rows += [(50, None, None, None), (50, 3, "assistant", "x"), (50, 3, "assistant", "x"), (50, -5, "assistant", "tool " * 4000), (None, 1, "assistant", "lone")]
    chats = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, segment int")
    formatted = chat.format_chats(chats, budget=budget, history=history, segment=segment)
    assert digests(chat.digest(formatted).collect()) == slow_digests(rows)
    for w in formatted.collect():
        turns = chat.turns_of(w.formatted)
        tokens = [len(t.split()) + chat.FRAME for _, t in turns]
        assert sum(tokens) <= budget or len(turns) - w.repeated == 1
        system = [k for k, (r, _) in enumerate(turns) if r == "system"]
        assert system == ([0] if w.conv_id is not None and w.conv_id < 12 and w.conv_id % 3 == 0 else [])
        assert sum(tokens[len(system) if w.repeated else 0 : w.repeated]) <= history
    assert chat.digest(chat.format_chats(chats.filter(F.lit(False)))).count() == 0
