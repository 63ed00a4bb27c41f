import re
from collections import Counter

import oracle_check
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import line_rules
from salesmart.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MENU = "Home About Contact, page 17"
CLEAN = " ".join(f"word{k}" for k in range(60))


def base(text):
    """Statistics by the definition."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def normal(line):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    return " ".join(WORD.findall(re.sub("[0-9]", "0", lower)))


def judged(docs):
    """(doc_id, statistics, n_removed, base_failed, kept) of rows (doc_id, text, host)."""
    docs = [(i, t or "", h) for i, t, h in docs]
    hosts = {}
    for _, t, h in docs:
        hosts.setdefault(h, set()).add(t)
    seen_in = {h: Counter(n for u in texts for n in {normal(x) for x in u.split("\n")}) for h, texts in hosts.items()}
    out = []
    for i, t, h in docs:
        seen = seen_in[h]
        gone = sum(len(WORD.findall(x)) for x in t.split("\n") if seen[normal(x)] > 10 and 100 * seen[normal(x)] > len(hosts[h]))
        b = base(t)
        failed = b[0] < 50 or 100 * b[4] > 50 * b[0]
        out.append((i, *b, gone, failed, not failed and 100 * gone <= 50 * b[0]))
    return out


def rows():
    menu = [(k, f"{MENU.replace('17', str(10 + k))}\n{CLEAN} {k}", "a") for k in range(11)]  # one document above the limit
    few = [(100 + k, f"{MENU}\n{CLEAN} {k}", "b") for k in range(10)]  # at the limit
    copies = [(200 + k, f"{CLEAN} same\nlast", "c") for k in range(30)]  # one document, thirty times
    shared = "\n".join(f"{CLEAN} {k}" for k in range(5))
    depleted = [(300 + k, f"{shared}\nown {k}", None) for k in range(12)]
    again = [(300, f"{shared}\nown 0", None)]
    odd = [
        (400, None, "a"), (401, "", None), (402, " \n\t\n\x0b", ""), (403, "a b c " * 40, "a"), (None, CLEAN, "d"), (404, "é ü # *\n# *\n" + CLEAN, "d"),
        (405, CLEAN + "\n" + " \t".join(f"long{k % 977}" for k in range(40000)), "d"), (406, "x\ny\nx\nx", "d"), (407, "a b a b a", "d"),
    ]
    return menu + few + copies + depleted + again + odd


def frame(spark, data):
    # Columns that the operator uses itself must not clash.
    clash = [(i, t, h, "x", 1, 2.5) for i, t, h in data]
    return spark.createDataFrame(clash, "doc_id long, text string, source string, lines string, host_key int, `a.b` double")


def test_against_brute_force(spark):
    for bits in (23, 15):
        got = sorted(map(str, (tuple(r) for r in line_rules.judge(frame(spark, rows()), bits=bits).collect())))
        assert got == sorted(map(str, judged(rows())))


def test_clean_cuts_lines(spark):
    got = line_rules.clean(frame(spark, rows()))
    assert got.columns == frame(spark, rows()).columns
    kept = [r for r in judged(rows()) if r[-1]]
    texts = {(r.doc_id, r.text) for r in got.collect()}
    assert got.count() == len(kept) and {i for i, _ in texts} == {r[0] for r in kept}
    assert (3, f"{CLEAN} 3") in texts and (103, f"{MENU}\n{CLEAN} 3") in texts
    assert all(r.lines == "x" and r.host_key == 1 and r["a.b"] == 2.5 for r in got.collect())


def test_empty_table(spark):
    none = frame(spark, rows()).limit(0)
    assert line_rules.judge(none).count() == 0 and line_rules.clean(none).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x1c\u0085é#|", max_size=60))
def test_statistics(text):
    assert line_rules.statistics(text.encode()) == base(text)


def test_query_against_sql(spark, sf):
    assert oracle_check.compare(QUERIES["op11_quality_rules"](spark, sf), oracle_check.duck(sf), ORACLE["op11_quality_rules"]) is None
