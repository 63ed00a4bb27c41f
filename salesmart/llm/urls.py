"""URL filters: rules found by their rarest literal token, with DataFrame functions only.

A rule is a verdict and a pattern over ``host + path``.  In a pattern ``*``
stands for any characters and ``^`` for a border: the start, the end, or a
character that is no letter or digit; all else is literal.  A host rule (host,
path) fits the host and its subdomains if the path starts with the rule's.

A rule's tokens are runs of ASCII letters and digits in its literals that end
at a border on both sides, so that every URL it fits has them as whole tokens.
The rarest of them in the table, by a count of the URLs' tokens, is where the
rule is listed.  The tokens of a URL fetch candidate rules by an equality join,
and only those run their regular expressions.  A rule without a whole token is
listed under every URL's empty token.

Equal URLs are judged once.  Of the host rules that fit the longest wins;
without one the pattern rules decide: of those that fit the longest wins, and
without one the verdict is ``allow``.

A null URL, and one without ``://``, has an empty host and path.  Repeated
rows get equal results, an empty table an empty one.  Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import col
from salesmart.workspace import settle

TOKEN = "[0-9a-z]+"
ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    name: str
    regex: str
    tokens: tuple[str, ...]
    host_rule: bool


def _lower(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""
    host = _lower(host)
    # A host is whole between its dots, but the path may go on after the rule's end.
    inside = [m.group() for m in re.finditer(TOKEN, _lower(path)) if 0 < m.start() and m.end() < len(path)]
    regex = rf"^(?:[^/]*\.)?{_quoted(host)}(?=/|$){_quoted(path)}"
    return Rule(verdict, host + path, regex, (*re.findall(TOKEN, host), *inside), True)


def pattern_rule(verdict: str, pattern: str) -> Rule:
    """Fits where the pattern occurs; letters are compared in lower case."""
    pattern = _lower(pattern)
    pieces = re.split(r"([*^])", pattern)
    regex, tokens = "", []
    for k, piece in enumerate(pieces):
        if piece == "*":
            regex += ".*"
        elif piece == "^":
            regex += "(?:^|[^0-9a-z]|$)"
        else:
            regex += _quoted(piece)
            before = pieces[k - 1] == "^" if k else False
            after = pieces[k + 1] == "^" if k + 1 < len(pieces) else False
            tokens += [
                m.group() for m in re.finditer(TOKEN, piece) if (m.start() or before) and (m.end() < len(piece) or after)
            ]
    return Rule(verdict, pattern, "(?i)" + regex, tuple(tokens), False)


def _quoted(literal: str) -> str:
    """A literal as a regular expression, the same in Java and elsewhere."""
    return re.sub(r"([^0-9A-Za-z/_-])", r"\\\1", literal) if literal.isascii() else re.sub(r"([\\.^$*+?()\[\]{}|])", r"\\\1", literal)


#: What is blocked where no host rule fits, by words in host or path.
PATTERNS = tuple(
    pattern_rule(BLOCK, f"^{word}^")
    for word in ("adult", "xxx", "porn", "casino", "casinos", "bets", "betting", "poker", "gambling", "viagra", "warez")
)


def host(url: Column) -> Column:
    ascii_ = "".join(map(chr, range(65, 91)))
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1), ascii_, ascii_.lower())


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def _table(spark, rules: Sequence[Rule]) -> DataFrame:
    """The rules as rows, from literals."""
    rows = [
        F.struct(
            F.lit(r.verdict).alias("verdict"), F.lit(r.name).alias("rule"), F.lit(r.regex).alias("regex"),
            F.array(*map(F.lit, dict.fromkeys(r.tokens or ("",)))).alias("tokens"), F.lit(r.host_rule).alias("host_rule"),
        )
        for r in rules
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _tokens(target: Column) -> Column:
    """Whole tokens, once each, and the empty one that every URL has."""
    return F.array_union(F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit(f"({TOKEN})"))), F.array(F.lit("")))


def index(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Each rule under the rarest of its tokens; ``tokens`` has a row per URL and token."""
    listed = rules.select("*", F.explode("tokens").alias("token"))
    wanted = listed.select("token").distinct()
    counts = tokens.join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ranked = listed.join(counts, "token", "left").groupBy("rule", "regex", "verdict", "host_rule").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest")
    )
    return settle(ranked.select("rule", "regex", "verdict", "host_rule", F.col("rarest.token").alias("token")), "rules")


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule (the host rule that decided, else null), verdict."""
    rows = settle(
        pages.select(col(id_col).alias("page_id"), host(col(url_col)).alias("host"), path(col(url_col)).alias("path")), "urls"
    )
    urls = rows.select("host", "path").distinct()
    tokens = settle(urls.select("host", "path", F.explode(_tokens(F.concat("host", "path"))).alias("token")), "tokens")
    listed = index(_table(pages.sparkSession, rules), tokens)
    fits = tokens.join(listed, "token").filter(F.expr("concat(host, path) rlike regex"))
    # Host rules come before pattern rules, longer ones before shorter; the name settles ties.
    order = F.struct("host_rule", F.length("rule"), F.col("verdict") == BLOCK, "rule", "verdict")
    best = settle(
        fits.groupBy("host", "path").agg(F.max(order).alias("best"))
        .select("host", "path", F.when(F.col("best.host_rule"), F.col("best.rule")).alias("rule"), F.col("best.verdict").alias("verdict")),
        "verdicts",
    )
    # There is a verdict per URL that a rule fits, so this side grows with the pages and is never broadcast.
    return rows.join(best.hint("merge"), ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(ALLOW)).alias("verdict")
    )
