import random
import re

import oracle_check
from pyspark.sql import functions as F

from salesmart.llm import urls
from salesmart.llm.queries import ORACLE, QUERIES, URL_RULES


def test_query_against_sql(spark, sf):
    assert oracle_check.compare(QUERIES["op6_url_filters"](spark, sf), oracle_check.duck(sf), ORACLE["op6_url_filters"]) is None


def split(url):
    found = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", url or "")
    return ("".join(c.lower() if c.isascii() else c for c in found[2]), found[3]) if found else ("", "")


def slow(url, rules, words):
    host, path = split(url)
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, name, verdict = max(fits)
        return host, path, name, verdict
    hit = any(re.search(rf"(?:^|[^0-9a-z]){w}(?:[^0-9a-z]|$)", (host + path).lower()) for w in words)
    return host, path, None, "block" if hit else "allow"


RULES = (*URL_RULES, ("block", "a-b.org", "/x"), ("allow", "a-b.org", "/xy/"), ("block", "ü.de", "/"), ("block", "org", ""), ("allow", "q.org", "x"), ("allow", "q.org", "/(a+)["))


def test_rules_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["example.com", "WWW.Example.com", "b.example.com", "myexample.com", "com", "x.net", "net", "a-b.org", "c.a-b.org", "ü.de", "xü.de", "q.org", "adult-x.io", "adulthood.io", "poker", "organic.net", "a.org", "org", "u:p@x.net:80"]
    paths = ["", "/", "/en", "/en/", "/en/1?x", "/EN/", "/es/#f", "/fr/a/b", "/x", "/xy/z", "/(a+)[", "/poker", "/p\nq", "?en/", "#/en/"]
    rows = [(i, f"{rng.choice(['http', 'https', '', 'a://b'])}://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(400)]
    rows += [(400, None), (401, ""), (402, "no scheme/en/"), (403, "://com/"), (404, "http://" + "a." * 20000 + "com/"), (5, rows[5][1]), (None, "http://com/")]
    pages = spark.createDataFrame([(i, u, "t", "v") for i, u in rows], "page_id long, url string, token string, verdict string")
    rules = [urls.host_rule(*r) for r in RULES] + list(urls.PATTERNS)
    got = urls.judge(pages, rules).collect()
    words = [r.name.strip("^") for r in urls.PATTERNS]
    want = [(i, *slow(u, RULES, words)) for i, u in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert urls.judge(pages.filter(F.lit(False)), rules).count() == 0


def test_tokens_of_rules():
    assert urls.host_rule("block", "Example.com", "/en/x").tokens == ("example", "com", "en")
    assert urls.host_rule("block", "org", ""), ("allow", "q.org", "x").tokens == ()
    assert urls.pattern_rule("block", "^ab*cd^ef.gh").tokens == ("ef",)


def test_rarest_token_lists_a_rule(spark):
    tokens = spark.createDataFrame([(t,) for t in ["com"] * 5 + ["example"] * 2 + ["en"] * 3], "token string")
    rules = urls._table(spark, [urls.host_rule("block", "example.com", "/en/"), urls.host_rule("allow", "com", "/")])
    assert {r.rule: r.token for r in urls.index(rules, tokens).collect()} == {"example.com/en/": "example", "com/": "com"}
