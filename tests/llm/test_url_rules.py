"""URL rules: the trie and the join against trying every rule."""

import random

import pytest

from bandlex.llm import url_rules
from bandlex.llm.oracle import oracle_sql
from bandlex.llm.queries import URL_RULES, op8_url_rules


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    best = None
    for verdict, rule in rules:
        r_host, slash, r_path = rule.partition("/")
        r_host, r_path = r_host.lower(), slash + r_path
        if (host == r_host or host.endswith("." + r_host)) and path.startswith(r_path):
            key = (r_host.count("."), len(r_path), verdict == "block")
            if best is None or key > best[0]:
                best = (key, rule, verdict)
    return host, path, best and best[1], best[2] if best else default


def test_query_against_sql(spark, sf, sql):
    found = op8_url_rules(spark, sf)
    expected = sql.execute(oracle_sql()["op8_url_rules"]).fetchall()
    columns = [d[0] for d in sql.description]
    assert sorted(found.columns) == sorted(columns)
    rows = found.select(columns).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    pages = {p.page_id: p.url for p in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert all(tuple(r)[1:] == brute(pages[r.page_id], URL_RULES) for r in found.select("page_id", "host", "path", "rule", "verdict").collect())


@pytest.mark.parametrize("limits", [{}, {"max_rules": 3}, {"max_bytes": 5000}])
@pytest.mark.parametrize("seed", range(2))
def test_random_rules(spark, seed, limits):
    rng = random.Random(seed)

    def host():
        return ".".join(rng.choice(["a", "b", "example", "net", "com"]) for _ in range(rng.randint(1, 4)))

    def path():
        return "".join("/" + rng.choice(["", "x", "xy", "xyz", "y"]) for _ in range(rng.randint(0, 4)))

    rules = list({(rng.choice(["allow", "block"]), host() + path()) for _ in range(150)})
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{host().title()}{path()}{rng.choice(['', '?q=/x', '#a/x', '?a://b'])}" for _ in range(400)]
    urls += [None, "", "no scheme/x", "://", "http://", "http:///x", "a://b://c/x", "http://.net/", "http://net.", "HTTP://É.Net/x\ny", "x" * 50_000, "http://a.net" + "/x" * 5000]
    urls += urls[:5]
    frame = spark.createDataFrame([(i, u, 1, "r") for i, u in enumerate(urls)], "page_id long, url string, host int, rule string")
    table = spark.createDataFrame(rules + [(None, "a/"), ("block", None)] + rules[:3], "verdict string, rule string")
    found = {r.page_id: tuple(r)[1:] for r in url_rules.judge_urls(frame, table, **limits).collect()}
    assert found == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_no_rows_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "verdict string, rule string")
    assert url_rules.judge_urls(pages.limit(0), rules).collect() == []
    row = url_rules.judge_urls(pages, rules.limit(0), default="block").first()
    assert (row.rule, row.verdict) == (None, "block")
