from collections import Counter

import duckdb
import numpy as np

from semprune.llm import queries, sql, trust
from semprune.llm.queries import URL_RULES
from semprune.session import materialize

SCHEMA = "page_id long, url string, html string, host string, rule int, `a.b` string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1, "x") for i, (u, h) in enumerate(rows)], SCHEMA)


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://WWW.Example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://example.com/en/?x=://y": ("example.com", "/en/", "example.com/en/", "block"),
        "https://m.example.com/en/a#b?c": ("m.example.com", "/en/a", "example.com/en/", "block"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "a://b.net/es/x://": ("b.net", "/es/x:", "net/es/", "block"),
        "http://h.com": ("h.com", "", None, "allow"),
        "http://?q": ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://ÄÖ.ORG/É": ("ÄÖ.org", "/É", None, "allow"),
    }
    cases["a://b.net/es/x://"] = ("b.net", "/es/x://", "net/es/", "block")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in trust.judge_pages(pages(spark, [(u, None) for u in cases]), URL_RULES).collect()}
    assert got == cases


def test_propagation_is_personalised_pagerank(spark):
    r = np.random.default_rng(1)
    n = 30
    weight = (r.random((n, n)) < 0.1) * r.random((n, n))
    np.fill_diagonal(weight, 0)
    weight[3] = 0
    total = weight.sum(1, keepdims=True)
    weight = np.divide(weight, total, out=np.zeros_like(weight), where=total > 0)
    seed = (r.random(n) < 0.3) * r.random(n)
    score = np.linalg.solve(np.eye(n) - trust.DAMPING * weight.T, seed)
    edges = [(f"h{i}", f"h{j}", float(weight[i, j])) for i in range(n) for j in range(n) if weight[i, j] > 0]
    seeds = spark.createDataFrame([(f"h{i}", float(seed[i])) for i in range(n)], "host string, seed double")
    table = materialize(spark.createDataFrame(edges, "src string, dst string, weight double"), "edges")
    got = {x.host: x.score for x in trust.propagate(seeds, table).collect()}
    assert max(abs(got[f"h{i}"] - score[i]) for i in range(n)) < 1e-3


def test_who_links_to_blocked_hosts_is_blocked(spark):
    link = lambda *to: "".join(f'<a href="http://{t}/es/">x</a>' for t in to)
    rows = [("http://bad.net/es/1", ""), ("http://farm.org/", link("bad.net") * 50), ("http://far.org/a", link("farm.org")), ("http://good.org/", link("ok.com")), ("http://ok.com/x", link("good.org")), ("http://lone.org/", link("lone.org"))]
    got = {r.host: r.verdict for r in trust.judge_pages(pages(spark, rows), URL_RULES).collect()}
    assert got == {"bad.net": "block", "farm.org": "block", "far.org": "block", "good.org": "allow", "ok.com": "allow", "lone.org": "allow"}


def test_distrust_falls_along_a_chain(spark):
    chain = [f"h{i:02}.org" for i in range(17)] + ["bad.net"]
    rows = [(f"http://{a}/x", f'<a href="http://{b}/es/">x</a>' * 3) for a, b in zip(chain, chain[1:], strict=False)] + [("http://bad.net/es/1", None)]
    got = {r.host: r.verdict for r in trust.judge_pages(pages(spark, rows + rows[:2]), URL_RULES).collect()}
    # 0.85 ** 14 is the last above a tenth
    assert got == {h: "block" if 17 - i <= 14 else "allow" for i, h in enumerate(chain)}


def test_query_equals_sql_on_linked_hosts(spark, tmp_path):
    r = np.random.default_rng(2)
    hosts = [f"{'abcdefgh'[i % 8]}{i}.{'net' if i % 9 == 0 else 'org'}" for i in range(40)] + ["x.com", "example.com"]
    link = lambda: f'<a href="http://{r.choice(hosts)}/es/">' * int(r.integers(1, 3))
    rows = [(f"http://{r.choice(hosts)}/{r.choice(['es', 'fr', 'en', ''])}/{i}", "".join(link() for _ in range(int(r.integers(0, 4)))) + "y " * 1000 * (i == 3)) for i in range(150)]
    rows += [rows[0], (None, None), ("http://?", "x")]
    table = spark.createDataFrame([(i % 140, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    table.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    result = con.execute(sql.url_trust(URL_RULES))
    names = [c[0] for c in result.description]
    found = Counter(map(tuple, queries.op9_url_trust(spark, str(tmp_path)).select(*names).collect()))
    assert found == Counter(result.fetchall())
    unruled = Counter(dict(zip(names, x, strict=True))["verdict"] for x in found if dict(zip(names, x, strict=True))["rule"] is None)
    assert unruled["block"] > 10 and unruled["allow"] > 10


def test_links_are_parsed_and_weighed(spark):
    html = """<a href="http://A.org/x">1</a> <a HREF = 'https://a.org?y'> <a href=//b.org/z> <a href="/local"> <a href="http://s.org/self"> <a href="mailto:x@y">"""
    placed = spark.createDataFrame([("s.org", html), ("s.org", html), ("", html), ("t.org", None)], "host string, html string")
    got = {(r.src, r.dst): r.weight for r in trust.host_edges(placed).collect()}
    assert got == {("s.org", "a.org"): 2 / 3, ("s.org", "b.org"): 1 / 3}


def test_no_pages(spark):
    assert trust.judge_pages(pages(spark, []), URL_RULES).count() == 0
