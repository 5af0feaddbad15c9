from collections import defaultdict

import pytest

from askgauge.llm import linkgraph, queries


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    cut = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return host, path[:cut]


def first_rule(host, path):
    fits = [
        r for r in linkgraph.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text)) if fits else None


URLS = [
    None,
    "",
    "no scheme/en/",
    "http://A.Example.NET/en/1?x=/de/",
    "http://example.net/EN/1",
    "http://net/",
    "http://net",
    "http://notnet/",
    "http://x.net?y://z/",
    "ftp://w.org/fr/a#b",
    "http://org/fr",
    "https://É.example.com/de/É",
    "http:///path",
    "a://b://c/d\ne",
    "://",
]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    for r in linkgraph.judge(pages).collect():
        host, path = split(URLS[r["page_id"]])
        rule = first_rule(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (rule.text if rule else None)
        if rule:
            assert r["verdict"] == ("allow" if rule.allow else "block")
    assert linkgraph.judge(pages.limit(0)).count() == 0


def brute(edges, seeds, damping, rounds):
    """Sum over paths of up to ``rounds`` links of the mass that arrives."""
    def walk(pairs, start):
        out = defaultdict(float)
        for (a, _), n in pairs.items():
            out[a] += n
        moving, total = dict(start), defaultdict(float, start)
        for _ in range(rounds):
            reached = defaultdict(float)
            for (a, b), n in pairs.items():
                reached[b] += damping * moving.get(a, 0.0) * n / out[a]
            moving = reached
            for h, m in moving.items():
                total[h] += m
        return total

    trust = walk(edges, {h: t for h, (t, _) in seeds.items() if t})
    back = walk({(b, a): n for (a, b), n in edges.items()}, {h: d for h, (_, d) in seeds.items() if d})
    return trust, back


def test_propagation_equals_brute_force(spark):
    edges = {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1, ("c", "a"): 3, ("d", "bad"): 4, ("e", "d"): 1, ("e", "a"): 1}
    seeds = {"a": (3, 0), "bad": (0, 5), "c": (1, 1), "lonely": (0, 2)}
    got = linkgraph.propagate(
        spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long"),
        spark.createDataFrame([(h, t, d) for h, (t, d) in seeds.items()], "host string, trust long, distrust long"),
        rounds=6,
    ).collect()
    trust, distrust = brute(edges, seeds, linkgraph.DAMPING, 6)
    for r in got:
        assert r["trust"] == pytest.approx(trust.get(r["host"], 0.0))
        assert r["distrust"] == pytest.approx(distrust.get(r["host"], 0.0))
    assert {r["host"] for r in got} == {*trust, *distrust}


def test_mass_flows_until_it_is_spent(spark):
    chain = [(f"h{i:02}", f"h{i + 1:02}", 1) for i in range(15)]
    got = linkgraph.propagate(
        spark.createDataFrame(chain, "src string, dst string, n long"),
        spark.createDataFrame([("h00", 1000, 0)], "host string, trust long, distrust long"),
    ).collect()
    trust = {r["host"]: r["trust"] for r in got}
    assert trust == {f"h{i:02}": pytest.approx(1000 * linkgraph.DAMPING**i) for i in range(16)}


def test_small_hosts_get_their_share_of_a_large_mass(spark):
    # On a ring of two hosts all mass keeps moving: pages / (1 - damping ** 2) in the end.
    got = linkgraph.propagate(
        spark.createDataFrame([("a", "b", 1), ("b", "a", 1)], "src string, dst string, n long"),
        spark.createDataFrame([("a", 10**9, 0)], "host string, trust long, distrust long"),
        damping=0.1,
    ).collect()
    trust = {r["host"]: r["trust"] for r in got}
    assert abs(trust["a"] - 10**9 / 0.99) < 1e-5 and abs(trust["b"] - 10**8 / 0.99) < 1e-5


def test_links_to_blocked_hosts_block_and_trust_redeems(spark):
    bad, good = '<a href="http://bad.net/x">', "<a HREF='//Good.org/'>"
    pages = [
        (1, "http://bad.net/x", ""),
        (2, "http://good.org/fr/1", '<a href="http://redeemed.com:80/">'),
        (3, "http://spam.com/1", bad + bad + '<a href="/own">'),
        (4, "http://spam.com/1", bad + good),
        (5, "http://spam.com/1", bad + good),
        (6, "http://fine.com/1", good + "<a href=relative>"),
        (7, "http://redeemed.com/1", bad),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in linkgraph.judge(df, threshold=0.15).collect()}
    assert [got[i]["verdict"] for i in range(1, 8)] == ["block", "allow", "block", "block", "block", "allow", "allow"]
    assert got[7]["host_trust"] > got[7]["host_distrust"] > 0


def test_query(spark, sf_dir):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = queries.QUERIES["op2_linkgraph"](spark, sf_dir).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = split(pages[r["page_id"]])
        rule = first_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.text if rule else None)
        assert r["verdict"] in ("allow", "block")
        if rule:
            assert r["verdict"] == ("allow" if rule.allow else "block")
