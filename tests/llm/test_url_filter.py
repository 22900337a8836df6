import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import url_filter as U

SCHEMA = "page_id long, url string, html string, host string, trust string"
HREF = re.compile(r"""(?i)\bhref\s*=\s*["']?([^"'\s>]*://[^"'\s>]+)""")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = re.search(r"[/?#]", rest)
    host, tail = (rest[:cut.start()], rest[cut.start():]) if cut else (rest, "")
    host = host.translate({c: c + 32 for c in range(65, 91)})
    return host, re.split(r"[?#]", tail)[0]


def rule_of(host, path):
    best = None
    for kind, suffix, prefix in U.RULES:
        if (host == suffix or host.endswith("." + suffix)) and path.startswith(prefix):
            if best is None or len(suffix + prefix) > len(best[1]):
                best = (kind, suffix + prefix)
    return best or (None, None)


def brute(data, rounds=U.ROUNDS, damping=U.DAMPING, threshold=U.THRESHOLD):
    edges, kinds = defaultdict(int), defaultdict(set)
    for _, url, html in data:
        host, path = parts(url)
        kind, _ = rule_of(host, path)
        if kind and host:
            kinds[host].add(kind)
        for link in HREF.findall(html or ""):
            dst = parts(link)[0]
            if host and dst and host != dst:
                edges[host, dst] += 1
    good = [h for h, k in kinds.items() if k == {"allow"}]
    bad = [h for h, k in kinds.items() if k == {"block"}]
    out, back = defaultdict(int), defaultdict(int)
    for (a, b), n in edges.items():
        out[a] += n
        back[b] += n
    t = {h: 1 / len(good) for h in good}
    d = {h: 1 / len(bad) for h in bad}
    for _ in range(rounds):
        nt, nd = defaultdict(float), defaultdict(float)
        for h in good:
            nt[h] += (1 - damping) / len(good)
        for h in bad:
            nd[h] += (1 - damping) / len(bad)
        for (a, b), n in edges.items():
            nt[b] += damping * t.get(a, 0) * n / out[a]
            nd[a] += damping * d.get(b, 0) * n / back[b]
        t, d = nt, nd
    result = {}
    for i, url, _ in data:
        host, path = parts(url)
        kind, rule = rule_of(host, path)
        x, y = t.get(host, 0), d.get(host, 0)
        result[i] = (host, path, rule, kind or ("block" if y > 0 and y >= threshold * (x + y) else "allow"), x, y)
    return result


def compare(got, want):
    assert len(got) == len(want)
    for r in got:
        host, path, rule, verdict, trust, distrust = want[r.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
        assert abs(r.trust - trust) < 1e-12 and abs(r.distrust - distrust) < 1e-12


def odd_pages():
    urls = ["http://Good.ORG/fr/1", "https://bad.net/x", "http://friend.test/a?b=://c", "http://spam.test", None, "no scheme",
            "http://example.net/en/a", "http://www.example.net/de/", "http://example.net", "http://net/", "http://xnet/",
            "http://a.example.com/de/1#x", "http://a.example.com/fr/", "://odd/path", "http:///p", "x://h?q/z", "http://h2#/fr/",
            "http://org/fr/", "http://neworg/fr/", "ftp://u@Friend.test:80/a"]
    html = ['<a href="http://friend.test/">x</a><A HREF=\'http://unknown.test\'>', None, '<a href=http://good.org/fr/2>',
            '<a href="https://bad.net/">1</a><a href="https://bad.net/q">2</a><a href="/local">', "", "<a>", "<a href='x'>"]
    return [(i, u, html[i % len(html)], "clash", "clash") for i, u in enumerate(urls)]


def test_odd_rows(spark):
    df = spark.createDataFrame(odd_pages(), SCHEMA).repartition(3)
    compare(U.judge_urls(df).collect(), brute([r[:3] for r in odd_pages()]))


def test_who_links_to_blocked_hosts_is_blocked(spark):
    got = {r.host: r.verdict for r in U.judge_urls(spark.createDataFrame(odd_pages(), SCHEMA)).collect()}
    assert got["spam.test"] == "block" and got["friend.test"] == "allow"


def test_table(spark, sf):
    df = spark.read.parquet(f"{sf}/pages.parquet")
    compare(U.judge_urls(df).collect(), brute([(r.page_id, r.url, r.html) for r in df.collect()]))


def test_repeated_rows_and_null_ids(spark):
    data = [(None, "http://a.org/fr/", None, "c", "c")] * 3 + [(1, "http://b.test/", None, "c", "c")] * 2
    got = U.judge_urls(spark.createDataFrame(data, SCHEMA))
    assert got.count() == 5 and got.filter("verdict = 'allow'").count() == 5


def test_empty(spark):
    assert U.judge_urls(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("url,host,path,rule", [("http://a.example.net/en/x", "a.example.net", "/en/x", "example.net/en/"),
                                                 ("http://a.example.net/de/x", "a.example.net", "/de/x", "net/"),
                                                 ("http://a.example.com/fr/", "a.example.com", "/fr/", None)])
def test_longest_rule_wins(spark, url, host, path, rule):
    h, p = U.url_parts(F.col("url"))
    frame = spark.createDataFrame([(url,)], "url string").select(h.alias("h"), p.alias("p"))
    r = frame.select("h", "p", U.rule_columns(F.col("h"), F.col("p"))[0].alias("rule")).first()
    assert tuple(r) == (host, path, rule)


def test_path_rule_leaves_the_rest_of_its_host(spark):
    """A rule for /de/ blocks those pages alone: the host's other pages, and
    who links to them, stay allowed; who links to /de/ does not."""
    urls = ["http://a.example.com/de/1", *[f"http://a.example.com/en/{i}" for i in range(5)],
            "http://likes-en.test/", "http://likes-de.test/", "http://m.example.net/en/1", "http://m.example.net/de/1",
            "http://m.example.net", "http://from-en.test/x"]
    html = {6: '<a href="http://a.example.com/en/1">', 7: '<a href="http://a.example.com/de/9">',
            1: '<a href="http://a.example.com/de/1">', 8: '<a href="http://from-en.test/">'}
    df = spark.createDataFrame([(i, u, html.get(i), "c", "c") for i, u in enumerate(urls)], SCHEMA).repartition(3)
    got = {r.page_id: r for r in U.judge_urls(df, sections=True).collect()}
    assert [got[i].verdict for i in range(12)] == ["block"] + ["allow"] * 6 + ["block", "allow", "block", "block", "allow"]
    assert all(got[i].distrust == 0 for i in range(1, 7)) and got[0].distrust > 0
    # a host with an allowed and a blocked part seeds both
    assert got[8].trust > 0 and got[9].distrust > 0 and got[11].trust > 0


def test_registered_query_blocks_only_what_rules_or_links_block(spark, sf):
    """No page of the table links to another host, so a page that no rule
    settles is allowed."""
    from fleetlens.llm.queries import op6_urls
    got = op6_urls(spark, sf).collect()
    rules = {r.page_id: rule_of(*parts(r.url))[0] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert {r.page_id: r.verdict for r in got} == {i: v or "allow" for i, v in rules.items()}
    assert any(v is None for v in rules.values())


def exact(edges, good, bad, damping=U.DAMPING):
    """{host: (trust, distrust)} by solving the linear equations."""
    hosts = sorted({h for e in edges for h in e} | set(good) | set(bad))
    at = {h: i for i, h in enumerate(hosts)}
    out, back = defaultdict(int), defaultdict(int)
    for (a, b), n in edges.items():
        out[a] += n
        back[b] += n
    t, d = np.zeros((len(hosts),) * 2), np.zeros((len(hosts),) * 2)
    for (a, b), n in edges.items():
        t[at[b], at[a]] += n / out[a]
        d[at[a], at[b]] += n / back[b]
    def start(s):
        return (1 - damping) * np.array([(h in s) / max(len(s), 1) for h in hosts])
    x = np.linalg.solve(np.eye(len(hosts)) - damping * t, start(good))
    y = np.linalg.solve(np.eye(len(hosts)) - damping * d, start(bad))
    return {h: (x[i], y[i]) for h, i in at.items()}


def test_long_chain_and_cycle_settle(spark):
    """A blocked host at the end of 25 links blocks the first host as well,
    and a cycle with both trust and distrust meets the exact solution."""
    links = [(f"h{i}.test", f"h{i + 1}.test") for i in range(24)] + [("h24.test", "bad.net")]
    links += [("a.org", "c1.test"), ("c1.test", "c2.test"), ("c2.test", "c3.test"), ("c3.test", "c1.test"),
              ("c3.test", "bad.net"), ("c2.test", "a.org"), ("c2.test", "a.org")]
    data = [(i, f"http://{a}/fr/", f'<a href="http://{b}/fr/">', "c", "c") for i, (a, b) in enumerate(links)]
    data.append((len(data), "http://bad.net/", None, "c", "c"))
    edges = defaultdict(int)
    for e in links:
        edges[e] += 1
    # the part /fr/ of a.org is a node of its own under the rules
    edges = {tuple("a.org/fr/" if h == "a.org" else h for h in e): n for e, n in edges.items()}
    want = exact(edges, {"a.org/fr/"}, {"bad.net"})
    got = U.judge_urls(spark.createDataFrame(data, SCHEMA), rounds=None, sections=True).collect()
    for r in got:
        t, d = want["a.org/fr/" if r.host == "a.org" else r.host]
        assert abs(r.trust - t) <= 1e-7 * t and abs(r.distrust - d) <= 1e-7 * d
        if r.rule is None:
            assert r.verdict == ("block" if d >= U.THRESHOLD * (t + d) else "allow")
    assert {r.verdict for r in got if r.host.startswith("h")} == {"block"}


def test_unsettled_rounds_are_an_error(spark):
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(9)], "src string, dst string, links long")
    seeds = spark.createDataFrame([("h9", 0.0, 1.0)], "host string, good double, bad double")
    with pytest.raises(RuntimeError, match="8 rounds"):
        U.propagate(edges, seeds, rounds=None, max_rounds=8)
    got = {r.host: r.distrust for r in U.propagate(edges, seeds, rounds=None).collect()}
    assert len(got) == 10 and abs(got["h0"] - 0.15 * 0.85 ** 9) < 1e-12


def test_links_that_name_a_host(spark):
    html = ('<a href="//one.test/x"><a href=//one.test><a HREF=\'HTTPS://Two.test/y\'><a href="/login?next=https://bad.net">'
            '<a href="page?u=http://bad.net/"><a href="#http://bad.net"><a href="svn+ssh://three.test"><a href="/x//bad.net">')
    df = spark.createDataFrame([(1, "http://here.test/", html, "c", "c")], SCHEMA)
    assert sorted(map(tuple, U.host_edges(df).collect())) == [
        ("here.test", "one.test", 2), ("here.test", "three.test", 1), ("here.test", "two.test", 1)]


def test_planted_links(spark):
    """600 pages of 45 hosts with links planted in every form."""
    rng = np.random.default_rng(3)
    hosts = [f"h{i}.test" for i in range(35)] + [f"bad{i}.net" for i in range(4)] + [f"g{i}.org" for i in range(6)]
    forms = ['<a href="http://{}/fr/p">', "<A HREF='//{}/fr/'>", "<link href=https://{}/fr/q?x=//none.test rel=x>",
             '<a href="/login?next=http://{}/fr/">', '<a href="./{}/">']
    data, edges = [], defaultdict(int)
    for i in range(600):
        a = hosts[i % len(hosts)]
        html = []
        for j, k in zip(rng.integers(0, len(hosts), 4), rng.integers(0, len(forms), 4)):
            # bad hosts are linked to rarely and link nowhere good
            if (".net" in hosts[j] and j % 4 != i % 11) or (".org" in hosts[j] and ".net" in a):
                continue
            html.append(forms[k].format(hosts[j]))
            if k < 3 and hosts[j] != a:
                edges[a, hosts[j]] += 1
        data.append((i, f"https://{a}/fr/{i}", "<p>\n".join(html), "c", "c"))
    def node(h):
        return h + "/fr/" if h.endswith(".org") else h
    edges = {(node(a), node(b)): n for (a, b), n in edges.items()}
    want = exact(edges, {node(h) for h in hosts if h.endswith(".org")}, {h for h in hosts if h.endswith(".net")})
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert {(r.src, r.dst): r.links for r in U.host_edges(df, sections=True).collect()} == edges
    got = U.judge_urls(df, rounds=None, sections=True).collect()
    assert len(got) == 600
    for r in got:
        t, d = want[node(r.host)]
        assert abs(r.trust - t) <= 1e-7 * t and abs(r.distrust - d) <= 1e-7 * d
        if r.rule is None:
            assert r.verdict == ("block" if d > 0 and d >= U.THRESHOLD * (t + d) else "allow")
    assert {r.verdict for r in got if r.rule is None} == {"block", "allow"}
