"""URL filters by link-graph propagation.

Rules are a list of (verdict, host suffix, path prefix).  Every url gets the
longest rule that fits.  Hosts that no rule settles are judged by their links:

* host edges come from the links in the pages (href attributes) that name a
  host, by ``scheme://`` or ``//`` at their start, aggregated per (source host,
  target host) before anything shuffles on;
* trust is a personalised PageRank from trusted hosts along the links;
* distrust is the same from blocked hosts along the reversed links, so that
  who links to a blocked host gets a share of its distrust;
* a host is blocked if its distrust, as a share of trust plus distrust,
  reaches ``threshold``; a host that neither reaches is allowed.

Seeds are the nodes with pages that a rule allows or blocks.  With ``sections``
a path-scoped rule makes a node of its own of the part of a host that it
governs, and links go from and to the node of their url: the rule seeds that
part alone, and the other pages of the host are judged as a host of their own.
Without it the node of every page is its host.  Links within a host are no
edges either way.

The iteration stops after ``rounds``, or with ``rounds=None`` once every
host's trust and distrust have settled, however long the chain of links that
leads to it: what is still on its way shrinks by the damping each round, so
that comes to an end, and there is no bound on the rounds unless
``max_rounds`` is given.  Shares below the smallest double (some 4000 links
away at a damping of 0.85) count as none.  The state is written to the shared folder each few rounds, so lineage stays
short.

A null url, or one without ``://``, has an empty host and path and, as no link
reaches the empty host, is allowed.  Null html has no links.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
ROUNDS = 12
TOLERANCE = 1e-9            # of a host's own value, without a fixed number of rounds
THRESHOLD = 0.5


def url_parts(url) -> tuple:
    """(host, path) columns of a url column."""
    url = F.coalesce(url, F.lit(""))
    has = F.instr(url, "://") > 0
    after = F.when(has, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise("")
    host = C.ascii_lower(F.regexp_extract(after, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_columns(host, path, rules=RULES) -> tuple:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, suffix, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(suffix + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def node_of(host, path, rules=RULES, sections: bool = False):
    """Node of a url: its host, and with ``sections`` followed by the path
    prefix of the rule that governs it, if that rule has one."""
    if not sections:
        return host
    prefix = F.lit("")
    for _, suffix, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(start)
        prefix = F.when(fits, F.lit("" if start == "/" else start)).otherwise(prefix)
    return F.concat(host, prefix)


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html", rules=RULES,
               sections: bool = False) -> DataFrame:
    """(``src``, ``dst``, ``links``): nodes of distinct hosts linked by hrefs
    that start with ``scheme://`` or ``//``."""
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")),
                                 F.lit(r"""(?i)\bhref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""), F.lit(1))
    host, path = url_parts(F.col(url_col))
    link = F.col("link")
    to_host, to_path = url_parts(F.when(link.startswith("//"), F.concat(F.lit("http:"), link)).otherwise(link))
    return (pages.select(host.alias("host"), path.alias("path"), F.explode(links).alias("link"))
            .select("host", "path", to_host.alias("to_host"), to_path.alias("to_path"))
            .filter("host <> '' and to_host <> '' and host <> to_host")
            .groupBy(node_of(F.col("host"), F.col("path"), rules, sections).alias("src"),
                     node_of(F.col("to_host"), F.col("to_path"), rules, sections).alias("dst"))
            .agg(F.count(F.lit(1)).alias("links")))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = ROUNDS, damping: float = DAMPING,
              checkpoint_every: int = 4, tolerance: float = TOLERANCE, max_rounds: int | None = None) -> DataFrame:
    """(``host``, ``trust``, ``distrust``) for every host that either reaches.

    ``seeds``: (host, good, bad) with the shares of trust and distrust that
    start there; each sums to one over all hosts, or to zero.  Without
    ``rounds``, rounds go on until the last one changed no host's trust or
    distrust by more than ``tolerance`` of its own value (a host reached just
    then has changed by all of it); with ``max_rounds``, a ``RuntimeError`` if
    that many do not do.
    """
    out = edges.groupBy("src").agg(F.sum("links").alias("total")).withColumnRenamed("src", "s")
    back = edges.groupBy("dst").agg(F.sum("links").alias("total")).withColumnRenamed("dst", "d")
    forward = edges.join(out, F.col("src") == F.col("s")).select(
        F.col("src").alias("from"), F.col("dst").alias("to"), (F.col("links") / F.col("total")).alias("w"),
        F.lit("along").alias("way"))
    reverse = edges.join(back, F.col("dst") == F.col("d")).select(
        F.col("dst").alias("from"), F.col("src").alias("to"), (F.col("links") / F.col("total")).alias("w"),
        F.lit("against").alias("way"))
    # every host keeps what it has by a step to itself, so a round reads the state once
    hosts = reduce(DataFrame.union, [edges.select("src"), edges.select("dst"), seeds.select("host")]).distinct()
    stay = hosts.select(F.col("src").alias("from"), F.col("src").alias("to"), F.lit(1.0).alias("w"),
                        F.lit("stay").alias("way"))
    steps = C.materialize(forward.unionByName(reverse).unionByName(stay), "host-steps")
    begin = 1.0 if rounds == 0 else 1 - damping
    state = seeds.select("host", (begin * F.col("good")).alias("trust"), (begin * F.col("bad")).alias("distrust"))
    state = state.withColumns({"more_trust": F.col("trust"), "more_distrust": F.col("distrust")})
    i = 0
    while rounds is None or i < rounds:
        i += 1
        # with a fixed number of rounds the last one passes on all that is left
        rate = damping / (1 - damping) if i == rounds else damping

        def over(way, share):
            return F.when(F.col("way") == way, F.col("w") * share).otherwise(0.0)

        moved = steps.join(state, steps["from"] == state["host"]).select(
            F.col("to").alias("host"), over("stay", F.col("trust")).alias("trust"),
            over("stay", F.col("distrust")).alias("distrust"),
            over("along", F.col("more_trust") * rate).alias("more_trust"),
            over("against", F.col("more_distrust") * rate).alias("more_distrust"))
        state = moved.groupBy("host").agg(
            F.sum(F.col("trust") + F.col("more_trust")).alias("trust"),
            F.sum(F.col("distrust") + F.col("more_distrust")).alias("distrust"),
            F.sum("more_trust").alias("more_trust"), F.sum("more_distrust").alias("more_distrust"))
        if i % checkpoint_every == 0 or i in (rounds, max_rounds):
            state = C.materialize(state, "host-trust")
            if rounds is None and _change(state) <= tolerance:
                break
        if rounds is None and i == max_rounds:
            raise RuntimeError(f"trust and distrust still change after {max_rounds} rounds")
    return state.select("host", "trust", "distrust")


def _change(state: DataFrame) -> float:
    """Largest share of a host's trust or distrust that its last round added."""
    def share(more, of):
        return F.when(F.col(of) > 0, F.col(more) / F.col(of)).otherwise(0.0)

    row = state.agg(F.max(F.greatest(share("more_trust", "trust"), share("more_distrust", "distrust")))).first()
    return row[0] or 0.0


def judge_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, rounds: int | None = ROUNDS,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               sections: bool = False) -> DataFrame:
    """id, ``host``, ``path``, ``rule``, ``verdict``, ``trust``, ``distrust``
    for every page; trust and distrust are those of its node."""
    host, path = url_parts(F.col(url_col))
    parted = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    ruled = parted.withColumns({"rule": rule, "ruled": verdict,
                                "__node": node_of(F.col("host"), F.col("path"), rules, sections)})

    edges = C.materialize(host_edges(pages, url_col, html_col, rules, sections), "host-edges")
    marked = (ruled.filter("ruled is not null and host <> ''").groupBy(F.col("__node").alias("host"))
              .agg(F.max((F.col("ruled") == "allow").cast("int")).alias("a"),
                   F.max((F.col("ruled") == "block").cast("int")).alias("b")))
    marked = C.materialize(marked, "host-seeds")
    # a node that rules both allow and block seeds neither side
    seeds = marked.select("host", (F.col("a") * (1 - F.col("b"))).alias("good"),
                          (F.col("b") * (1 - F.col("a"))).alias("bad"))
    sums = seeds.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).first()
    seeds = seeds.select("host", (F.col("good") / F.lit(float(sums["g"] or 1))).alias("good"),
                         (F.col("bad") / F.lit(float(sums["b"] or 1))).alias("bad"))
    trust = propagate(edges, seeds, rounds).withColumnRenamed("host", "h")
    judged = ruled.join(trust, F.col("__node") == F.col("h"), "left")
    t, d = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_links = F.when((d > 0) & (d >= threshold * (t + d)), "block").otherwise("allow")
    return judged.select(id_col, "host", "path", "rule", F.coalesce("ruled", by_links).alias("verdict"),
                         t.alias("trust"), d.alias("distrust"))
