"""URL filter: host/path rules, and trust spread over the link graph for hosts without one.

Hosts are nodes, a link from a page of one host to another host is an edge. Personalised
PageRank runs twice: trust starts at hosts with allowed pages and follows the links; distrust
starts at hosts with blocked pages and follows them backwards (who links to a bad host is
suspect). A host is blocked when its distrust outweighs its trust.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import lower_ascii, written

#: (action, host, path); a rule's name is host + path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
DAMPING = 0.85
#: Rank still on its way, of 1 in all, at which the propagation has settled.
TOLERANCE = 1e-6
#: A host is blocked if its distrust is above this share of trust plus distrust.
DISTRUST_SHARE = 0.5


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, action) of the longest rule that fits; null if none does.

    A rule fits its host and all subdomains when the path starts with the rule's path. Among
    rules of one length the order of ``rules`` decides.
    """
    fit = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        on_host = (host == rule_host) | host.endswith("." + rule_host)
        fit = F.when(on_host & path.startswith(rule_path),
                     F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))).otherwise(fit)
    return fit


def host_links(pages: DataFrame) -> DataFrame:
    """Edges ``(src, dst, weight)`` between different hosts; the weights of a host's links sum to 1.

    Links are the absolute ``href`` targets of the whole page.
    """
    target = F.explode(F.expr(r"regexp_extract_all(html, '(?i)href\\s*=\\s*[\"\']?\\s*([a-z][a-z0-9+.-]*://[^\"\'\\s>]*)', 1)"))
    # counts and totals are written, so that the join stands alone and a hub's links can be split
    counts = pages.select("host", target.alias("to")).select(F.col("host").alias("src"), host_of(F.col("to")).alias("dst")) \
        .filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "links")
    total = written(counts.groupBy("src").agg(F.sum("n").alias("all")), "link-totals")
    return counts.join(total, "src").select("src", "dst", (F.col("n") / F.col("all")).alias("weight"))


def pagerank(edges: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank ``(host, rank)`` from ``seeds (host, seed)``, whose seeds sum to 1.

    A host passes ``damping`` of the rank that reaches it on along its links; rank at hosts without
    links goes nowhere. Each round moves on only what the last one brought. The rounds end when a round reached no
    new host and brought no more than ``tolerance`` in all, so every host on any path from a
    seed has its rank, however long the path; what is still on its way then is less than
    ``tolerance * damping / (1 - damping)``. Hosts that no seed reaches have no row.
    """
    sent = rank = written(seeds.select("host", (F.col("seed") * (1 - damping)).alias("rank")), "rank")
    hosts = rank.count()
    while hosts:
        sent = written(sent.join(edges, sent["host"] == edges["src"]).groupBy(F.col("dst").alias("host"))
                       .agg(F.sum(F.col("rank") * F.col("weight") * damping).alias("rank")), "sent")
        rank = written(rank.union(sent).groupBy("host").agg(F.sum("rank").alias("rank")), "rank")
        moved, before, hosts = sent.agg(F.sum("rank")).first()[0] or 0.0, hosts, rank.count()
        if hosts == before and moved <= tolerance:
            break
    return rank


def _seeds(hosts: DataFrame, action: str) -> DataFrame:
    own = hosts.select("host", F.col(action).alias("n")).filter("n > 0")
    total = own.agg(F.sum("n").alias("all"))
    count = total.first()["all"] or 1
    return own.select("host", (F.col("n") / F.lit(float(count))).alias("seed"))


def host_scores(judged: DataFrame) -> DataFrame:
    """``(host, trust, distrust)`` for each host that a seed reaches, from pages with ``host, action, html``."""
    hosts = judged.groupBy("host").agg(F.count_if(F.col("action") == "allow").alias("allow"),
                                       F.count_if(F.col("action") == "block").alias("block"))
    hosts = written(hosts.filter("host <> '' and (allow > 0 or block > 0)"), "hosts")
    edges = written(host_links(judged), "edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    out = written(back.groupBy("src").agg(F.sum("weight").alias("all")), "link-totals")
    back = written(back.join(out, "src").select("src", "dst", (F.col("weight") / F.col("all")).alias("weight")), "edges")
    trust = pagerank(edges, _seeds(hosts, "allow")).withColumnRenamed("rank", "trust")
    distrust = pagerank(back, _seeds(hosts, "block")).withColumnRenamed("rank", "distrust")
    return trust.join(distrust, "host", "full_outer").na.fill(0.0, ["trust", "distrust"])


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, share: float = DISTRUST_SHARE) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, trust, distrust``.

    The rule's verdict holds where one fits. Else the page's host decides: ``block`` if its
    distrust is above ``share`` of trust plus distrust, ``allow`` otherwise, also for hosts
    that no seed reaches and for null or malformed urls (empty host). Null html has no links.
    Repeated pages are judged alike, one row each; other columns are ignored.
    """
    parts = pages.select("page_id", "html", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = parts.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)) \
        .select("page_id", "html", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.action").alias("action"))
    scores = host_scores(judged)
    known = judged.drop("html").join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    bad = F.col("distrust") > share * (F.col("trust") + F.col("distrust"))
    return known.select("page_id", "host", "path", "rule",
                        F.coalesce("action", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                        "trust", "distrust")
