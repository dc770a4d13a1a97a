"""URL filters by rules and by trust that spreads over the graph of hosts.

A url is judged by the longest rule that fits it. Where none fits, its host decides: trust
starts from the hosts whose pages the rules allow and follows the links (personalised
PageRank); distrust starts from the hosts whose pages they block and follows the links
backwards, as linking to blocked hosts speaks against a host. A host's pages are blocked when
its distrust exceeds its trust by more than the threshold. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.skew import hot_join
from wordloom.session import staged

#: (verdict, host and start of the path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Share of a score that comes over links, what may be still to come at the end, threshold.
DAMPING = 0.85
SETTLED = 1e-6
THRESHOLD = 0.5
#: Steps that the check SQL writes out; spread_trust takes as many as the verdicts need.
STEPS = 12
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINKED_URL = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>][^"'\s>]*)"""
#: The same without the path, for the check SQL.
LINK = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _fits(rule: str) -> Column:
    domain, slash, path = rule.partition("/")
    host = F.col("host")
    return ((host == domain) | host.endswith(f".{domain}")) & F.col("path").startswith(slash + path)


def with_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, the longest rule that fits and what it says (null where none does)."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, said = _judged(rules)
    return parsed.select("*", rule.alias("rule"), said.alias("said"))


def _judged(rules) -> tuple[Column, Column]:
    """The longest rule that fits ``host`` and ``path``, and what it says."""
    rule = said = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        rule, said = F.when(_fits(text), text).otherwise(rule), F.when(_fits(text), verdict).otherwise(said)
    return rule, said


def linked_urls(pages: DataFrame) -> DataFrame:
    """source and the different ``urls`` (host, path) that a page links to, of pages that link."""
    urls = F.transform(F.regexp_extract_all("html", F.lit(LINKED_URL), F.lit(1)), lambda u: F.concat(F.lit("http://"), u))
    # As one string each, which are told apart in linear time; a host has no slash and a path begins with one.
    joined = pages.select(host_of(F.col("url")).alias("source"), F.array_distinct(
        F.transform(urls, lambda u: F.concat(host_of(u), path_of(u)))).alias("urls")).where(F.size("urls") > 0)

    def parts(url: Column) -> Column:
        host = F.substring_index(url, "/", 1)
        return F.struct(host.alias("host"), F.substr(url, F.char_length(host) + 1).alias("path"))

    return joined.select("source", F.transform("urls", parts).alias("urls"))


def host_seeds(ruled: DataFrame, linked: DataFrame, rules=RULES) -> DataFrame:
    """Each host's pages and the shares of them that the rules allow and block.

    A linked host without pages has the shares of the different urls of it that are linked.
    """
    share = lambda said: F.avg(F.when(F.col("said") == said, 1.0).otherwise(0.0))
    shares = share("allow").alias("allowed"), share("block").alias("blocked")
    crawled = staged(ruled.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), *shares), "crawled")
    urls = linked.select(F.explode("urls").alias("u")).select("u.host", "u.path").distinct()
    judged = urls.join(crawled, "host", "left_anti").select("host", _judged(rules)[1].alias("said"))
    others = judged.groupBy("host").agg(F.lit(0).cast("bigint").alias("pages"), *shares)
    return crawled.unionByName(others)


def host_edges(linked: DataFrame, hosts: DataFrame) -> DataFrame:
    """(source, target, links): links between hosts, and a host and its parent host if both are in the graph.

    Links within a host are left out. Targets without pages are hosts like others: what they
    take of the trust goes nowhere else, and those that the rules block send distrust back.
    """
    targets = F.array_distinct(F.transform("urls", lambda u: u["host"]))
    links = linked.select("source", F.explode(targets).alias("target"))
    links = links.where("source != target").groupBy("source", "target").agg(F.count(F.lit(1)).alias("links"))
    named = hosts.select("host")
    known = named.withColumnRenamed("host", "target")
    up = named.select(F.col("host").alias("source"), F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("target"))
    up = up.join(known, "target").select("source", "target")
    family = up.unionByName(up.select(F.col("target").alias("source"), F.col("source").alias("target")))
    edges = links.select("source", "target", "links").unionByName(family.withColumn("links", F.lit(1).cast("bigint")))
    return edges.groupBy("source", "target").agg(F.sum("links").alias("links"))


def _flows(edges: DataFrame) -> DataFrame:
    """(sender, receiver, trust, distrust): what part of its scores a host passes on to another.

    Trust goes along the links in proportion to them, distrust against them.
    """
    total = lambda side, name: edges.groupBy(side).agg(F.sum("links").alias(name))
    both = edges.join(total("source", "out"), "source").join(total("target", "into"), "target")
    zero = F.lit(0.0)
    along = both.select(F.col("source").alias("sender"), F.col("target").alias("receiver"),
                        (F.col("links") / F.col("out")).alias("trust"), zero.alias("distrust"))
    against = both.select(F.col("target").alias("sender"), F.col("source").alias("receiver"),
                          zero.alias("trust"), (F.col("links") / F.col("into")).alias("distrust"))
    return along.unionByName(against)


def _settled(scores: DataFrame) -> bool:
    """Whether what is still to come can move no verdict, or is less than SETTLED over all hosts.

    Scores only grow, and a step's growth over all hosts is at most DAMPING times that of the
    step before, which bounds the rest by a geometric series.
    """
    over = F.col("distrust") - F.col("trust") - THRESHOLD * (1 - DAMPING)
    found = scores.agg(
        F.sum("more_trust").alias("t"), F.sum("more_distrust").alias("d"),
        F.min(F.when(over > 0, over)).alias("block"), F.min(F.when(over <= 0, -over)).alias("allow")).first()
    trust, distrust = ((found[c] or 0.0) * DAMPING / (1 - DAMPING) for c in "td")
    safe = (found["block"] is None or found["block"] > trust) and (found["allow"] is None or found["allow"] >= distrust)
    return safe or trust + distrust < SETTLED


def spread_trust(hosts: DataFrame, edges: DataFrame) -> DataFrame:
    """host, pages, trust and distrust, propagated until no verdict moves; both tables should be stored.

    Every step joins the growth of the step before to the edges and adds it up by receiver, and is
    written to the shared folder, so that a lost executor costs one step and plans stay short.
    """
    flows = staged(_flows(edges), "flows")
    first = 1 - DAMPING
    trust, distrust = first * F.col("allowed"), first * F.col("blocked")
    scores = hosts.select("host", "pages", trust.alias("trust"), distrust.alias("distrust"),
                          trust.alias("more_trust"), distrust.alias("more_distrust"))
    while True:
        grown = scores.where("more_trust > 0 OR more_distrust > 0").select(
            F.col("host").alias("sender"), F.col("more_trust").alias("t"), F.col("more_distrust").alias("d"))
        sent = flows.join(grown, "sender").groupBy("receiver").agg(
            F.sum(F.col("trust") * F.col("t")).alias("t"), F.sum(F.col("distrust") * F.col("d")).alias("d"))
        joined = scores.join(sent, scores["host"] == sent["receiver"], "left")
        t, d = (DAMPING * F.coalesce(F.col(c), F.lit(0.0)) for c in "td")
        scores = staged(joined.select("host", "pages", (F.col("trust") + t).alias("trust"), (F.col("distrust") + d).alias("distrust"),
                                      t.alias("more_trust"), d.alias("more_distrust")), "trust")
        if _settled(scores):
            return scores


def host_verdict() -> Column:
    """Scores are in units of a host's own seed, so an unlinked host is judged by its pages' shares."""
    return F.when((F.col("distrust") - F.col("trust")) / (1 - DAMPING) > THRESHOLD, "block").otherwise("allow")


def judge_pages(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule and verdict.

    Hosts that are only linked to are judged by the rules and take part in the propagation.
    A null url, or one without ``://``, has an empty host and path, fits no rule, and shares the
    verdict of the empty host; a null html has no links. Repeated rows each count and stay; an
    empty table gives none; other columns are not read. Pages of a host with a large share
    of all rows are spread over many tasks when they meet its verdict.
    """
    ruled = staged(with_rules(pages, rules), "ruled")
    linked = staged(linked_urls(pages), "linked")
    hosts = staged(host_seeds(ruled, linked, rules), "hosts")
    scores = spread_trust(hosts, staged(host_edges(linked, hosts), "edges"))
    verdicts = staged(scores.where("pages > 0").select("host", "pages", host_verdict().alias("of_host")), "verdicts")
    judged = hot_join(ruled, verdicts, "host", "pages", "page_id")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("said", "of_host").alias("verdict"))
