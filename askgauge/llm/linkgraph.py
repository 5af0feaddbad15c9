"""URL verdicts from rules and from trust that flows over the link graph between hosts.

Rules decide the urls they fit. For the rest, trust starts at hosts with allowed pages and follows
links, distrust starts at hosts with blocked pages and follows them backwards (who links to bad hosts
is suspect). Both are personalised PageRank vectors in units of pages, found by repeated joins of the
host edges; a host whose distrust exceeds its trust by enough of its pages is blocked.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from askgauge.llm.common import lower_ascii, written

DAMPING = 0.85
THRESHOLD = 0.5
TOLERANCE = 1e-6  # pages
# Links that name a host; all others stay on the page's own host and tell nothing about another.
HOST_LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^\s/?#\"'<>]+)"


@dataclass(frozen=True)
class Rule:
    """A host, with all its subdomains, and the start of a path."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


RULES = (Rule("net/", False), Rule("example.net/en/", True), Rule("example.com/de/", False), Rule("org/fr/", True))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host in ASCII lower case and path of a url; both empty without ``://`` or for a null url."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"\A[^?#]*", 0)
    known = F.coalesce(at > 0, F.lit(False))
    return F.when(known, lower_ascii(host)).otherwise(""), F.when(known, path).otherwise("")


def first_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """Text and verdict (true: allow) of the longest rule that fits; null if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    text, allow = F.when(F.lit(False), ""), F.when(F.lit(False), True)
    for r in ordered:
        text, allow = text.when(r.fits(host, path), r.text), allow.when(r.fits(host, path), r.allow)
    return text, allow


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """(src, dst, n): pages of ``src`` that link to another host ``dst``; counted before the shuffle."""
    # The port and any user name in a link are no part of the host.
    named = F.transform(
        F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(HOST_LINK), 1),
        lambda h: F.regexp_replace(F.regexp_replace(lower_ascii(h), "^.*@", ""), ":[0-9]*$", ""),
    )
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(named)).alias("dst"))
    real = links.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return real.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = TOLERANCE
) -> DataFrame:
    """(host, trust, distrust): the seeds' masses and all that reaches a host over the edges.

    ``edges`` are (src, dst, n), ``seeds`` (host, trust, distrust). Mass splits over a host's links by
    n, loses ``1 - damping`` at each step, and is summed until a step moves at most ``tolerance`` pages
    in all, so whatever the seeds' mass no host lacks more than ``tolerance / (1 - damping)``. Only
    given ``rounds`` end the paths at so many links. Each step is one join and one sum over host edges,
    written before the next; hosts never reach the driver.
    """
    forward = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("at"), F.col("dst").alias("to"), "n")
    backward = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("at"), F.col("src").alias("to"), "n")
    arcs = forward.unionByName(backward)
    # A grouped sum joined back, not a window: a host with very many links is not held by one task.
    sums = arcs.groupBy("kind", "at").agg(F.sum("n").alias("all"))
    shares = arcs.join(sums, ["kind", "at"]).select("kind", "at", "to", (F.col("n") / F.col("all")).alias("share"))
    shares = written(shares, "linkgraph-arcs")
    kinds = F.explode(
        F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).cast("double").alias("mass")) for k in ("trust", "distrust")))
    )
    seeded = seeds.select("host", kinds.alias("s")).select("s.kind", "host", "s.mass").where("mass > 0")
    moving = total = written(seeded, "linkgraph-seeds")
    mass = total.agg(F.coalesce(F.sum("mass"), F.lit(0.0))).first()[0]
    if rounds is None:  # after these the mass is below the tolerance even if none of it has got lost
        rounds = max(0, math.ceil(math.log(tolerance / mass) / math.log(damping))) if mass else 0
    for _ in range(rounds):
        flow = moving.withColumnRenamed("host", "at").join(shares, ["kind", "at"])
        moved = flow.groupBy("kind", F.col("to").alias("host")).agg(
            (damping * F.sum(F.col("mass") * F.col("share"))).alias("mass")
        )
        moving = written(moved, "linkgraph-moving")
        if moving.agg(F.coalesce(F.sum("mass"), F.lit(0.0))).first()[0] <= tolerance:
            break
        total = written(
            total.unionByName(moving).groupBy("kind", "host").agg(F.sum("mass").alias("mass")), "linkgraph-total"
        )

    def of(kind):
        return F.sum(F.when(F.col("kind") == kind, F.col("mass")).otherwise(0.0)).alias(kind)

    return total.groupBy("host").agg(of("trust"), of("distrust"))


def judge(
    pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, damping: float = DAMPING, rounds: int | None = None
) -> DataFrame:
    """``page_id``, host, path, rule, verdict, and the host's trust and distrust per page.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is allowed, as is
    any url of a host that nothing is known about. Null html has no links. Repeated rows count as
    pages of their own and come back as often as they came. Other columns are not looked at.
    """
    host, path = split_url(F.col("url"))
    named = pages.select("page_id", "url", "html").select("page_id", host.alias("host"), path.alias("path"), "html")
    rule, allow = first_rule(F.col("host"), F.col("path"), rules)
    ruled = named.select("*", rule.alias("rule"), allow.alias("allow"))
    sites = ruled.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if("allow").alias("trust"), F.count_if(~F.col("allow")).alias("distrust")
    )
    sites = written(sites, "linkgraph-hosts")
    edges = written(host_edges(named), "linkgraph-edges")
    reached = propagate(edges, sites.select("host", "trust", "distrust"), damping, rounds)
    zero = F.lit(0.0)
    per_page = sites.select("host", "pages").join(reached, "host", "left").select(
        F.col("host").alias("__host"),
        (F.coalesce("trust", zero) / F.col("pages")).alias("host_trust"),
        (F.coalesce("distrust", zero) / F.col("pages")).alias("host_distrust"),
    )
    # One row per host, read back as files: broadcast by their size, joined by shuffle beyond it.
    known = written(per_page, "linkgraph-scores")
    joined = ruled.drop("html").join(known, F.col("host") == F.col("__host"), "left")
    suspect = F.coalesce(F.col("host_distrust") - F.col("host_trust") > threshold, F.lit(False))
    allowed = F.coalesce("allow", ~suspect)
    return joined.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(allowed, "allow").otherwise("block").alias("verdict"),
        F.coalesce("host_trust", zero).alias("host_trust"),
        F.coalesce("host_distrust", zero).alias("host_distrust"),
    )
