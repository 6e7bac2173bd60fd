"""URL filters: host and path rules, and link-graph propagation for pages no rule decides.

Rules fit a host and its subdomains where the path starts with the rule's; the
longest wins. For the rest, trust is a personalised PageRank from the hosts of
allowed pages over links between hosts, and distrust one from the hosts of
blocked pages over the reversed links (Gyongyi et al., "Combating Web Spam with
TrustRank", 2004, and its reverse). Either is set against the same rank from all
pages (Gyongyi et al., "Link Spam Detection Based on Mass Estimation", 2006):
the share of a host's rank that stems from allowed, or blocked, pages. A host's
own pages that no rule blocks so speak for it, and shares don't depend on how
large the table is. What share is much is read off the data: the expected trust
and distrust are the shares of all hosts together that have pages no rule
decides. A host is blocked if its distrust is more than ``LIFT`` times the
expected one, and more times that than its trust is of the expected trust; all
else is allowed. Repeating the whole table changes no verdict.

Links between hosts are the absolute ``href``s of the pages, weighted by how
many pages have them, and a subdomain is linked with its parent domain (and
back), as a site is with its parts, where both have pages. Links are counted per host pair before any
iteration, with partial sums before each shuffle, so neither a host with a third
of all pages nor one that a third of all pages link to gathers rows in a task.
Ranks are written to the shared folder after every round, until no kind of rank
changes by more than ``TOLERANCE`` of its mass.

Cases: a null url, or one without ``://``, has an empty host and path, fits no
rule and is allowed. Null html has no links. Repeated rows are judged alike and
count as often as they occur. Without any blocked or allowed seed the
propagation has no mass and allows. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import Scratch

# --- fixed values: (verdict, host, path) ---
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
DAMPING = 0.85
TOLERANCE = 1e-4
ROUNDS = 100        # at most; the change of a round is 2 * DAMPING ** rounds or less, under TOLERANCE after 61
LIFT = 2.0          # times the expected distrust that blocks a host
PARENT_WEIGHT = 1.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    u = F.coalesce(url.cast("string"), F.lit(""))
    return F.when(F.contains(u, F.lit("://")), F.substring(u, F.instr(u, "://") + 3, F.length(u))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _by_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):      # longer ones come later and win
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(src, dst, w): links between different hosts."""
    p = pages.select(host_of(F.col(f"`{url_col}`")).alias("src"), F.col(f"`{html_col}`").cast("string").alias("html"))
    href = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"(?i)href\s*=\s*[\"']?([a-z][a-z0-9+.-]*://[^\"'\s>]*)"), F.lit(1))
    found = p.select("src", F.explode(F.array_distinct(F.transform(href, host_of))).alias("dst"))
    links = (found.filter("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst")
             .agg(F.count(F.lit(1)).cast("double").alias("w")))
    hosts = p.select("src").filter("src <> ''").distinct()
    parent = F.regexp_extract("src", r"^[^.]+\.(.+\..+)$", 1)
    up = hosts.select("src", parent.alias("dst")).filter("dst <> ''").join(hosts.select(F.col("src").alias("dst")), "dst", "left_semi").select("src", "dst")
    tied = up.union(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).withColumn("w", F.lit(PARENT_WEIGHT))
    return links.union(tied).groupBy("src", "dst").agg(F.sum("w").alias("w"))


def propagate(links: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int = ROUNDS, damping: float = DAMPING,
              tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, rank) from (src, dst, w) links and (kind, host, w) seeds.

    'trust' and 'all_trust' flow along links, 'distrust' and 'all_distrust' against them.
    """
    mass = seeds.groupBy("kind").agg(F.sum("w").alias("total"))
    seed = scratch.write(seeds.join(F.broadcast(mass), "kind").filter("total > 0")        # two rows
                         .select("kind", "host", (F.col("w") / F.col("total")).alias("seed")), "seeds")
    along = links.select(F.explode(F.array(F.lit("trust"), F.lit("all_trust"))).alias("kind"), "src", "dst", "w")
    against = links.select(F.explode(F.array(F.lit("distrust"), F.lit("all_distrust"))).alias("kind"),
                           F.col("dst").alias("src"), F.col("src").alias("dst"), "w")
    both = along.unionByName(against)
    out = both.groupBy("kind", "src").agg(F.sum("w").alias("all_w"))
    step = scratch.write(both.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("w") / F.col("all_w")).alias("p")), "steps")
    rank = seed.select("kind", "host", F.col("seed").alias("rank"))
    last = None
    for done in range(rounds):
        flow = (rank.join(step, ["kind", "host"]).groupBy("kind", F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("p")).alias("flow")))
        nxt = (flow.join(seed, ["kind", "host"], "full").select(
            "kind", "host", (F.coalesce("flow", F.lit(0.0)) * damping + F.coalesce("seed", F.lit(0.0)) * (1 - damping)).alias("rank")))
        new = scratch.write(nxt, "ranks")
        diff = (new.unionByName(rank.select("kind", "host", (-F.col("rank")).alias("rank"))).groupBy("kind", "host")
                .agg(F.abs(F.sum("rank")).alias("d")).groupBy("kind").agg(F.sum("d").alias("d")).agg(F.max("d")))
        still = done + 1 < rounds and (diff.first()[0] or 0.0) > tolerance
        if last is not None:
            scratch.drop(last)
        rank = last = new
        if not still:
            break
    return rank


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", rules=None) -> DataFrame:
    """One row per input row: (id, host, path, rule, verdict, trust, distrust); the last two are shares of the host's rank."""
    rules = RULES if rules is None else rules
    scratch = Scratch(pages.sparkSession, "urls")
    u = F.col(f"`{url_col}`")
    base = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(u).alias("host"), path_of(u).alias("path"))
    name, verdict = _by_rule(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": name, "ruled": verdict})
    pages_of = base.filter("host <> ''").groupBy("host", "ruled").agg(F.count(F.lit(1)).cast("double").alias("w"))
    kinds = F.array(F.when(F.col("ruled") == "allow", "trust").when(F.col("ruled") == "block", "distrust"), F.lit("all_trust"), F.lit("all_distrust"))
    seeds = scratch.write(pages_of.select(F.explode(kinds).alias("kind"), "host", "w").filter("kind is not null")
                          .groupBy("kind", "host").agg(F.sum("w").alias("w")), "page-seeds")
    links = scratch.write(host_links(pages, url_col, html_col), "links")
    rank = propagate(links, seeds, scratch)
    mass = seeds.groupBy("kind").agg(F.sum("w").alias("mass"))                             # four rows
    pages_rank = rank.join(F.broadcast(mass), "kind").withColumn("r", F.col("rank") * F.col("mass"))
    names = ("trust", "all_trust", "distrust", "all_distrust")
    sums = scratch.write(pages_rank.groupBy("host").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("r"))), F.lit(0.0)).alias(k) for k in names]), "host-ranks")
    is_open = base.filter("ruled is null and host <> ''").select("host").distinct()
    total = sums.join(is_open, "host", "left_semi").agg(*[F.sum(k).alias(k) for k in names]).first()
    # without any seed nothing is expected, and nothing can exceed it
    usual = {k: (total[k] or 0.0) / total["all_" + k] if total["all_" + k] else 0.0 for k in ("trust", "distrust")}
    per = sums.select("host", *[F.try_divide(k, "all_" + k).alias(k) for k in ("trust", "distrust")])
    out = base.join(per, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    more = F.lit(usual["distrust"]) * trust < F.lit(usual["trust"]) * distrust if usual["trust"] else distrust > 0
    method = F.when((distrust > LIFT * usual["distrust"]) & more, "block").otherwise("allow")
    return out.select("id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
