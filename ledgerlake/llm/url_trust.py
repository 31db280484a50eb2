"""Operator 5: URL filters by link-graph propagation (DataFrame functions only).

A page's URL is judged by the longest fixed rule that fits its host and path. Hosts of
pages that rules allow are trusted seeds, hosts of blocked pages distrusted ones, by
their pages. Over the host graph (links between different hosts, counted) trust
spreads along links as a personalised PageRank from the trusted seeds, and distrust
against them from the blocked seeds: who links to blocked hosts is distrusted. A page
that no rule fits is blocked if its host's distrust is ``ratio`` times its trust or
more (and not zero). Scores are rounded to 12 significant digits, so that the order of
sums does not show and no score is too small to count, however many pages there are.

Edges are summed per host pair before any join and scores per host, so a host with a
third of all pages is one row of either. Defined results: a null URL or one without
``://`` has an empty host and path, fits no rule and is no part of the graph; hosts
that no score reaches are allowed; links without a host and links to the own host are
no edges. Every row is judged, repeated page_ids too; other columns pass on.
"""

from __future__ import annotations



from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import small, stored

# Fixed values: (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]*)"""
# End of the fixed values.
ROUNDS, DAMPING, RATIO = 8, 0.85, 2.0


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from the pages of one host to another host."""
    to = F.explode(F.regexp_extract_all(F.coalesce(F.col("html"), F.lit("")), F.lit(LINK), F.lit(1)))
    return (pages.select("host", to.alias("dst")).select(F.col("host").alias("src"), F.translate("dst", UPPER, LOWER).alias("dst"))
            .filter("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n")))


def _digits(v: Column) -> Column:
    """``v`` rounded to 12 significant digits."""
    return F.format_string("%.11e", v).cast("double")


def host_scores(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust) after ``rounds`` rounds. seeds: host, good, bad (pages);
    both seed vectors are normalised to sum 1."""
    total = seeds.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    share = lambda c: F.coalesce(F.col(c) / F.nullif(F.col(f"all_{c}"), F.lit(0)), F.lit(0.0))
    one = total.select(F.col("good").alias("all_good"), F.col("bad").alias("all_bad"))
    ends = edges.select(F.col("src").alias("host")).union(edges.select(F.col("dst").alias("host"))).distinct()
    hosts = (seeds.join(ends, "host", "full_outer")
             .withColumns({"all_good": one.select("all_good").scalar(), "all_bad": one.select("all_bad").scalar()})
             .select("host", share("good").alias("t0"), share("bad").alias("d0")))
    hosts = stored(hosts, "hosts")
    out = edges.groupBy("src").agg(F.sum("n").alias("out"))
    into = edges.groupBy("dst").agg(F.sum("n").alias("into"))
    weighted = stored(edges.join(out, "src").join(into, "dst")
                      .select("src", "dst", (F.col("n") / F.col("out")).alias("w_out"), (F.col("n") / F.col("into")).alias("w_in")),
                      "weighted-edges")
    state = hosts.select("host", F.col("t0").alias("trust"), F.col("d0").alias("distrust"))
    for k in range(rounds):
        ahead = (weighted.join(state, F.col("src") == F.col("host"))
                 .select(F.col("dst").alias("host"), (F.col("trust") * F.col("w_out")).alias("t"), F.lit(0.0).alias("d")))
        back = (weighted.join(state, F.col("dst") == F.col("host"))
                .select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("w_in")).alias("d")))
        sums = ahead.union(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        mix = lambda seed, got: _digits((1 - damping) * F.col(seed) + damping * F.coalesce(got, F.lit(0.0)))
        state = hosts.join(sums, "host", "left").select("host", mix("t0", "t").alias("trust"), mix("d0", "d").alias("distrust"))
        if k % 4 == 3 or k + 1 == rounds:  # cut the lineage before it grows long
            state = stored(state, f"scores-{k}")
    return state


def judge_pages(pages: DataFrame, rules=RULES, rounds: int = ROUNDS, damping: float = DAMPING,
                ratio: float = RATIO) -> DataFrame:
    """``pages`` with host, path, rule, trust, distrust and verdict."""
    named = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = named.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    seeds = stored(ruled.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("_rule.verdict") == "allow").alias("good"),
        F.count_if(F.col("_rule.verdict") == "block").alias("bad")), "seeds")
    scores = small(host_scores(seeds, stored(host_edges(named), "edges"), rounds, damping))
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    own = F.when((distrust > 0) & (distrust >= ratio * trust), "block").otherwise("allow")
    return (ruled.drop("trust", "distrust").join(scores, "host", "left")
            .withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce("_rule.verdict", own),
                          "trust": trust, "distrust": distrust}).drop("_rule"))
