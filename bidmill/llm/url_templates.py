"""URL filters over a tree of path templates, with DataFrame functions only.

Rules (host, path, verdict) label the URLs they fit. For the others, every
host's paths form a tree of segments, built level by level from counts of
distinct paths:

1. generalise: a child segment without labelled URLs that holds less than
   ``MIN_SHARE`` of its parent's URLs, or fewer than ``MIN_ROWS`` of them, is
   variable and joins the parent's wildcard branch;
2. merge: all other children, labelled ones of any size among them, are
   compared with all their parent's URLs by a two-proportion test on the share
   of blocked and of allowed URLs; those that don't differ (|z| < ``Z``) join
   the wildcard branch as well;
3. so a template is a path of literal segments and wildcards. Past ``LEVELS``
   only templates that hold both blocked and other URLs with a further segment
   grow on, as deep as their paths go; segments past the others count as one
   tail, ``*``.

A template is rejected if its purity, the share of blocked among its URLs
smoothed by ``PRIOR`` URLs of which half are blocked, reaches ``PURITY``;
otherwise it is allowed. URLs without a label count as not blocked, so a few
blocked URLs don't reject the unlabelled ones that share their template.

Counts are pre-aggregated by (host, path) before each shuffle and kept branches
are joined from stored tables, so a host with a third of all pages is split.

Defined cases: a NULL URL, or one without ``://``, has an empty host and path;
its rule is NULL and its verdict the method's for that template; a URL that
several rules fit takes the longest, then the one with the longer host; repeated
URLs and page_ids are rows of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidmill.llm.store import discard, stored

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
         ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("net", "/fr/", "block"))
LEVELS = 4
MIN_SHARE, MIN_ROWS = 0.02, 5
Z = 2.58
PRIOR, PURITY = 4.0, 0.7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(size, host_size, rule, verdict) of the longest rule that fits."""
    fitting = [F.when((F.lit(True) if not h else (host == h) | host.endswith("." + h))
                      & path.startswith(p),
                      F.struct(F.lit(len(h) + len(p)).alias("size"), F.lit(len(h)).alias("host_size"),
                               F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
               for h, p, verdict in rules]
    return F.array_max(F.array(*fitting))


def segments(path: Column) -> Column:
    return F.split(F.regexp_replace(path, "^/", ""), "/")


def _differs(part: Column, n: Column, whole: Column, total: Column) -> Column:
    """Two-proportion test of a child against its parent's URLs."""
    share = whole / total
    spread = share * (1 - share) * (1 / n + 1 / total)
    return (spread > 0) & (F.abs(part / n - share) >= Z * F.sqrt(spread))


def templates(paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``paths``: host, path, n, blocked, allowed (distinct host and path).
    Adds ``template``."""
    now = (paths.withColumn("template", F.lit("")).withColumn("_seg", segments(F.col("path")))
           .withColumn("_depth", F.lit(0)))
    for level in count(1):
        now = now.withColumn("seg", F.get("_seg", F.lit(level - 1)))
        mixed = None
        if level > levels:
            mixed = stored(now.where("seg is not null").groupBy("host", "template").agg(
                F.sum("blocked").alias("b"), F.sum("n").alias("all")).where("b > 0 and b < all")
                .select("host", "template", F.lit(True).alias("mixed")), "url-mixed")
            if mixed.isEmpty():
                break
            now = now.join(mixed, ["host", "template"], "left").withColumn(
                "seg", F.when(F.col("mixed"), F.col("seg"))).drop("mixed")
        children = stored(now.where("seg is not null").groupBy("host", "template", "seg").agg(
            *[F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]), "url-children")
        parents = children.groupBy("host", "template").agg(
            *[F.sum(c).alias(f"all_{c}") for c in ("n", "blocked", "allowed")])
        parents = stored(parents, "url-parents")
        n, total = F.col("n"), F.col("all_n")
        labelled = F.col("blocked") + F.col("allowed") > 0
        literal = ((labelled | (n >= MIN_ROWS) & (n >= MIN_SHARE * total))
                   & (_differs(F.col("blocked"), n, F.col("all_blocked"), total)
                      | _differs(F.col("allowed"), n, F.col("all_allowed"), total)))
        keep = stored(children.join(parents, ["host", "template"]).where(literal)
                      .select("host", "template", "seg", F.lit(True).alias("literal")), "url-branches")
        after = now.join(keep, ["host", "template", "seg"], "left").withColumn(
            "template", F.when(F.col("seg").isNull(), F.col("template")).otherwise(F.concat(
                "template", F.lit("/"), F.when(F.col("literal"), F.col("seg")).otherwise(F.lit("*"))))).withColumn(
            "_depth", F.when(F.col("seg").isNull(), F.col("_depth")).otherwise(level))
        after = stored(after.drop("seg", "literal"), "url-paths")
        discard(children, parents, keep, now, *([mixed] if mixed else []))
        now = after
    return now.withColumn("template", F.when(
        F.size("_seg") > F.col("_depth"), F.concat("template", F.lit("/*")))
        .otherwise(F.col("template"))).drop("_seg", "_depth", "seg")


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          levels: int = LEVELS) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"),
                        path_of(url).alias("path"))
    counted = rows.groupBy("host", "path").agg(F.count("*").alias("n"))
    found = counted.withColumn("found", best_rule(F.col("host"), F.col("path"), rules))
    labelled = found.select(
        "host", "path", "n", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"),
        *[F.when(F.col("found.verdict") == v, F.col("n")).otherwise(0).alias(c)
          for v, c in (("block", "blocked"), ("allow", "allowed"))])
    named = templates(stored(labelled, "url-labelled"), levels)
    rated = stored(named.groupBy("host", "template").agg(
        F.sum("blocked").alias("b"), F.sum("n").alias("all")).select("host", "template", (
            (F.col("b") + PRIOR / 2) / (F.col("all") + PRIOR)).alias("purity")),
        "url-purity")
    verdicts = stored(named.join(rated, ["host", "template"]).select(
        "host", "path", "rule", F.coalesce("ruled", F.when(F.col("purity") >= PURITY, "block")
                                           .otherwise("allow")).alias("verdict"),
        "template", "purity"), "url-verdicts")
    discard(named, rated)
    return rows.join(verdicts, ["host", "path"]).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity")
