"""URL filters by a path-template tree.

Per host, the segments of paths are generalised where they vary by form (numbers, hexadecimal ids, long slugs), which
leaves a counted table of templates. The tree over it is pruned from the root on: at each depth, siblings whose rate
of bad labels does not differ from what all siblings under that node have are merged into a wildcard, the others
stay branches of their own. A merged template is rejected if the odds of its smoothed share of bad labels are ``lift`` times
those of all labels or more: the bound follows the data, whatever the overall share is. Rules for hosts and path prefixes come first.

Only counts are shuffled: pages are summed to templates before, and each round of branches is a grouping of the summed table.

Results of edge cases. A null url or one without ``://`` has an empty host and path. Labels of pages that do not occur are
ignored, and repeated labels of a page count once, as bad if one of them is. Rows that repeat a page_id, and rows whose
page_id is null, are each judged, the latter without a label. Without any label all that no rule blocks is allowed. An
empty table gives an empty result. Of rules of equal length the last listed wins. Paths of any depth are split whole.
Columns besides those named are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import written

#: Fixed values: (host, path prefix, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

#: Forms of segments, tried in order on the segment without its extension.
FORMS = ((r"^[0-9]+$", "{number}"), (r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$", "{date}"), (r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$", "{id}"), (r"^.{25,}$", "{slug}"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url):
    """Columns (host, path) of a url column."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def by_rules(host, path, rules=RULES):
    """Columns (rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is applied last
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def generalised(path):
    """The path's segments as an array, in which variable forms are placeholders."""

    def form(segment):
        stem = F.regexp_extract(segment, r"^(.*?)(\.[A-Za-z0-9]{1,5})?$", 1)
        tail = F.substring(segment, F.length(stem) + 1, F.length(segment))
        out = segment
        for pattern, name in reversed(FORMS):
            out = F.when(stem.rlike(pattern), F.concat(F.lit(name), tail)).otherwise(out)
        return out

    return F.transform(F.split(F.regexp_replace(path, "^/", ""), "/", -1), form)


def templates(pages: DataFrame, labels: DataFrame, alike: float = 2.0) -> DataFrame:
    """(host, parts, template, pages, labelled, bad): which merged template each generalised path of a host falls to.

    ``pages``: page_id, host, parts. ``labels``: page_id, bad (0 or 1). ``alike``: standard errors up to which a branch
    counts as like its siblings. A node's only child stays as it is. The tree goes to the full depth of paths: each round
    skips the segments that all paths under a node share, and leaves out nodes with one path, whose rest stays as it is,
    and nodes without labels, whose rest becomes one wildcard.
    """
    marks = labels.where("page_id is not null and bad in (0, 1)").groupBy("page_id").agg(F.max("bad").alias("bad"))
    marked = pages.select("page_id", "host", "parts").join(marks, "page_id", "left")
    tree = marked.groupBy("host", "parts").agg(F.count("*").alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = written(tree.withColumn("done", F.slice("parts", 1, 0)).withColumn("rest", F.col("parts")), "templates")
    ended = [tree.where("size(rest) = 0")]
    while not tree.isEmpty():
        under = tree.groupBy("host", "done").agg(F.count("*").alias("paths"), F.sum("labelled").alias("marks"), F.min("rest").alias("low"), F.max("rest").alias("high"))
        unlike = F.expr("cast(array_position(zip_with(low, high, (x, y) -> x <=> y), false) as int)")
        shared = under.select("host", "done", "paths", "marks", F.when(unlike > 0, unlike - 1).otherwise(F.size("low")).alias("shared"))
        skipped = F.when(F.col("paths") == 1, F.col("rest")).when(F.col("marks") == 0, F.array(F.lit("*"))).otherwise(F.slice("rest", F.lit(1), F.col("shared")))
        rest = F.slice("rest", F.when((F.col("paths") == 1) | (F.col("marks") == 0), F.size("rest")).otherwise(F.col("shared")) + 1, F.size("rest"))
        tree = tree.join(shared, ["host", "done"]).select("host", "parts", "pages", "labelled", "bad", F.concat("done", skipped).alias("done"), rest.alias("rest"))
        at = F.get("rest", F.lit(0))
        nodes = tree.where(at.isNotNull()).groupBy("host", "done", at.alias("segment")).agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
        above = nodes.groupBy("host", "done").agg(F.sum("n").alias("all_n"), F.sum("b").alias("all_b"), F.count("*").alias("children"))
        # The pooled rate with one bad and one good label added, so that it is never 0 or 1.
        rate = (F.col("all_b") + 1) / (F.col("all_n") + 2)
        differs = F.abs(F.col("b") - F.col("n") * rate) > alike * F.sqrt(F.col("n") * rate * (1 - rate))
        lone = F.col("children") == 1
        kept = nodes.join(above, ["host", "done"]).where(differs | lone).select("host", "done", "segment", F.lit(True).alias("own"))
        tree = tree.withColumn("segment", at).join(kept, ["host", "done", "segment"], "left")
        step = F.when(F.col("segment").isNull(), F.col("done")).otherwise(F.concat("done", F.array(F.when(F.col("own"), F.col("segment")).otherwise(F.lit("*")))))
        tree = written(tree.select("host", "parts", "pages", "labelled", "bad", step.alias("done"), F.slice("rest", F.lit(2), F.size("rest")).alias("rest")), "templates")
        ended.append(tree.where("size(rest) = 0"))
        tree = tree.where("size(rest) > 0")
    return reduce(DataFrame.union, ended).select("host", "parts", "pages", "labelled", "bad", F.array_join("done", "/").alias("template"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, weight: float = 8.0, lift: float = 1.5) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, template, purity (smoothed share of bad labels).

    ``weight``: labels that the overall share of bad ones counts for in the smoothing. ``lift``: how many times the overall
    odds of a bad label the odds of a template are that is blocked.
    """
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("parts", generalised(F.col("path")))
    tree = templates(split, labels)
    bad, labelled = tree.agg(F.sum("bad"), F.sum("labelled")).first()
    prior = ((bad or 0) + 1) / ((labelled or 0) + 2)
    bound = lift * prior / (1 - prior + lift * prior)
    sums = tree.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    purity = sums.select("host", "template", ((F.col("b") + weight * prior) / (F.col("n") + weight)).alias("purity"))
    known = tree.select("host", "parts", "template").join(purity, ["host", "template"])
    rule, verdict = by_rules(F.col("host"), F.col("path"), rules)
    judged = split.join(known, ["host", "parts"], "left")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("purity") >= bound, "block").otherwise("allow")).alias("verdict"), "template", "purity")
