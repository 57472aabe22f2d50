"""URL filter: a path-template tree per host, judged by smoothed labelled purity.

Urls become host and path segments. From the host down, a segment is generalised to a wildcard where
it varies: below one (host, template) node its value is one of many that each hold a small share, or
it consists mostly of digits. The distinct (host, template) nodes form a tree with counts and labels.

Below each node, siblings with like rates of good labels are merged: siblings with equal counts first,
then neighbours in the order of their rates whose difference is below ``z`` standard errors (pooled
two-proportion test). The subtrees of merged siblings are united, so that their children of one name
share their labels too; siblings without labels form one branch. A branch takes its purity from its
labels, smoothed towards its parent's purity, down from the root (all urls) over the host; templates
whose smoothed purity is below the threshold are rejected. Explicit rules stand above the verdict of
the tree.

A pass goes down from one branching to the next: the segments that all paths below a node share are
taken in one step (they are the common start of the least and the greatest path), and paths that
have ended leave the loop, so a path of hundreds of segments costs no more passes than a short one.

All passes work on aggregates of distinct values; a host with a third of all urls is combined before
each shuffle, and its tree is spread over its nodes. Only DataFrame functions are used.

Rows and edge cases: null urls and urls without ``://`` have an empty host and path and one node;
repeated rows are judged alike and count with their number. Without labels the verdict is allow.
Trees are as deep as the paths; with ``depth``, deeper paths end in one wildcard for all that
follows. Other columns of the
input are ignored by ``judge_urls``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.session import cut_lineage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``place`` is host and path prefix, as ``example.org/es/``; it holds for all subdomains."""

    place: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.place.partition("/")
        return ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    tail = F.substr(rest, F.length(host) + F.lit(1))
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(tail, r"^([^?#]*)", 1)


def rule_columns(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, compiled into one expression each."""
    name = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.place), r.place)):
        fits = rule.fits(host, path)
        name = F.when(fits, rule.place) if name is None else name.when(fits, rule.place)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _segments(path: Column, depth: int | None) -> Column:
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    if depth is None:
        return parts
    return F.when(F.size(parts) <= depth, parts).otherwise(
        F.concat(F.slice(parts, 1, depth), F.array(F.lit("**")))
    )


def _varies(segment: Column, n: Column, children: Column, total: Column, many: int, share: float) -> Column:
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{2,5}$", "")
    digits = F.length(F.regexp_replace(stem, "[^0-9]", ""))
    return (2 * digits > F.length(stem)) | ((children >= many) & (n < share * total))


def _shared(low: Column, high: Column) -> Column:
    """Segments that two paths share at their start; with the least and the greatest of a set, all do."""
    same = F.zip_with(low, high, lambda a, b: a.eqNullSafe(b))
    differ = F.array_position(same, False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(low)).cast("int")


def _rest(parts: Column, taken: Column) -> Column:
    return F.slice(parts, taken + 1, F.size(parts))


def path_templates(
    paths: DataFrame, depth: int | None = None, many: int = 12, share: float = 0.05
) -> DataFrame:
    """``paths`` (host, path, ...) with ``template``, an array of segments and wildcards."""
    active = cut_lineage(
        paths.groupBy("host", "path")
        .agg(F.count(F.lit(1)).alias("urls"))
        .withColumn("rest", _segments(F.col("path"), depth))
        .withColumn("template", F.array().cast("array<string>"))
    )
    one = F.lit(1)
    finished = []
    while True:
        finished.append(active.where(F.size("rest") == 0).select("host", "path", "template"))
        active = active.where(F.size("rest") > 0)
        if active.isEmpty():
            break
        # A shared segment has no siblings, so only its digits can make it a wildcard.
        shared = active.groupBy("host", "template").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"))
        shared = shared.select("host", "template", _shared(F.col("lo"), F.col("hi")).alias("taken"))
        steps = F.transform(
            F.slice("rest", 1, F.col("taken")),
            lambda p: F.when(_varies(p, one, one, one, many, share), F.lit("*")).otherwise(p),
        )
        here = cut_lineage(
            active.join(shared, ["host", "template"]).select(
                "host",
                "path",
                "urls",
                _rest(F.col("rest"), F.col("taken")).alias("rest"),
                F.concat("template", steps).alias("template"),
            )
        )
        ended, here = here.where(F.size("rest") == 0), here.where(F.size("rest") > 0)
        finished.append(ended.select("host", "path", "template"))
        here = here.withColumn("part", F.col("rest")[0])
        nodes = here.groupBy("host", "template", "part").agg(F.sum("urls").alias("n"))
        parents = nodes.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("children"), F.sum("n").alias("total")
        )
        varied = nodes.join(parents, ["host", "template"]).where(
            _varies(F.col("part"), F.col("n"), F.col("children"), F.col("total"), many, share)
        )
        wild = varied.select("host", "template", "part", F.lit(True).alias("wild"))
        name = F.when(F.col("wild"), F.lit("*")).otherwise(F.col("part"))
        active = cut_lineage(
            here.join(wild, ["host", "template", "part"], "left").select(
                "host",
                "path",
                "urls",
                _rest(F.col("rest"), F.lit(1)).alias("rest"),
                F.concat("template", F.array(name)).alias("template"),
            )
        )
    return reduce(DataFrame.unionByName, finished)


def _siblings(nodes: DataFrame, z: float) -> DataFrame:
    """``host, branch, good, bad, kin, kg, kb``: which siblings with such counts are merged, and their sums.

    Siblings with equal counts are one row, so few rows of a node meet in the window.
    """
    counts = nodes.groupBy("host", "branch", "good", "bad").agg(F.count(F.lit(1)).alias("k"))
    sums = counts.withColumns(
        {"g": F.col("good") * F.col("k"), "n": (F.col("good") + F.col("bad")) * F.col("k")}
    )
    told = sums.where("n > 0").withColumn("rate", F.col("g") / F.col("n"))
    order = Window.partitionBy("host", "branch").orderBy("rate", "n", "good")
    before = {"pg": F.lag("g").over(order), "pn": F.lag("n").over(order)}
    pooled = (F.col("g") + F.col("pg")) / (F.col("n") + F.col("pn"))
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n") + 1 / F.col("pn")))
    apart = F.col("rate") - F.col("pg") / F.col("pn") > z * error
    marked = told.withColumns(before).withColumn("apart", F.coalesce(apart, F.lit(False)).cast("int"))
    grouped = marked.withColumn("kin", F.sum("apart").over(order).cast("string"))
    silent = sums.where("n = 0").select("host", "branch", "good", "bad", "g", "n", F.lit("none").alias("kin"))
    every = grouped.select(*silent.columns).unionByName(silent)
    totals = every.groupBy("host", "branch", "kin").agg(
        F.sum("g").alias("kg"), (F.sum("n") - F.sum("g")).alias("kb")
    )
    return every.select("host", "branch", "good", "bad", "kin").join(totals, ["host", "branch", "kin"])


def template_purity(
    labelled: DataFrame, strength: float = 4.0, z: float = 1.96
) -> DataFrame:
    """``host, template, purity`` for every template, from ``host, template, good, bad`` sums."""
    host_sums = labelled.groupBy("host").agg(F.sum("good").alias("hg"), F.sum("bad").alias("hb"))
    good, bad = host_sums.agg(F.sum("hg"), F.sum("hb")).first()
    prior = F.lit(((good or 0) + 1) / ((good or 0) + (bad or 0) + 2))
    active = cut_lineage(
        labelled.join(host_sums, "host").select(
            "host",
            "template",
            "good",
            "bad",
            F.col("template").alias("rest"),
            F.array().cast("array<string>").alias("branch"),
            _smooth("hg", "hb", prior, strength).alias("above"),
        )
    )
    finished = []
    while True:
        done = active.where(F.size("rest") == 0)
        finished.append(done.select("host", "template", F.col("above").alias("purity")))
        active = active.where(F.size("rest") > 0)
        if active.isEmpty():
            break
        chains = active.groupBy("host", "branch").agg(
            F.min("rest").alias("lo"), F.max("rest").alias("hi"), F.sum("good").alias("g"), F.sum("bad").alias("b")
        )
        chains = chains.select("host", "branch", _shared(F.col("lo"), F.col("hi")).alias("taken"), "g", "b")
        # An only child is smoothed towards its parent; so many in a row have this closed form.
        n = F.col("g") + F.col("b")
        rate = F.when(n > 0, F.col("g") / n).otherwise(F.col("above"))
        fade = F.pow(strength / (n + strength), F.col("taken"))
        here = cut_lineage(
            active.join(chains, ["host", "branch"]).select(
                "host",
                "template",
                "good",
                "bad",
                _rest(F.col("rest"), F.col("taken")).alias("rest"),
                "branch",
                (rate + (F.col("above") - rate) * fade).alias("above"),
            )
        )
        ended, here = here.where(F.size("rest") == 0), here.where(F.size("rest") > 0)
        finished.append(ended.select("host", "template", F.col("above").alias("purity")))
        here = here.withColumn("part", F.col("rest")[0])
        nodes = here.groupBy("host", "branch", "part").agg(
            F.sum("good").alias("good"), F.sum("bad").alias("bad")
        )
        kin = nodes.join(_siblings(nodes, z), ["host", "branch", "good", "bad"])
        active = cut_lineage(
            here.join(kin.select("host", "branch", "part", "kin", "kg", "kb"), ["host", "branch", "part"]).select(
                "host",
                "template",
                "good",
                "bad",
                _rest(F.col("rest"), F.lit(1)).alias("rest"),
                F.concat("branch", F.array("kin")).alias("branch"),
                _smooth("kg", "kb", F.col("above"), strength).alias("above"),
            )
        )
    return reduce(DataFrame.unionByName, finished)


def _smooth(good: str, bad: str, prior: Column, strength: float) -> Column:
    return (F.col(good) + strength * prior) / (F.col(good) + F.col(bad) + strength)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = (),
    labels: DataFrame | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    depth: int | None = None,
    least_purity: float = 0.4,
) -> DataFrame:
    """``id_column, host, path, rule, template, purity, verdict`` for every row of ``pages``.

    ``labels`` is ``(id_column, good boolean)``; repeated labels of an id all count. Urls that a
    rule decides are labelled by it as well. ``rules`` is a list of the caller, compiled into the
    plan; the longest that fits wins.
    """
    host, path = split_url(F.col("url"))
    urls = pages.select(
        F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url")
    ).select("id", host.alias("host"), path.alias("path"))
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("rule", rule).withColumn("ruled", ruled)
    templates = cut_lineage(path_templates(urls, depth))
    signs = urls.where(F.col("ruled").isNotNull()).select(
        "host", "path", (F.col("ruled") == "allow").alias("good")
    )
    if labels is not None:
        named = labels.select(F.col(id_column).alias("lid"), F.col("good").cast("boolean"))
        signs = signs.unionByName(
            urls.where(F.col("ruled").isNull())
            .join(named.where(F.col("good").isNotNull()), F.col("id") == F.col("lid"))
            .select("host", "path", "good")
        )
    sums = signs.groupBy("host", "path").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    labelled = (
        templates.join(sums, ["host", "path"], "left")
        .groupBy("host", "template")
        .agg(
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        )
    )
    purity = template_purity(labelled)
    known = templates.join(purity, ["host", "template"], "left")
    verdict = F.when(F.coalesce("purity", F.lit(1.0)) < least_purity, "block").otherwise("allow")
    return urls.join(known, ["host", "path"], "left").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "purity",
        F.coalesce("ruled", verdict).alias("verdict"),
    )
