"""URL filter: rules of hosts and paths, and a tree of path templates for all that no rule judges.

**Tree.** The path of a URL is cut into segments; numbers and long hexadecimal ids in them become wildcards. From the host
downwards, a segment stays a branch of its own where at least ``MIN_PAGES`` pages and one in ``FANOUT`` of its parent have it; all
others there are one wildcard branch ``*``, so a node has at most ``FANOUT`` + 1 branches however many paths a host has. Sibling branches
whose labels do not differ statistically (chi-squared, neighbours in the order of their share of good labels) are merged into one,
``~`` and its smallest segment. Segments behind the ``DEPTH``-th are one branch ``**``. The branches from host to end are a URL's template.

**Verdict.** The share of good labels of a template is smoothed in steps: all labels, then those of the same segments at any host, then
those of the template itself, each counting the step before it as ``PRIOR`` labels. Below ``MIN_PURITY`` a template is rejected.

Only DataFrame functions are used. Labels and pages are added up by distinct (host, segments) before anything is joined; a table of branches
has at most ``FANOUT`` rows a node, and adaptive execution splits the rows of a host that holds many pages.

Defined results: a null URL, or one without ``://``, has an empty host and path, so no rule fits it; a URL whose path is empty or without segments
has the template of its host alone; labels are 1 (good), 0 (bad) or null (none), and without any label all is allowed. Of several
rules the longest (host and path together) wins, then the smaller text. Repeated pages count each time and keep their rows. Other columns
of the pages are passed on; those named like a result are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollfeat.llm.store import Store

# Segments of a path that the tree tells apart.
DEPTH = 3
MIN_PAGES = 5
FANOUT = 50
# Chi-squared with one degree of freedom at five per cent.
SIMILAR = 3.841
PRIOR = 10.0
MIN_PURITY = 0.5

RESULTS = ("host", "path", "template", "rule", "purity", "verdict")
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with all its subdomains, where the path starts with the rule's path."""

    verdict: str
    host: str
    path: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks, it does not {self.verdict!r}")

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Verdict and text of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in ordered
    ]
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, nothing)


def _generalised(segment: Column) -> Column:
    an_id = segment.rlike(r"^[0-9a-f\-]{8,}$") & segment.rlike("[0-9]") & segment.rlike("[a-f]")
    return F.when(an_id, F.lit("{id}")).otherwise(F.regexp_replace(segment, "[0-9]+", "{n}"))


def segments_of(path: Column, depth: int = DEPTH) -> Column:
    """Generalised segments, at most ``depth`` and one for all behind them."""
    found = F.filter(F.split(path, "/"), lambda s: s != "")
    shown = F.transform(F.slice(found, 1, depth), _generalised)
    return F.when(F.size(found) > depth, F.concat(shown, F.array(F.lit("**")))).otherwise(shown)


def _alike(a: Column, b: Column) -> Column:
    """No significant difference between two branches' labels: chi-squared of the two by two table."""
    cross = a["good"] * b["bad"] - a["bad"] * b["good"]
    of_a, of_b, good, bad = a["good"] + a["bad"], b["good"] + b["bad"], a["good"] + b["good"], a["bad"] + b["bad"]
    return cross * cross * (of_a + of_b) <= F.lit(SIMILAR) * of_a * of_b * good * bad


def _branch_names(branches: Column) -> Column:
    """Entries (segment, branch). Labelled siblings, ordered by their share of good labels, join the group before them where they are
    alike; a group of several is named after its smallest segment. Siblings without labels stay by themselves."""
    labelled = F.filter(branches, lambda b: b["good"] + b["bad"] > 0)
    good = lambda b: b["good"].cast("double")
    alone = F.transform(
        labelled,
        lambda b: F.struct(
            (good(b) / (b["good"] + b["bad"]).cast("double")).alias("share"),
            b["segment"].alias("name"),
            F.array(b["segment"]).alias("members"),
            good(b).alias("good"),
            b["bad"].cast("double").alias("bad"),
        ),
    )
    group = "struct<share:double,name:string,members:array<string>,good:double,bad:double>"

    def joined(g, b):
        added = [F.concat(g["members"], b["members"]).alias("members"), (g["good"] + b["good"]).alias("good"), (g["bad"] + b["bad"]).alias("bad")]
        return F.struct(b["share"].alias("share"), F.least(g["name"], b["name"]).alias("name"), *added)

    def step(groups, b):
        last = F.try_element_at(groups, F.lit(-1))
        alike = F.coalesce(_alike(last, b), F.lit(False))
        return F.when(alike, F.concat(F.slice(groups, 1, F.size(groups) - 1), F.array(joined(last, b)))).otherwise(F.concat(groups, F.array(b)))

    groups = F.aggregate(F.array_sort(alone), F.array().cast(f"array<{group}>"), step)
    name = lambda g: F.when(F.size(g["members"]) > 1, F.concat(F.lit("~"), g["name"])).otherwise(g["name"])
    of_groups = F.flatten(F.transform(groups, lambda g: F.transform(g["members"], lambda m: F.struct(m.alias("segment"), name(g).alias("branch")))))
    unlabelled = F.filter(branches, lambda b: b["good"] + b["bad"] == 0)
    return F.concat(of_groups, F.transform(unlabelled, lambda b: F.struct(b["segment"].alias("segment"), b["segment"].alias("branch"))))


def _grow(shapes: DataFrame, level: int, store: Store) -> DataFrame:
    """One level of the tree: ``node`` of each shape that has a segment there becomes the branch that the segment belongs to."""
    here = shapes.select("*", F.get("segments", F.lit(level)).alias("segment"))
    sums = [F.sum(c).alias(c) for c in ("pages", "good", "bad")]
    children = store.keep(here.where("segment IS NOT NULL").groupBy("host", "node", "segment").agg(*sums))
    totals = children.groupBy("host", "node").agg(*[F.sum(c).alias(f"all_{c}") for c in ("pages", "good", "bad")])
    common = (F.col("pages") >= MIN_PAGES) & (F.col("pages") * FANOUT >= F.col("all_pages"))
    child = F.struct("segment", "pages", "good", "bad")
    listed = children.where(F.col("pages") >= MIN_PAGES).join(totals, ["host", "node"]).where(common).groupBy("host", "node").agg(F.sort_array(F.collect_list(child)).alias("named"))
    nodes = totals.join(listed, ["host", "node"], "left").select("*", F.coalesce("named", F.array().cast("array<struct<segment:string,pages:bigint,good:bigint,bad:bigint>>")).alias("branches"))

    def rest(c):
        return F.col(f"all_{c}") - F.aggregate("branches", F.lit(0).cast("long"), lambda total, b: total + b[c])

    star = F.struct(F.lit("*").alias("segment"), *[rest(c).alias(c) for c in ("pages", "good", "bad")])
    nodes = nodes.select("host", "node", F.concat("branches", F.filter(F.array(star), lambda b: b["pages"] > 0)).alias("branches"))
    names = F.map_from_entries(_branch_names(F.col("branches")))
    nodes = nodes.select(F.col("host").alias("__host"), F.col("node").alias("__node"), names.alias("names"))
    on = (F.col("host") == F.col("__host")) & (F.col("node") == F.col("__node"))
    joined = here.join(nodes, on, "left")
    branch = F.coalesce(F.try_element_at("names", "segment"), F.try_element_at("names", F.lit("*")))
    node = F.when(F.col("segment").isNull(), F.col("node")).otherwise(F.concat("node", F.lit("/"), branch))
    return store.keep(joined.select("host", "segments", "pages", "good", "bad", node.alias("node")))


def templates(labelled: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``host, segments, template, purity`` for each distinct host and segments of ``labelled`` (``host, path, label``)."""
    store = Store(labelled.sparkSession, "urls")
    shapes = labelled.select("host", segments_of(F.col("path"), depth).alias("segments"), "label").groupBy("host", "segments")
    shapes = shapes.agg(F.count(F.lit(1)).alias("pages"), F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"))
    shapes = store.keep(shapes.select("*", F.lit("").alias("node")))
    levels = shapes.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(levels):
        shapes = _grow(shapes, level, store)

    def sums(prefix):
        return [F.sum("good").alias(f"{prefix}_good"), F.sum("bad").alias(f"{prefix}_bad")]

    def smoothed(prefix, before):
        good, bad = F.col(f"{prefix}_good").cast("double"), F.col(f"{prefix}_bad").cast("double")
        return (good + F.lit(PRIOR) * before) / (good + bad + F.lit(PRIOR))

    of_all = shapes.agg(*sums("all"))
    everywhere = (F.col("all_good").cast("double") + F.lit(1.0)) / ((F.col("all_good") + F.col("all_bad")).cast("double") + F.lit(1.0))
    everywhere = of_all.select(everywhere.alias("purity")).scalar()
    of_shape = shapes.groupBy("segments").agg(*sums("shape"))
    of_template = shapes.groupBy("host", "node").agg(*sums("template"))
    purity = smoothed("template", smoothed("shape", everywhere))
    judged = shapes.join(of_template, ["host", "node"]).join(of_shape, "segments")
    return store.keep(judged.select("host", "segments", F.when(F.col("node") == "", F.lit("/")).otherwise(F.col("node")).alias("template"), F.round(purity, 6).alias("purity")))


def judge(pages: DataFrame, rules: Sequence[Rule] = (), label: Column | None = None, depth: int = DEPTH) -> DataFrame:
    """All columns of ``pages``, and host, path, template, rule, purity (of the template's labels) and verdict of each URL.

    ``label`` (1 good, 0 bad, null unknown) teaches the templates. Without it the rules do: what they judge is labelled.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    own = [F.col(f"`{c}`") for c in pages.columns if c not in RESULTS]
    parted = pages.select(*own, host.alias("host"), path.alias("path"), (F.lit(None) if label is None else label).cast("int").alias("__label"))
    ruled = parted.select("*", fitting_rule(F.col("host"), F.col("path"), rules).alias("__rule"))
    by_rule = F.when(F.col("__rule.verdict") == "allow", 1).when(F.col("__rule.verdict") == "block", 0)
    known = by_rule if label is None else F.col("__label")
    found = templates(ruled.select("host", "path", known.alias("label")), depth)
    keyed = ruled.select("*", segments_of(F.col("path"), depth).alias("__segments"))
    found = found.select(F.col("host").alias("__host"), F.col("segments").alias("__of"), "template", "purity")
    joined = keyed.join(found, (F.col("host") == F.col("__host")) & (F.col("__segments") == F.col("__of")), "left")
    verdict = F.coalesce("__rule.verdict", F.when(F.col("purity") < MIN_PURITY, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select(*own, "host", "path", "template", F.col("__rule.rule").alias("rule"), "purity", verdict.alias("verdict"))
