"""URL filters: rules by host and path, and a tree of path templates for what no rule covers.

A rule fits its host and all subdomains of it, if the path of a URL starts with
the rule's; the longest fitting rule gives the verdict. URLs that a rule covers
are the labelled rows of the tree.

Each host has a tree over the segments of its paths, grown level by level from
counts, never from the rows of a host. A segment's digits become ``#``; a child
with few URLs, or with a small share of its parent's, becomes the wildcard
``*``. So a node has at most ``LITERALS`` children besides the wildcard. Sibling
branches are merged while what stands below them is alike: the shares of each
kind of next segment, and the blocked shares of their labelled URLs, differ by
no more than Hoeffding's bound and a tolerance. Merged branches grow on as one
template. The blocked share of a template is smoothed towards its parent's, that
of a host towards ``PRIOR``; templates from ``BLOCK_AT`` on are rejected.

Defined results
---------------
Host: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; path: what then follows up to ``?`` or ``#``. A null URL, or one
without ``://``, has an empty host and path; it is judged as a host like any
other. Repeated rows count again. Rules of one length: the first given wins.
Segments below ``DEPTH`` are one segment ``**``, those longer than ``LONG`` code
points are wildcards. No labelled URL at all: everything is allowed. Empty table:
no rows. Other columns pass through in ``row``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import stored
from claimloom.operators.lookup import lookup

#: Levels of a tree, and the longest segment that can be a branch of its own.
DEPTH, LONG = 12, 64
#: URLs a branch of its own needs, and the most branches of a node: 1/LITERALS of its URLs each at least.
BRANCH, LITERALS = 3, 32
#: A node with fewer URLs is not split.
SPLIT = 8
#: Kinds of next segment that branches are compared by; the first is the end of the path.
KINDS = 16
#: Difference of shares that is no difference, and the error of the bound on top of it.
TOLERANCE, ALPHA = 0.05, 0.05
#: Blocked share of an unknown host, and the number of labelled URLs the parent's share counts as.
PRIOR, WEIGHT = 0.25, 2.0
BLOCK_AT = 0.5
ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COUNTS = ("n", "blocked", "allowed")
BRANCHES = "key string, template string, n long, blocked long, allowed long"
BRANCH_SCHEMA = pa.schema([("key", pa.string()), ("template", pa.string())] + [(c, pa.int64()) for c in COUNTS])


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return F.translate(_after_scheme(url, r"^([^/?#]*)"), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _after_scheme(url, r"^[^/?#]*([^?#]*)")


def _after_scheme(url: Column, pattern: str) -> Column:
    start = F.locate("://", url)
    rest = F.when(start > 0, F.regexp_extract(F.substr(url, start + 3), pattern, 1))
    return F.coalesce(rest, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """rule and verdict of the longest fitting rule, null where none fits."""
    longest = sorted(rules, key=lambda r: -len(r.text))
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(longest):
        named = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        chosen = F.when(rule.fits(host, path), named).otherwise(chosen)
    return chosen


def shape_of(path: Column) -> Column:
    """Segments with digits as ``#``, escaped so that no text looks like a wildcard or a merged branch."""
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    shaped = F.transform(
        segments,
        lambda s: F.when(F.char_length(s) > LONG, F.lit("*")).otherwise(
            F.regexp_replace(F.regexp_replace(s, r"([\\*{}|#])", r"\\$1"), "[0-9]+", "#")
        ),
    )
    return F.when(F.size(shaped) <= DEPTH, shaped).otherwise(
        F.concat(F.slice(shaped, 1, DEPTH - 1), F.array(F.lit("**")))
    )


def kind_of(segment: Column) -> Column:
    """Which of KINDS a next segment is; 0 where the path ends."""
    return F.when(segment.isNull(), 0).otherwise(F.pmod(F.xxhash64(segment), F.lit(KINDS - 1)) + 1)


# --- merging of sibling branches ---------------------------------------------


def alike(one: Sequence[float], other: Sequence[float]) -> bool:
    """Whether two rows of counts have like shares; a row without any is like all others."""
    sizes = sum(one), sum(other)
    if not all(sizes):
        return True
    bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * sum(1 / math.sqrt(s) for s in sizes)
    return all(abs(x / sizes[0] - y / sizes[1]) < TOLERANCE + bound for x, y in zip(one, other))


def merged(branches: list[dict]) -> list[dict]:
    """Groups of sibling branches; large ones first, each joins the first group it is like."""
    groups: list[dict] = []
    for branch in sorted(branches, key=lambda b: (-b["n"], b["name"])):
        for group in groups:
            if alike(group["kinds"], branch["kinds"]) and alike(
                (group["blocked"], group["allowed"]), (branch["blocked"], branch["allowed"])
            ):
                group["names"].append(branch["name"])
                for c in COUNTS:
                    group[c] += branch[c]
                group["kinds"] = [x + y for x, y in zip(group["kinds"], branch["kinds"])]
                break
        else:
            groups.append({"names": [branch["name"]], "kinds": branch["kinds"], **{c: branch[c] for c in COUNTS}})
    return groups


def label(names: list[str]) -> str:
    return names[0] if len(names) == 1 else "{" + "|".join(sorted(names)) + "}"


def merge_branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each node's branches: the key a URL finds its branch by, the template it belongs to, that one's counts."""
    for batch in batches:
        rows = []
        for node in batch.to_pylist():
            for group in merged(node["branches"]):
                template = f"{node['node']}/{label(group['names'])}"
                for name in group["names"]:
                    rows.append({"key": f"{node['node']}/{name}", "template": template} | {c: group[c] for c in COUNTS})
        yield from pa.Table.from_pylist(rows, BRANCH_SCHEMA).to_batches()


# --- the tree ----------------------------------------------------------------


def smoothed(blocked: Column, allowed: Column, parent: Column) -> Column:
    return (blocked + WEIGHT * parent) / (blocked + allowed + WEIGHT)


def branches_of(live: DataFrame, level: int) -> DataFrame:
    """The branches below each node of ``live`` paths, merged: key, template, counts."""
    sums = [F.sum(c).alias(c) for c in COUNTS]
    kind = kind_of(F.get("segments", F.lit(level + 1)))
    kinds = [F.sum(F.when(kind == k, F.col("n")).otherwise(0)).alias(f"kind_{k}") for k in range(KINDS)]
    children = stored(
        live.groupBy("node", F.col("segments")[level].alias("segment")).agg(*sums, *kinds), "url-children"
    )
    totals = stored(children.groupBy("node").agg(F.sum("n").alias("total")), "url-totals")
    own = (F.col("n") >= BRANCH) & (F.col("n") * LITERALS >= F.col("total"))
    names = lookup(children, totals, "node", ["segment"]).withColumn(
        "name", F.when(own, F.col("segment")).otherwise("*")
    )
    folded = names.groupBy("node", "name").agg(*sums, *[F.sum(f"kind_{k}").alias(f"kind_{k}") for k in range(KINDS)])
    branch = F.struct("name", *COUNTS, F.array(*[f"kind_{k}" for k in range(KINDS)]).alias("kinds"))
    nodes = folded.groupBy("node").agg(F.collect_list(branch).alias("branches"))
    return stored(nodes.mapInArrow(merge_branches, BRANCHES), "url-branches")


def grown(paths: DataFrame) -> DataFrame:
    """``paths`` (shape, host, segments, counts) with the template and the smoothed blocked share of each."""
    totals = [F.sum(c).alias(c) for c in COUNTS]
    hosts = stored(paths.groupBy("host").agg(*totals), "url-hosts")
    share = smoothed(F.col("blocked"), F.col("allowed"), F.lit(PRIOR))
    roots = hosts.select("host", F.col("n").alias("node_n"), share.alias("share"))
    tree = lookup(paths, roots, "host", ["shape"]).withColumn("node", F.col("host"))
    for level in range(DEPTH):
        tree = stored(tree, "url-paths")
        grows = (F.size("segments") > level) & (F.col("node_n") >= SPLIT)
        if tree.where(grows).isEmpty():
            break
        branch = F.struct("template", *COUNTS).alias("branch")
        flat = branches_of(tree.where(grows), level)
        branches = flat.select("key", branch)
        named = F.when(grows, F.concat("node", F.lit("/"), F.col("segments")[level]))
        # A branch of its own first, the node's wildcard for the rest.
        own = lookup(tree.withColumn("key", named), branches, "key", ["shape"], measured=flat).withColumnRenamed("branch", "own")
        wild = F.when(grows & F.col("own").isNull(), F.concat("node", F.lit("/*")))
        found = lookup(own.withColumn("key", wild), branches, "key", ["shape"], measured=flat)
        moved = found.withColumn("branch", F.coalesce("own", "branch"))
        new_share = smoothed(F.col("branch.blocked"), F.col("branch.allowed"), F.col("share"))
        tree = moved.select(
            "shape",
            "segments",
            *COUNTS,
            F.coalesce("branch.template", "node").alias("node"),
            F.coalesce(new_share, "share").alias("share"),
            # What does not grow here never grows again.
            F.coalesce("branch.n", F.lit(0)).alias("node_n"),
        )
    return stored(tree, "url-templates").select("shape", F.col("node").alias("template"), "share")


def judge(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str] | None = None, url: str = "url") -> DataFrame:
    """``row`` (the input row, or its columns ``keep``), host, path, rule, verdict, template, blocked_share."""
    names = pages.columns if keep is None else keep
    kept = pages.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{url}`").alias("url"))
    parsed = kept.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))}).drop("url")
    ruled = parsed.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    placed = ruled.withColumn("segments", shape_of(F.col("path"))).withColumn(
        "shape", F.concat_ws("/", F.col("host"), F.array_join("segments", "/"))
    )
    verdict = F.col("ruled.verdict")
    paths = placed.groupBy("shape").agg(
        F.first("host").alias("host"),
        F.first("segments").alias("segments"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(verdict == BLOCK).alias("blocked"),
        F.count_if(verdict == ALLOW).alias("allowed"),
    )
    templates = grown(stored(paths, "url-shapes"))
    rows = placed.withColumn("spread", F.monotonically_increasing_id())
    judged = lookup(rows, templates, "shape", ["spread"])
    return judged.select(
        "row",
        "host",
        "path",
        F.col("ruled.rule").alias("rule"),
        F.coalesce(verdict, F.when(F.col("share") >= BLOCK_AT, BLOCK).otherwise(ALLOW)).alias("verdict"),
        "template",
        F.col("share").alias("blocked_share"),
    )
