"""Line dedup by the spread of a line over sites, in DataFrame functions only.

One pass sums up, for each line hash, a HyperLogLog sketch of the sites it
occurs on; sketches are merged by the aggregation, map-side first. Lines whose
estimate is near the threshold get an exact distinct count in a second pass
over those lines only. Lines on at least ``min_sites`` sites are boilerplate
and are removed wherever they stand.

Defined results
---------------
Lines are split at ``\\n`` and compared as they are. A line without any
character besides ASCII white space is never removed. A null site is one site
of its own. null text: no lines, nothing removed, kept text empty. Empty text:
one (blank) line. Repeated rows count for their site once, each is cleaned.
Empty table: no rows. Other columns pass through ``remove_boilerplate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.llm.common import as_row, join_measured, stored
from claimloom.operators.lookup import lookup

#: A line on so many sites is boilerplate.
MIN_SITES = 10
#: Relative error of the sketches, and the band around the threshold that is counted exactly.
ERROR, NEAR = 0.07, (0.5, 1.5)
NO_BLANK = r"[^\x20\x09-\x0D]"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """128-bit hash of a line."""
    return F.md5(line.cast("binary"))


def owner_of(doc_id: Column, text: Column) -> Column:
    """What the lines of a document are gathered by: its id, or its text where it has none.

    So rows without an id do not gather the lines of all such rows.
    """
    return F.when(doc_id.isNull(), F.concat(F.lit("="), F.sha2(text.cast("binary"), 256))).otherwise(doc_id.cast("string"))


def line_rows(docs: DataFrame, site: str) -> DataFrame:
    """One row per line that is not blank: owner, site, key."""
    return (
        docs.select(
            owner_of(F.col("doc_id"), F.col("text")).alias("owner"),
            F.coalesce(F.concat(F.lit("="), F.col(site)), F.lit("")).alias("site"),
            F.explode(lines_of(F.col("text"))).alias("line"),
        )
        .where(F.col("line").rlike(NO_BLANK))
        .select("owner", "site", line_key(F.col("line")).alias("key"))
    )


def spread(lines: DataFrame, error: float = ERROR) -> DataFrame:
    """Estimated number of sites of each line: key, about."""
    return lines.groupBy("key").agg(F.approx_count_distinct("site", error).alias("about"))


def boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """Keys of the lines that stand on at least ``min_sites`` sites."""
    lines = line_rows(docs, site)
    sketched = stored(spread(lines).where(F.col("about") >= NEAR[0] * min_sites), "spread")
    near = sketched.where(F.col("about") <= NEAR[1] * min_sites).select("key")
    counted = (
        lookup(lines, near, "key", ["owner"], "left_semi")
        .groupBy("key")
        .agg(F.countDistinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
    )
    far = sketched.where(F.col("about") > NEAR[1] * min_sites)
    return stored(far.select("key").unionByName(counted.select("key")), "boilerplate")


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``row`` (the input row), n_lines, n_removed and kept_text of each row."""
    keys = boilerplate(docs, site, min_sites)
    hits = lookup(line_rows(docs, site).select("owner", "key"), keys, "key", ["owner"], "left_semi")
    per_doc = stored(hits.groupBy("owner").agg(F.collect_set("key").alias("removed")), "removed")
    packed = as_row(docs).withColumn("owner", owner_of(F.col("row.doc_id"), F.col("row.text")))
    lines = F.when(F.col("row.text").isNull(), F.array().cast("array<string>")).otherwise(
        lines_of(F.col("row.text"))
    )
    marked = join_measured(packed, per_doc, ["owner"], "left").select("row", "removed", lines.alias("lines"))
    kept = F.when(F.col("removed").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains("removed", line_key(line)))
    )
    return marked.withColumn("kept", kept).select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.array_join("kept", "\n").alias("kept_text"),
    )
