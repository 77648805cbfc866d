"""Line dedup: drop lines that stand on a large share of a site's pages.

Method: site-relative frequency. Pages are grouped by host; the number of
pages that hold a line is divided by the number of pages of the host, and a
line over ``ratio`` (and on ``min_pages`` pages at least) is boilerplate of
that host. A page is one distinct text of the host and counts once for a line
it repeats: copies of a text are one page in both counts and in
``min_pages``, so they never vote for their own lines. With ``each_row`` each
row is a page, copies as well, which is how the SQL of op5 defines its result.

DataFrame functions only. Lines are counted as 64-bit hashes by (host,
line), so a hot host is spread over its lines and partial sums run before
the shuffle. Copies meet as line hashes by (host, hash of the text), reduced
before the shuffle, so a text with many copies sends one row for each task.
A host's list holds at most (mean lines per page / ratio)
hashes; it meets the pages by host: broadcast by the planner where its
stored size allows, else a join whose page side adaptive execution splits.

Cases: null text stays null and the null texts of a host count as one page
without lines; blank lines
are layout, never counted or dropped; a null host is no site, so its pages
stay as they are; empty tables give empty results. Columns that are already
called ``n_lines`` or ``n_dropped`` are replaced by the operator's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm._common import stored

_HOST, _LINE, _LIST, _PAGES = "__ld_host", "__ld_line", "__ld_list", "__ld_pages"


def _lines(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 3, each_row: bool = False) -> DataFrame:
    """One row for each host with boilerplate: the host and its line hashes."""
    used = F.filter(_lines(text), lambda x: F.trim(x) != "")
    pages = docs.filter(F.col(host).isNotNull()).select(
        F.col(host).alias(_HOST), F.xxhash64(text).alias("page"), F.array_distinct(F.transform(used, lambda x: F.xxhash64(x))).alias("lines"))
    if not each_row:
        pages = stored(pages.distinct())
    total = stored(pages.groupBy(_HOST).agg(F.count("*").alias(_PAGES)))
    seen = (
        pages.select(_HOST, F.explode("lines").alias(_LINE))
        .groupBy(_HOST, _LINE).agg(F.count("*").alias("n")).filter(F.col("n") >= min_pages)
    )
    return (
        seen.join(total, _HOST).filter(F.col("n") > F.lit(float(ratio)) * F.col(_PAGES))
        .groupBy(_HOST).agg(F.sort_array(F.collect_set(_LINE)).alias(_LIST))
    )


def line_dedup(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = 0.1, min_pages: int = 3, each_row: bool = False) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``, plus
    ``n_lines`` (lines before) and ``n_dropped``."""
    listed = stored(boilerplate(docs, host, text, ratio, min_pages, each_row))
    docs = docs.drop(*[c for c in ("n_lines", "n_dropped") if c in docs.columns])
    met = docs.join(listed, F.col(host) == F.col(_HOST), "left")
    kept = F.filter(_lines(text), lambda x: (F.trim(x) == "") | ~F.array_contains(F.col(_LIST), F.xxhash64(x)))
    kept = F.when(F.col(_LIST).isNull(), _lines(text)).otherwise(kept)
    size = lambda a: F.coalesce(F.when(F.col(text).isNotNull(), F.size(a)), F.lit(0)).cast("long")
    out = met.withColumn(_LINE, kept).withColumn("n_lines", size(_lines(text)))
    out = out.withColumn("n_dropped", F.col("n_lines") - size(F.col(_LINE)))
    return out.withColumn(text, F.array_join(_LINE, "\n")).drop(_HOST, _LIST, _LINE)
