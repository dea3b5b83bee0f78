"""Line dedup by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yardstar.llm.common import materialize, numbered

BLANK = " \t\r\f\x0b"


def _key(line: Column) -> Column:
    """Two independent hashes of a trimmed line: 128 bits stand for its text."""
    return F.struct(F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"))


def boilerplate_lines(
    docs: DataFrame, host_col: str, text_col: str, ratio: float = 0.05, min_pages: int = 5
) -> DataFrame:
    """``(host, lines)``: hashes of the lines that stand in more than ``ratio`` of a host's pages.

    Each page counts a line once, whatever its copies in the page; lines are
    compared without surrounding blanks, and blank lines don't count. Counts
    are summed map-side by (host, line), so neither a hot host nor a hot line
    meets in one task. A host's array is bounded by its mean lines a page
    divided by ``ratio``. Pages with NULL text count as pages; rows with NULL
    host belong to no site.
    """
    pages = docs.where(F.col(host_col).isNotNull()).select(F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    trimmed = F.transform(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(BLANK)))
    lines = F.array_distinct(F.transform(F.filter(trimmed, lambda x: x != ""), _key))
    counts = (
        pages.select("host", F.explode(lines).alias("line"))
        .groupBy("host", F.col("line.h1").alias("h1"), F.col("line.h2").alias("h2"))
        .agg(F.count("*").alias("with_line"))
        .where(F.col("with_line") >= min_pages)
    )
    totals = pages.groupBy("host").agg(F.count("*").alias("n_pages"))
    return (
        counts.join(totals, "host")
        .where(F.col("with_line") > ratio * F.col("n_pages"))
        .groupBy("host")
        .agg(F.collect_list(F.struct("h1", "h2")).alias("lines"))
    )


def drop_boilerplate(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    ratio: float = 0.05,
    min_pages: int = 5,
) -> DataFrame:
    """``docs`` without the lines that exceed ``ratio`` of their host's pages, plus ``n_lines`` and ``n_dropped``.

    A line goes if at least ``min_pages`` pages of the host hold it and they
    are more than ``ratio`` of its pages. All its copies go; the other lines
    stay as they were and in order. Blank lines always stay, and a page
    may become empty. NULL text stays NULL with 0 lines; rows with NULL host
    stay as they are. Columns of the input named ``n_lines`` or ``n_dropped`` are
    replaced. The found lines are written to the shared folder first,
    so that Spark knows their size: small tables are broadcast, others
    sort-merged with AQE splitting a hot host.
    """
    docs = docs.drop("n_lines", "n_dropped")
    columns = docs.columns
    docs, number = numbered(docs)
    host_col, text_col = number[host_col], number[text_col]
    found = materialize(boilerplate_lines(docs, host_col, text_col, ratio, min_pages), "boilerplate")
    found = found.select(F.col("host").alias("_host"), F.col("lines").alias("_found"))
    lines = F.split(F.col(text_col), "\n", -1)
    joined = docs.join(found, F.col(host_col) == F.col("_host"), "left").select("*", lines.alias("_lines"))
    kept = F.filter(
        "_lines", lambda x: ~F.coalesce(F.array_contains("_found", _key(F.btrim(x, F.lit(BLANK)))), F.lit(False))
    )
    joined = joined.select("*", F.when(F.col("_found").isNull(), F.col("_lines")).otherwise(kept).alias("_kept"))
    text = F.when(F.col("_found").isNull(), F.col(text_col)).otherwise(F.array_join("_kept", "\n"))
    n_lines = F.coalesce(F.size("_lines"), F.lit(0))
    return joined.select(
        *(text.alias(c) if number[c] == text_col else F.col(number[c]).alias(c) for c in columns),
        F.when(F.col(text_col).isNull(), 0).otherwise(n_lines).alias("n_lines"),
        F.when(F.col(text_col).isNull(), 0).otherwise(n_lines - F.size("_kept")).alias("n_dropped"),
    )
