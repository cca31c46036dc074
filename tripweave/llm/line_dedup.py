"""Lines that a site repeats on many of its pages.

Per site, the number of pages with a line is divided by the number of pages. Lines above the
ratio are boilerplate and leave every page of that site. Only 128-bit line hashes and counts
are shuffled, after a partial count in each task, so a site with most of the pages costs no
task more than others. The boilerplate of a site is a short list: a page of n lines can hold
no more than n boilerplate lines, and each stands on a share ``ratio`` of the pages.

Equal texts at a site are one page, or all lines of a text with many copies would go and its
content with them; with ``copies`` near copies are one page, too, with the lines of all of them.

Defined results: lines are split at line feeds and compared without white space at their
ends; blank lines are never boilerplate; a line that repeats within a page counts once; sites
of any size are judged by the same ratio, and a line that fewer than ``least_with`` different
pages hold stays at any of them; a null site is a site; a null text is an empty page and stays
null; all columns are kept; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.llm import simhash
from tripweave.llm.frames import free_name, saved

#: Share of a site's pages above which a line is boilerplate, and pages that hold it at least.
RATIO = 0.07
LEAST_WITH = 3
#: Boilerplate lines that may be sent to all executors: at 16 bytes and a host each, some 30 MB.
MOST_BROADCAST = 500_000
#: Parts of a site's pages when its lines go to them by a shuffle.
SALTS = 64


def _compared(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def _hash(line: Column) -> Column:
    return F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit("second"), line).alias("b")
    )


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _of_copies(pages: DataFrame, copies: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """(host, line) of each group of near copies at a site, and (host) of each group."""
    width, distance = copies
    pages = saved(
        pages.select("host", "lines", simhash.fingerprints(F.col("text"), width).alias("fp")),
        "line-pages",
    )
    roots = saved(simhash.roots(pages.select("fp").distinct(), distance), "line-roots")

    def grouped(rows: DataFrame) -> DataFrame:  # copies are one row before the join
        named = rows.distinct().join(roots, F.col("fp") == F.col("node"), "left")
        return named.withColumn("fp", F.coalesce("root", "fp")).select(*rows.columns).distinct()

    lines = grouped(pages.select("host", "fp", F.explode("lines").alias("line")))
    return lines.select("host", "line"), grouped(pages.select("host", "fp")).select("host")


def boilerplate(
    docs: DataFrame,
    host: str,
    text: str,
    ratio: float,
    least_with: int,
    copies: tuple[int, int] | None = None,
) -> DataFrame:
    """(host, line hash, pages with it, pages) of the lines above the ratio."""
    hashes = F.transform(_lines(F.col("text")), _compared)
    hashes = F.array_distinct(F.transform(F.array_remove(hashes, ""), _hash))
    pages = docs.select(
        F.col(f"`{host}`").alias("host"), F.col(f"`{text}`").cast("string").alias("text")
    ).withColumn("lines", hashes)
    if copies:
        lines, pages = _of_copies(pages, copies)
    else:
        named = pages.select("host", _hash(F.coalesce("text", F.lit(""))).alias("page"), "lines")
        pages = saved(
            named.groupBy("host", "page").agg(F.first("lines").alias("lines")), "line-pages"
        )
        lines = pages.select("host", F.explode("lines").alias("line"))
    totals = pages.groupBy("host").agg(F.count("*").alias("n_pages")).withColumnRenamed(
        "host", "site"
    )
    counts = (
        lines.groupBy("host", "line")
        .agg(F.count("*").alias("n_with"))
        .filter(F.col("n_with") >= least_with)
    )
    return (
        counts.join(totals, F.col("host").eqNullSafe(F.col("site")))
        .filter(F.col("n_with") > ratio * F.col("n_pages"))
        .select("host", "line", "n_with", "n_pages")
    )


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_with: int = LEAST_WITH,
    dropped: str | None = None,
    copies: tuple[int, int] | None = None,
) -> DataFrame:
    """``docs`` without the lines that stand on more than ``ratio`` of a site's pages.

    ``dropped`` names a further column with the number of lines a page lost. ``copies`` is the
    width and distance of ``simhash`` by which pages of a site count as one page. The lists of all
    sites go to all executors while they hold at most ``MOST_BROADCAST`` lines; beyond that
    the pages of each site are dealt into ``SALTS`` parts and joined by a shuffle.
    """
    site, lines, salt = (free_name(docs, c) for c in ("_site", "_lines", "_salt"))
    found = saved(boilerplate(docs, host, text, ratio, least_with, copies), "line-dedup")
    gone = F.struct(F.collect_list("line.a").alias("a"), F.collect_list("line").alias("both"))
    lists = found.groupBy(F.col("host").alias(site)).agg(gone.alias(lines))
    same = F.col(f"`{host}`").eqNullSafe(F.col(site))
    columns = list(docs.columns)
    if found.count() <= MOST_BROADCAST:
        joined = docs.join(F.broadcast(lists), same, "left")
    else:
        parts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        other = f"{salt}b"
        dealt = docs.withColumn(
            salt, F.pmod(F.xxhash64(*[f"`{c}`" for c in columns]), F.lit(SALTS)).cast("int")
        )
        joined = dealt.join(
            lists.withColumn(other, parts), same & (F.col(salt) == F.col(other)), "left"
        )
    body = F.col(f"`{text}`").cast("string")
    listed = F.col(lines)

    def stays(line: Column) -> Column:  # one hash tells nearly all lines
        both = _hash(_compared(line))
        return ~(F.array_contains(listed["a"], both["a"]) & F.array_contains(listed["both"], both))

    kept = F.filter(_lines(body), stays)
    changed = F.when(F.col(lines).isNull() | body.isNull(), body).otherwise(F.array_join(kept, "\n"))
    out = [changed.alias(c) if c == text else F.col(f"`{c}`") for c in columns]
    if dropped:
        lost = F.when(F.col(lines).isNull() | body.isNull(), F.lit(0)).otherwise(
            F.size(_lines(body)) - F.size(kept)
        )
        out.append(lost.cast("long").alias(dropped))
    return joined.select(*out)
