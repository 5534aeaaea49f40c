"""Boilerplate lines: those that too large a share of a host's pages carry.

For each host, the pages that hold a line are divided by the host's pages, and a line is dropped where that ratio is over
``ratio`` and at least ``least`` pages hold it.  Pages are counted by class.  Every page has two marks, the smallest
digest of its sentences (or lines) in one order and in another; pages with the same first mark are of one class, and so are classes whose
smallest second marks are the same.  Copies are of one class.  Of a group of n near copies that differ in a share c of
their sentences, about 4 c c n fall out of the class, and no more count as pages of their own: a group of copies or near
copies does not lose its lines.  Pages that share a template have fewer classes, but for the line and for the host alike.

Lines are compared without surrounding white space and with inner runs of it as one space; a line without other
characters is never counted or dropped.  Line counts are combined before the shuffle, and what is passed to a page is its
host's list of dropped lines: as ratios of one page sum up to its number of lines, a host has at most (mean lines per
page) / ``ratio`` of them, however many pages it has.

Results: texts of any length are read whole; a null text stays null with 0 lines; an empty text stays empty; a null host is a host of its own; repeated rows
count once and all stay; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.session import materialize

RATIO, LEAST = 0.08, 3


def normal_lines(text: Column) -> Column:
    """The lines of a text in normal form; white space is joined over the whole text, only trimming is left to each line."""
    joined = F.split(F.regexp_replace(text, r"[\x09\x0B-\x0D\x20]+", " "), "\n")
    return F.transform(joined, lambda x: F.trim(x))


SENTENCES = r"[\n.!?]"


def marked(pages: DataFrame, host: Column, text: Column, unit: str | None = SENTENCES) -> DataFrame:
    """(host, first, second, keys) of the pages with text: the two marks, and the distinct keys of the non-empty lines.

    Marks are smallest digests of what ``unit`` cuts a text into (None: its lines; all of it, if it has none), by their first and by
    their second half.  Keys are 64-bit hashes.  They are compared within one host only, and at most (mean lines per page)
    / ``ratio`` of a host's keys are near the limit; another line of 10^12 has the key of one of those 1000 with a
    probability of 10^-4 over a whole such corpus.
    """
    # each step is used more than once by the next, and worked out once
    rows = pages.where(text.isNotNull()).select(host.alias("host"), text.alias("text"), F.filter(normal_lines(text), lambda x: x != "").alias("lines"))
    cut = F.col("lines") if unit is None else F.filter(F.transform(F.split("text", unit), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    rows = rows.select("host", "text", "lines", cut.alias("units"))
    digests = F.transform(F.when(F.size("units") > 0, F.col("units")).otherwise(F.array("text")), lambda x: F.md5(x))
    rows = rows.select("host", "lines", digests.alias("digests"))
    second = F.array_min(F.transform("digests", lambda x: F.substring(x, 17, 16)))
    keys = F.array_distinct(F.transform("lines", lambda x: F.xxhash64(x)))
    return rows.select("host", F.xxhash64(F.array_min("digests")).alias("first"), second.alias("second"), keys.alias("keys"))


def dropped_lines(pages: DataFrame, host: Column, text: Column, ratio: float = RATIO, least: int = LEAST, unit: str | None = SENTENCES) -> DataFrame:
    """(host, lines): the keys of the normalised lines that ``host`` carries on over ``ratio`` of its pages."""
    marks = materialize(marked(pages, host, text, unit), "marks")
    classes = marks.groupBy("host", "first").agg(F.xxhash64(F.min("second")).alias("class"))
    hosts = classes.select("host", "class").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    # a row per host, first mark and line, then per host, class and line: each combined before its shuffle
    held = marks.select("host", "first", F.explode("keys").alias("line")).distinct()
    named = classes.withColumnsRenamed({"host": "_host", "first": "_first"})
    held = held.join(named, (F.col("first") == F.col("_first")) & F.col("host").eqNullSafe(F.col("_host"))).select("host", "class", "line").distinct()
    lines = held.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    often = lines.join(hosts, lines.host.eqNullSafe(hosts.host)).where(F.col("n") > F.col("pages") * ratio).select(lines.host, "line")
    return materialize(often.groupBy("host").agg(F.collect_set("line").alias("lines")), "boilerplate")


def without_boilerplate(pages: DataFrame, host: Column, text: str = "text", ratio: float = RATIO, least: int = LEAST, unit: str | None = SENTENCES) -> DataFrame:
    """``pages`` with ``text`` rid of its host's boilerplate lines; adds ``lines_before`` and ``lines_dropped``."""
    taken = [c for c in ("lines_before", "lines_dropped") if c in pages.columns]
    bad = dropped_lines(pages, host, F.col(text), ratio, least, unit).select(F.col("host").alias("_host"), F.col("lines").alias("_bad"))
    joined = pages.drop(*taken).withColumn("_page_host", host).join(bad, F.col("_page_host").eqNullSafe(F.col("_host")), "left")
    lines = F.split(text, "\n")
    left = F.zip_with(lines, normal_lines(F.col(text)), lambda x, y: F.when((y == "") | ~F.array_contains("_bad", F.xxhash64(y)), x))
    joined = joined.withColumn("_kept", F.when(F.col("_bad").isNull(), lines).otherwise(F.array_compact(left)))
    joined = joined.withColumn("lines_before", F.coalesce(F.size(F.when(F.col(text).isNotNull(), lines)), F.lit(0)))
    joined = joined.withColumn("lines_dropped", F.when(F.col(text).isNull(), 0).otherwise(F.col("lines_before") - F.size("_kept")))
    return joined.withColumn(text, F.when(F.col("lines_dropped") > 0, F.array_join("_kept", "\n")).otherwise(F.col(text))).drop("_page_host", "_host", "_bad", "_kept")


# A page's visible text, one line per block.  Fixed lists of tags; entities are left as they are.
_HIDDEN = ("<!--.*?-->", "<script.*?</script>", "<style.*?</style>")
_BLOCK = "</?(?:p|div|li|ul|ol|nav|article|section|header|footer|h[1-6]|title|table|tr|br|body|head|html)[^>]*>"


def visible_lines(html: Column) -> Column:
    for pattern in _HIDDEN:
        html = F.regexp_replace(html, f"(?is){pattern}", "")
    html = F.regexp_replace(html, "[\\r\\n]+", " ")
    html = F.regexp_replace(html, f"(?is){_BLOCK}", "\n")
    return F.regexp_replace(html, "(?s)<[^>]*>", "")


def host_of(url: Column) -> Column:
    """The lower-case host of a URL without user and port; null where there is none."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.lower(F.when(found != "", found))
