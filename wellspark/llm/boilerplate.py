"""Line dedup by site-relative frequency: lines on too large a share of a host's pages go.

Lines are counted as 64-bit hashes of host and line, once for each page, with partial sums before
the shuffle. What a host keeps as boilerplate is short whatever its size: at most (mean distinct
lines of its pages) / RATIO lines. That list joins the pages by host; Spark broadcasts it or
splits the hot hosts' pages, whichever its sizes call for.

Defined results: lines are compared without blanks, tabs and carriage returns at their ends;
blank lines are never counted and never dropped. A page without a host, or without text, stays
as it is. Repeated rows are pages of their own, unless ``alike`` groups texts: then the texts of a
group count as one page of their host, in a line's number of pages and in the host's alike.
Dropping leaves the other lines, and their order, as they were; a page that is boilerplate
throughout stays as an empty text. An empty table gives no rows. Other columns pass through,
whatever their names; one named like the count columns asked for is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.llm.order_minhash import node_of
from wellspark.llm.rows import named, stored

#: A line is boilerplate on more than this share of the host's pages, and on this many at least.
RATIO = 0.05
LEAST_PAGES = 5

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
UNSEEN = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->"
INLINE = r"(?i)</?(?:a|b|i|u|em|strong|span|small|sup|sub|code)(?:\s[^>]*)?>"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def host_of(url: Column) -> Column:
    """The host in lower case, null where the text is no address."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def html_lines(html: Column) -> Column:
    """The visible text, a line for each run between block tags."""
    text = F.regexp_replace(html, UNSEEN, "\n")
    text = F.regexp_replace(text, INLINE, "")
    text = F.regexp_replace(text, "<[^>]*>", "\n")
    for entity, sign in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _keys(host: Column, lines: Column) -> Column:
    """A hash for each line that is not blank; null for a blank one."""
    return F.transform(lines, lambda x: F.when(_bare(x) != "", F.xxhash64(host, _bare(x))))


def boilerplate(
    pages: DataFrame,
    host: str,
    text: str,
    ratio: float,
    least_pages: int,
    alike: DataFrame | None = None,
) -> DataFrame:
    """(site, keys): for each host with boilerplate the hashes of those lines."""
    here = named(host).isNotNull()
    keys = F.array_distinct(_keys(named(host), F.split(named(text), "\n"))).alias("keys")
    if alike is None:
        held = pages.where(here & named(text).isNotNull()).select(named(host).alias("site"), keys)
        lines = held.select("site", F.explode("keys").alias("key")).where(F.col("key").isNotNull())
        totals = pages.where(here).select(named(host).alias("site"))
    else:
        # Hashes travel, not texts: first once for each text of a host, then with its group.
        held = pages.where(here).select(named(host).alias("site"), node_of(named(text)).alias("node"), keys)
        held = held.groupBy("site", "node").agg(F.first("keys").alias("keys")).join(alike, "node")
        held = stored(held.select("site", F.col("keeper").alias("page"), "keys"), "lines")
        lines = held.select("site", "page", F.explode("keys").alias("key"))
        lines = lines.where(F.col("key").isNotNull()).distinct()
        totals = held.select("site", "page").distinct()
    counted = lines.groupBy("site", "key").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    return (
        counted.join(totals.groupBy("site").agg(F.count("*").alias("pages")), "site")
        .where(F.col("n") > ratio * F.col("pages"))
        .groupBy("site")
        .agg(F.collect_list("key").alias("keys"))
    )


def without_boilerplate(
    pages: DataFrame,
    *,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    counts: tuple[str, str] | None = None,
    alike: DataFrame | None = None,
) -> DataFrame:
    """``pages`` with ``text`` reduced to the lines that are no boilerplate of their host.

    ``alike`` (``order_minhash.keepers``: node, keeper) has the group of each text; the texts of a
    group count as one page of their host, and lines go from all of them.
    ``counts`` names two columns for the numbers of lines (that are not blank) and of those dropped.
    """
    # Written first, so that Spark knows its size and need not shuffle pages for a small one.
    sites = stored(boilerplate(pages, host, text, ratio, least_pages, alike), "boilerplate")
    # The row as one column, so that its columns may have any names.
    row = F.struct(*[named(c) for c in pages.columns]).alias("row")
    page = pages.select(row, named(host).alias("at"), named(text).alias("said"))
    lines = F.split("said", "\n")
    dropped = F.when(F.col("keys").isNotNull(), F.array_intersect(_keys(F.col("at"), lines), F.col("keys")))
    joined = page.join(sites, F.col("at") == F.col("site"), "left").withColumn("dropped", dropped)
    known = F.col("dropped").isNotNull() & (F.size("dropped") > 0)

    def stays(line: Column) -> Column:
        key = F.xxhash64(F.col("at"), _bare(line))
        return (_bare(line) == "") | ~F.array_contains("dropped", key)

    kept = F.filter(lines, stays)
    made = [F.when(known, F.array_join(kept, "\n")).otherwise(F.col("said")).alias("said")]
    if counts:
        n_lines = F.coalesce(F.size(F.filter(lines, lambda x: _bare(x) != "")), F.lit(0))
        n_kept = F.coalesce(F.size(F.filter(kept, lambda x: _bare(x) != "")), F.lit(0))
        made.append(F.when(F.col("said").isNotNull(), n_lines).otherwise(0).cast("long").alias("n"))
        made.append(F.when(known, n_lines - n_kept).otherwise(0).cast("long").alias("gone"))
    out = {c: F.col("row").getField(c) for c in pages.columns}
    out[text] = F.col("made.said")
    if counts:
        out[counts[0]], out[counts[1]] = F.col("made.n"), F.col("made.gone")
    found = joined.select("row", F.struct(*made).alias("made"))
    return found.select(*[c.alias(name) for name, c in out.items()])
