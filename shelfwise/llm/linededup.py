"""Line dedup by site-relative frequency.

Lines are the parts of a text between line feeds. For each site, the number of
its pages that contain a line is divided by the number of its pages; a line
over ``ratio`` and on at least ``min_pages`` pages of the site is boilerplate
there and goes from all of the site's pages. Lines of white space only always
stay. A null text stays null and holds no line but counts as a page; rows of a
null site stay as they are. Repeated rows count as pages of their own. A page
of which every line goes keeps an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import fresh
from shelfwise.session import cut_lineage

RATIO = 0.1
MIN_PAGES = 3


def boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """(site, lines): XXH64 of each site's boilerplate lines, at most a page's lines divided by ``ratio`` many."""
    pages = docs.select(F.col(site_col).alias("site"), F.col(text_col).alias("text")).where("site IS NOT NULL")
    totals = cut_lineage(pages.groupBy("site").agg(F.count("*").alias("pages")), "line-sites")
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.trim(F.translate(x, "\t\r\x0b\x0c", "    ")) != "")
    own = pages.select("site", F.explode(F.array_distinct(F.transform(lines, lambda x: F.xxhash64(x)))).alias("line"))
    counts = cut_lineage(own.groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages), "line-counts")
    often = counts.join(totals, "site").where(F.col("n") / F.col("pages") > ratio)
    return often.groupBy("site").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, site_col: str = "source", text_col: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, dropped: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with boilerplate lines gone from the
    text; ``dropped`` names a further column for their number."""
    site, known = fresh(docs, "line_site"), fresh(docs, "line_known")
    often = cut_lineage(boilerplate(docs, site_col, text_col, ratio, min_pages), "line-boilerplate")
    often = often.select(F.col("site").alias(site), F.col("lines").alias(known))
    joined = docs.join(often, docs[site_col] == often[site], "left")
    split = F.split(text_col, "\n", -1)
    kept = F.filter(split, lambda x: ~F.array_contains(known, F.xxhash64(x)))
    held = F.col(known).isNull() | F.col(text_col).isNull()
    columns = [F.when(held, F.col(text_col)).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else F.col(c)
               for c in docs.columns]
    if dropped:
        columns.append(F.when(held, 0).otherwise(F.size(split) - F.size(kept)).cast("long").alias(dropped))
    return joined.select(*columns)


SQL = r"""
WITH d AS (SELECT doc_id, source, text, row_number() OVER () AS r, string_split(text, chr(10)) AS ls FROM documents),
pages AS (SELECT source, count(*) AS pages FROM d WHERE source IS NOT NULL GROUP BY source),
l AS (SELECT DISTINCT source, r, unnest(ls) AS line FROM d WHERE source IS NOT NULL),
often AS (SELECT source, list(line) AS lines FROM (
    SELECT l.source, line FROM l JOIN pages USING (source)
    WHERE trim(line, chr(9) || chr(11) || chr(12) || chr(13) || ' ') <> ''
    GROUP BY l.source, line, pages.pages HAVING count(*) >= 3 AND count(*) / pages.pages > 0.1) GROUP BY source),
j AS (SELECT d.doc_id, d.text, ls, CASE WHEN lines IS NULL THEN ls ELSE list_filter(ls, lambda x: NOT list_contains(lines, x)) END AS kept
      FROM d LEFT JOIN often USING (source))
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE coalesce(array_to_string(kept, chr(10)), '') END AS text,
       CAST(CASE WHEN text IS NULL THEN 0 ELSE len(ls) - len(kept) END AS BIGINT) AS n_dropped FROM j
"""
