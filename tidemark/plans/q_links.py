"""Proof queries for link harvesting over the ``pages`` table (LNK-1..7)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from ..operators import links as L
from .catalog import query, table


def _sql(pattern: str) -> str:
    return pattern.replace("'", "''")


_TEXT_SQL = "regexp_replace({x}, '(?s)<[^>]*>', '', 'g')"


def _text_of_sql(x: str) -> str:
    s = _TEXT_SQL.format(x=x)
    for ent, ch in L.ENTITIES:
        s = f"replace({s}, '{_sql(ent)}', '{_sql(ch)}')"
    return f"regexp_replace({s}, '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g')"


_LINKS_SQL = f"""
WITH a AS (
  SELECT page_id, url, regexp_extract_all(html, '{_sql(L.ANCHOR)}', 1) AS hrefs,
         regexp_extract_all(html, '{_sql(L.ANCHOR)}', 2) AS texts
  FROM pages),
b AS (SELECT page_id, url, hrefs, texts, unnest(range(len(hrefs))) AS pos FROM a)
SELECT page_id, url, CAST(pos AS INTEGER) AS pos, hrefs[pos + 1] AS href, {_text_of_sql("texts[pos + 1]")} AS link_text FROM b
"""


@query("extract_links", "LNK-1", _LINKS_SQL)
def q_extract_links(spark, sf_dir):
    return L.extract_links(table(spark, sf_dir, "pages"))


@query("filter_links", "LNK-2 LNK-3", f"""
WITH l AS ({_LINKS_SQL})
SELECT page_id, pos,
       CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
            WHEN starts_with(href, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) || href
            ELSE regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1) || '/' || href END AS download_url
FROM l
WHERE ends_with(href, 'e') AND (contains(link_text, 'he') OR contains(link_text, 'an'))
""")
def q_filter_links(spark, sf_dir):
    links = L.extract_links(table(spark, sf_dir, "pages"))
    f = L.filter_links(links, suffix="e", words=("he", "an"))
    return f.select("page_id", "pos", L.absolute_link("href", L.site_root("url")).alias("download_url"))


@query("first_item_link", "LNK-6", f"""
SELECT page_id, nullif(regexp_extract(regexp_extract(html, '(?is)<li[^>]*>(.*?)</li\\s*>', 1),
                                      '{_sql(L.ANCHOR)}', 1), '') AS first_link
FROM pages
""")
def q_first_item_link(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", L.item_link("html", item_class=None).alias("first_link"))


@query("stamped_name", "LNK-7", f"""
WITH t AS (
  SELECT page_id,
         nullif(regexp_extract(regexp_extract(html, '(?is)<li[^>]*>(.*?)</li\\s*>', 1),
                               '{_sql(L.ANCHOR)}', 1), '') AS link,
         regexp_replace(regexp_extract_all(html, '{_sql(L.PARAGRAPH)}', 1)[-1],
                        '(?is)<b\\b[^>]*>.*?</b\\s*>', '', 'g') AS para
  FROM pages),
u AS (SELECT page_id, link, {_text_of_sql("para")} AS period,
             regexp_extract(link, '([^/]*)$', 1) AS fname FROM t)
SELECT page_id, period,
       CASE WHEN regexp_matches(fname, '^.+\\.[^.]*$')
            THEN regexp_extract(fname, '^(.+)\\.[^.]*$', 1) ELSE fname END
       || '-' || period ||
       CASE WHEN regexp_matches(fname, '^.+\\.[^.]*$') THEN regexp_extract(fname, '^.+(\\.[^.]*)$', 1)
            ELSE '' END AS file_name
FROM u
""")
def q_stamped_name(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    out = p.select("page_id", L.item_link("html", None).alias("link"),
                   L.last_paragraph("html", drop_tag="b").alias("period"))
    return out.select("page_id", "period", L.stamped_name("link", "period").alias("file_name"))


# Pages with a table of reports: a year and a month that follow from the page.
_WITH_TABLE = """(SELECT page_id, html || '<table><tr><td><a href="' || url || '">x</a></td><td>Report ' || (2019 + page_id % 8)
  || '</td></tr><tr><td><a href="/m">y</a></td><td>' || (2024 + page_id % 2) || '-0' || (1 + page_id % 9) || '</td></tr></table>' AS html
  FROM pages)"""


def _with_table(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    year, month = (F.lit(2019) + F.col("page_id") % 8).cast("string"), (F.lit(1) + F.col("page_id") % 9).cast("string")
    rows = F.concat(F.lit('<table><tr><td><a href="'), F.col("url"), F.lit('">x</a></td><td>Report '), year,
                    F.lit('</td></tr><tr><td><a href="/m">y</a></td><td>'), (F.lit(2024) + F.col("page_id") % 2).cast("string"),
                    F.lit("-0"), month, F.lit("</td></tr></table>"))
    return p.select("page_id", F.concat("html", rows).alias("html"))


_ROWS_SQL = f"""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '{_sql(L.ROW)}', 1)) AS row_html FROM {_WITH_TABLE}),
c AS (SELECT page_id, row_html, list_transform(regexp_extract_all(row_html, '{_sql(L.CELL)}', 1),
                                               lambda x: {_text_of_sql("x")}) AS cells FROM r)
"""


@query("recent_rows", "LNK-4", _ROWS_SQL + """
SELECT page_id, cells[-1] AS period, CAST(right(cells[-1], 4) AS INTEGER) AS year FROM c
WHERE len(cells) = 2 AND regexp_matches(right(cells[-1], 4), '^[0-9]{4}$') AND TRY_CAST(right(cells[-1], 4) AS INTEGER) >= 2024
""")
def q_recent_rows(spark, sf_dir):
    return L.recent_rows(_with_table(spark, sf_dir), as_of_year=2025).select("page_id", "period", "year")


@query("recent_months", "LNK-5", _ROWS_SQL + """
SELECT page_id, right(cells[-1], 7) AS year_month, '/m' AS href FROM c
WHERE len(cells) = 2 AND regexp_matches(right(cells[-1], 7), '^[0-9]{4}-[0-9]{2}$')
  AND right(cells[-1], 7) >= '2025-04'
""")
def q_recent_months(spark, sf_dir):
    rows = L.recent_months(_with_table(spark, sf_dir), as_of=_dt.date(2025, 6, 30))
    return rows.select("page_id", "year_month", "href")
