"""Link harvesting from crawled pages (LNK-1..7).

The scraping steps of the download scripts, re-aimed at a ``pages`` table
``(page_id, url, html)``: every predicate is a regex or date Column over the
whole page text, so millions of pages are processed as one scan. Fetching
and unzipping are out of scope (see README).

Markup is read with regular expressions, not a DOM: ``<a ... href="x">text</a>``
pairs, ``<tr>`` rows with their ``<td>`` cells, ``<li class=...>`` items and
``<p>`` paragraphs. Tags inside anchor or cell text are removed and the
common character entities decoded.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_, strip

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a\s*>"""
ROW = r"(?is)<tr[^>]*>(.*?)</tr\s*>"
CELL = r"(?is)<td[^>]*>(.*?)</td\s*>"
PARAGRAPH = r"(?is)<p[^>]*>(.*?)</p\s*>"
TAG = r"(?s)<[^>]*>"
# character entities decoded in link and cell text, in this order
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&amp;", "&"))


def text_of(c: str | Column) -> Column:
    """Visible text of a markup fragment: tags removed, entities decoded,
    whitespace runs kept as they are, ends stripped."""
    s = F.regexp_replace(col_(c), TAG, "")
    for ent, ch in ENTITIES:
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return strip(s)


def extract_links(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """LNK-1: one row per anchor with an href: ``(pos, href, link_text)``."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 1)
    texts = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), 2)
    z = pages.select(*keep, F.posexplode(F.arrays_zip(hrefs.alias("h"), texts.alias("t"))).alias("pos", "a"))
    return z.select(*keep, "pos", F.col("a.h").alias("href"), text_of(F.col("a.t")).alias("link_text"))


def filter_links(links: DataFrame, suffix: str = ".zip", words: Sequence[str] = ("Ratings", "Measures"),
                 href: str = "href", text: str = "link_text") -> DataFrame:
    """LNK-2: links whose target ends with ``suffix`` and whose text contains
    any of ``words`` (case-sensitive)."""
    cond = F.lit(False)
    for w in words:
        cond = cond | F.col(text).contains(w)
    return links.filter(F.col(href).endswith(suffix) & cond)


def site_root(url: str | Column) -> Column:
    """``https://host/a/b`` -> ``https://host``."""
    return F.regexp_extract(col_(url), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def absolute_link(href: str | Column, base: str | Column) -> Column:
    """LNK-3: ``/``-rooted links get the site root in front; links with a
    scheme stay; other relative links are resolved against the root too."""
    h = col_(href)
    b = base if isinstance(base, Column) else F.lit(base)
    return (F.when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), h)
            .when(h.startswith("/"), F.concat(b, h))
            .otherwise(F.concat(b, F.lit("/"), h)))


def table_rows(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """Rows of the page's tables: ``(row_pos, row_html, cells array<string>)``
    with cell text (tags removed)."""
    rows = pages.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(ROW), 1))
                        .alias("row_pos", "row_html"))
    cells = F.transform(F.regexp_extract_all(F.col("row_html"), F.lit(CELL), 1), lambda x: text_of(x))
    return rows.withColumn("cells", cells)


def first_href(fragment: str | Column) -> Column:
    """First anchor target inside a fragment ('' becomes null)."""
    h = F.regexp_extract(col_(fragment), ANCHOR, 1)
    return F.when(h != "", h)


def recent_rows(pages: DataFrame, as_of_year: int, years_back: int = 1, n_cells: int = 2,
                html: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """LNK-4: table rows with exactly ``n_cells`` cells whose last cell ends
    in a year at or after ``as_of_year - years_back``; returns the row's first
    link. The as-of year is an argument, not today."""
    rows = table_rows(pages, html, keep)
    last = F.try_element_at(F.col("cells"), F.lit(-1))
    year = F.substring(last, -4, 4)
    year = F.when(year.rlike(r"^[0-9]{4}$"), year.cast("int"))
    out = rows.filter((F.size("cells") == n_cells) & (year >= as_of_year - years_back))
    return out.select(*keep, "row_pos", last.alias("period"), year.alias("year"),
                      first_href("row_html").alias("href"))


def recent_months(pages: DataFrame, as_of: _dt.date, days: int = 90, n_cells: int = 2,
                  html: str = "html", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """LNK-5: table rows whose last cell ends in ``YYYY-MM`` no older than the
    month of ``as_of - days``."""
    threshold = (as_of - _dt.timedelta(days=days)).strftime("%Y-%m")
    rows = table_rows(pages, html, keep)
    last = F.try_element_at(F.col("cells"), F.lit(-1))
    ym = F.substring(last, -7, 7)
    out = rows.filter((F.size("cells") == n_cells) & ym.rlike(r"^[0-9]{4}-[0-9]{2}$") & (ym >= threshold))
    return out.select(*keep, "row_pos", ym.alias("year_month"), first_href("row_html").alias("href"))


def item_link(html: str | Column = "html", item_class: str | None = "field__item") -> Column:
    """LNK-6: target of the first link inside the first ``<li>`` (of the given
    class); null when that item holds no link."""
    cls = "" if item_class is None else rf"""[^>]*class\s*=\s*["'][^"']*\b{item_class}\b[^"']*["']"""
    item = F.regexp_extract(col_(html), rf"(?is)<li{cls}[^>]*>(.*?)</li\s*>", 1)
    return first_href(item)


def last_paragraph(html: str | Column = "html", drop_tag: str = "strong") -> Column:
    """Text of the page's last ``<p>`` with the ``<strong>`` part removed."""
    paras = F.regexp_extract_all(col_(html), F.lit(PARAGRAPH), 1)
    last = F.try_element_at(paras, F.lit(-1))
    last = F.regexp_replace(last, rf"(?is)<{drop_tag}\b[^>]*>.*?</{drop_tag}\s*>", "")
    return text_of(last)


def stamped_name(link: str | Column, period: str | Column) -> Column:
    """LNK-7: file stem of the link + ``-`` + report period + suffix
    (``/files/dir.zip`` with ``March 2024`` -> ``dir-March 2024.zip``)."""
    name = F.regexp_extract(col_(link), r"([^/]*)$", 1)
    has_ext = name.rlike(r"^.+\.[^.]*$")
    stem = F.when(has_ext, F.regexp_extract(name, r"^(.+)\.[^.]*$", 1)).otherwise(name)
    suffix = F.when(has_ext, F.regexp_extract(name, r"^.+(\.[^.]*)$", 1)).otherwise(F.lit(""))
    return F.concat(stem, F.lit("-"), col_(period), suffix)
