"""Dates and categories derived from file and folder names (PTH-2..12).

Report files carry their snapshot date in the name. These functions turn a
name column (for example ``_metadata.file_name``) into typed values with
Column expressions, so a file listing of any size is classified on the
executors. Unparsable names give null, never an exception.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col_

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------

# Three-letter month prefixes in generation dates such as "(Oct 04 2022)".
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
# Generation-date patterns: "(Oct 04 2022)" first, then "__Oct_8_2025_".
PAREN_DATE = r"\(([A-Za-z]+)\s+(\d+)\s+(\d{4})\)"
UNDERSCORE_DATE = r"_+([A-Za-z]+)[_\s]+(\d+)[_\s]+(\d{4})_*"
# Part type of a cut-point file.
PART_TYPE_RULES = (("(?i)Part[_\\s]C", "Part_C"), ("(?i)Part[_\\s]D", "Part_D"))


def stem(c: str | Column) -> Column:
    """File name without its last extension."""
    s = col_(c)
    return F.when(F.instr(s, ".") > 0, F.regexp_extract(s, r"^(.*)\.[^.]*$", 1)).otherwise(s)


def base_name(c: str | Column) -> Column:
    """Last path component of a path or URI."""
    return F.substring_index(col_(c), "/", -1)


def parent_name(c: str | Column) -> Column:
    """Name of the folder that holds the file."""
    s = col_(c)
    return F.when(~F.contains(s, F.lit("/")), F.lit("")).otherwise(F.substring_index(F.substring_index(s, "/", -2), "/", 1))


def _safe_date(y: Column, m: Column, d: Column) -> Column:
    """make_date that gives null instead of failing on an invalid date. The
    guards are nested CASE branches, so ``make_date`` only sees valid
    parts."""
    ok = y.between(1, 9999) & m.between(1, 12) & d.between(1, 31)
    fits = d <= F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    return F.when(ok, F.when(fits, F.make_date(y, m, d)))


def year_month_suffix(c: str | Column) -> Column:
    """PTH-2: last 7 characters ``YYYY_MM`` / ``YYYY-MM`` -> first of month."""
    tail = F.replace(F.substring(col_(c), -7, 7), F.lit("_"), F.lit("-"))
    ok = tail.rlike(r"^[0-9]{4}-[0-9]{2}$")
    return F.when(ok, F.try_to_date(F.concat(tail, F.lit("-01")), "yyyy-MM-dd"))


def _year(c: str | Column) -> Column:
    """A year given as int or as text; null outside 1..9999 or when not a number."""
    y = col_(c).try_cast("int")
    return F.when(y.between(1, 9999), y)


def year_end(year: str | Column) -> Column:
    """PTH-3: a 4-digit year (text or int) -> Dec 31 of that year."""
    y = _year(year)
    return F.when(y.isNotNull(), F.make_date(y, F.lit(12), F.lit(31)))


def year_start(year: str | Column) -> Column:
    """PTH-3: a 4-digit year -> Jan 1 of that year."""
    y = _year(year)
    return F.when(y.isNotNull(), F.make_date(y, F.lit(1), F.lit(1)))


def two_digit_year(c: str | Column, pos: int = 3) -> Column:
    """PTH-4: two characters at ``pos`` (1-based) read as ``20yy``; returns
    the year as int (use with year_end)."""
    yy = F.substring(col_(c), pos, 2)
    return F.when(yy.rlike(r"^[0-9]{2}$"), F.concat(F.lit("20"), yy).cast("int"))


def tagged_year(c: str | Column, tag: str = "CY") -> Column:
    """PTH-5: the 4 digits after ``CY`` (``MPF_Benefit_CY2024``) as int."""
    s = F.regexp_extract(col_(c), tag + r"(\d{4})", 1)
    return F.when(s != "", s.cast("int"))


def quarter_start(folder: str | Column) -> Column:
    """PTH-6: ``pbp-benefits-2024-quarter-3`` -> 2024-07-01 (month 3q-2);
    ``pbp-benefits-2024`` (three tokens) -> 2024-01-01; other shapes null."""
    f = col_(folder)
    tokens = F.split(f, "-")
    n = F.size(tokens)
    year = _year(F.get(tokens, 2))
    q = F.get(tokens, 4)
    q = F.when(q.rlike(r"^[0-9]+$"), q.cast("int"))
    # a "quarter" name of another length falls through to the 3-token rule
    return (F.when((F.instr(f, "quarter") > 0) & (n == 5), _safe_date(year, q * 3 - 2, F.lit(1)))
            .when(n == 3, _safe_date(year, F.lit(1), F.lit(1))))


def compact_date(c: str | Column) -> Column:
    """PTH-7: trailing ``MMDDYYYY`` of a stem -> date."""
    tail = F.substring(col_(c), -8, 8)
    return F.when(tail.rlike(r"^[0-9]{8}$"), F.try_to_date(tail, "MMddyyyy"))


def _month_number(name: Column) -> Column:
    m = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    return F.coalesce(m[F.lower(F.substring(name, 1, 3))], F.lit(1))


def parenthesised_date(c: str | Column) -> Column:
    """PTH-8: generation date ``(Oct 11 2023)`` or ``__Oct_8_2025_`` -> date.
    An unknown month name counts as January; an impossible date is null."""
    s = col_(c)
    p1 = F.regexp_extract(s, PAREN_DATE, 0) != ""
    pick = lambda i: F.when(p1, F.regexp_extract(s, PAREN_DATE, i)).otherwise(
        F.regexp_extract(s, UNDERSCORE_DATE, i))
    month, day, year = pick(1), pick(2), pick(3)
    found = year != ""
    return F.when(found, _safe_date(year.cast("int"), _month_number(month), day.cast("int")))


def underscore_date(c: str | Column) -> Column:
    """PTH-9: ``..._2024_10_01_data`` / ``..._stars`` (10 characters before the
    5-character suffix), else the trailing 10 characters, ``YYYY_MM_DD``."""
    s = col_(c)
    n = F.length(s)
    body = F.when(s.endswith("_data") | s.endswith("_stars"),
                  F.substring(s, 1, n - F.when(s.endswith("_data"), 5).otherwise(6)))
    body = F.coalesce(body, s)
    tail = F.translate(F.substring(body, -10, 10), "_/", "--")
    return F.when(tail.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"),
                  F.try_to_date(tail, "yyyy-MM-dd"))


def path_year(c: str | Column) -> Column:
    """PTH-10: leading 4 digits of a folder or file name as int."""
    s = F.regexp_extract(col_(c), r"^(\d{4})", 1)
    return F.when(s != "", s.cast("int"))


def classify_name(c: str | Column, rules: Sequence[tuple[str, str]] = PART_TYPE_RULES,
                  default: str = "Unknown") -> Column:
    """PTH-11: the label of the first regex that matches, else ``default``."""
    s = col_(c)
    out = F.lit(default)
    for pattern, label in reversed(list(rules)):
        out = F.when(s.rlike(pattern), F.lit(label)).otherwise(out)
    return out


def year_range(year: str | Column) -> tuple[Column, Column]:
    """PTH-12: year -> (performance_date_start, performance_date_end)."""
    return year_start(year), year_end(year)


def paren_text_date(c: str | Column) -> Column:
    """Date written inside the first parentheses of a name, in any of the
    common forms: ``(Oct 11 2023)``, ``(October 11, 2023)``, ``(10/11/2023)``,
    ``(2023-10-11)``; null otherwise."""
    t = F.trim(F.replace(F.regexp_extract(col_(c), r"\(([^)]*)\)", 1), F.lit(","), F.lit("")))
    t = F.regexp_replace(t, r"\s+", " ")
    return F.when(t != "", F.coalesce(parenthesised_date(F.concat(F.lit("("), t, F.lit(")"))),
                                      F.try_to_date(t, "MMMM d yyyy"), F.try_to_date(t, "M/d/yyyy"),
                                      F.try_to_date(t, "yyyy-MM-dd")))
