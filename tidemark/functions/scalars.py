"""Tolerant text-to-value parsers as Column expressions (SCL-1..20).

Every function takes a column name or ``Column`` and returns a ``Column``.
None of them is a Python UDF: they compile to Catalyst expressions, run in
whole-stage codegen on the executors and never move a row through Python.

Dirty report cells are text. The parsers follow one rule: junk becomes null
(``try_*`` functions behind a regex guard), except the ``*_strict`` variants,
which fail the job on the first bad cell (ANSI cast), as the source loaders
did for columns that must be clean.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the source behaviour for right results)
# ---------------------------------------------------------------------------

# Text a number may take: optional sign, digits with an optional fraction (or a
# bare fraction), optional exponent. Spark's try_cast also accepts "1.5d" and
# "1.5f"; this guard keeps the parsers to plain decimal text.
NUMERIC_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INTEGER_PATTERN = r"^[+-]?[0-9]+$"

# Tokens that the pandas CSV/Excel readers turn into missing values by default.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Zone names found in plan submission timestamps, mapped to tz database ids.
ZONE_NAMES = {
    "Atlantic Standard Time": "America/Halifax",
    "Central Daylight Time": "US/Central",
    "Central Standard Time": "US/Central",
    "Cuba Daylight Time": "America/Havana",
    "Eastern Daylight Time": "US/Eastern",
    "Eastern Standard Time": "US/Eastern",
    "Hawaiian Standard Time": "US/Hawaii",
    "India Standard Time": "Asia/Kolkata",
    "Mountain Daylight Time": "US/Mountain",
    "Mountain Standard Time": "US/Mountain",
    "Pacific Daylight Time": "US/Pacific",
    "Pacific Standard Time": "US/Pacific",
    "SA Western Standard Time": "America/La_Paz",
    "US Eastern Daylight Time": "US/Eastern",
    "US Mountain Standard Time": "US/Mountain",
    "Venezuela Standard Time": "America/Caracas",
    "West Pacific Standard Time": "Pacific/Port_Moresby",
    "EDT": "US/Eastern",
}
DEFAULT_ZONE_NAME = "Eastern Standard Time"

# Whitespace that Python's str.strip() removes for ASCII text.
_WS = "[ \\t\\n\\r\\f\\u000b]"
_WS_CHARS = " \t\n\r\f\u000b"


def col_(c: str | Column) -> Column:
    """Name or Column to Column."""
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Remove leading and trailing whitespace (tabs and newlines too); a
    character-set trim, no regex."""
    return F.btrim(col_(c), F.lit(_WS_CHARS))


def _map_literal(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


# ---------------------------------------------------------------------------
# Numbers
# ---------------------------------------------------------------------------

def parse_number(c: str | Column) -> Column:
    """SCL-3: text to double, null when the text is not a plain number."""
    s = strip(c)
    return F.when(s.rlike(NUMERIC_PATTERN), s.try_cast("double"))


def parse_money(c: str | Column, legacy: bool = False) -> Column:
    """SCL-1: ``$1,234.50`` -> 1234.5, ``($5.00)`` -> -5.0, junk -> null.

    ``legacy=True`` keeps two source slips: the parenthesis sign is dropped
    and thousands commas make the value null.
    """
    s = strip(F.replace(col_(c), F.lit("$"), F.lit("")))
    negative = s.startswith("(") & s.endswith(")")
    core = F.btrim(s, F.lit("()"))
    if legacy:
        return parse_number(core)
    value = parse_number(F.replace(core, F.lit(","), F.lit("")))
    return F.when(negative, -value).otherwise(value)


def parse_int_commas(c: str | Column) -> Column:
    """SCL-2: ``1,234`` -> 1234 (bigint); junk or a fraction -> null. Plain
    digits are cast as they are, exact up to the bigint range; a form such as
    ``5.0`` or ``1e3`` goes through a double and counts if it is whole."""
    s = F.replace(strip(c), F.lit(","), F.lit(""))
    v = parse_number(s)
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("bigint")).otherwise(
        F.when(v == F.floor(v), v.cast("bigint")))


def parse_number_strict(c: str | Column) -> Column:
    """SCL-4: text to double; the job fails on text that is not a number."""
    return strip(c).cast("double")


def parse_thousands(c: str | Column) -> Column:
    """SCL-5: strict double after removing thousands commas."""
    return F.replace(strip(c), F.lit(","), F.lit("")).cast("double")


def parse_percent(c: str | Column) -> Column:
    """SCL-6: ``85%`` -> 85.0, ``4`` -> 4.0, other text -> null."""
    return parse_number(F.replace(col_(c), F.lit("%"), F.lit("")))


def parse_int(c: str | Column) -> Column:
    """SCL-7: integer text to int, anything else (``*``, ``abc``, ``1.5``) null."""
    s = strip(c)
    return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("int"))


def zfill(c: str | Column, width: int) -> Column:
    """SCL-8: left-pad with zeros to ``width``; never cuts; a leading sign
    stays in front (``-1`` -> ``-01`` for width 3); null stays null."""
    s = col_(c)
    signed = F.substring(s, 1, 1).isin("+", "-")
    return (
        F.when(F.length(s) >= width, s)
        .when(signed, F.concat(F.substring(s, 1, 1),
                               F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0")))
        .otherwise(F.lpad(s, width, "0"))
    )


def extract_int(c: str | Column, pattern: str, group: int = 1) -> Column:
    """SCL-15: first regex group as int; null when nothing matches."""
    s = F.regexp_extract(col_(c), pattern, group)
    return F.when(s.rlike(INTEGER_PATTERN), s.try_cast("int"))


# ---------------------------------------------------------------------------
# Dates and times
# ---------------------------------------------------------------------------

def date_prefix(c: str | Column, fmt: str = "MM/dd/yyyy") -> Column:
    """SCL-9: first 10 characters as a date (``01/01/2024 0:00:00``)."""
    return F.try_to_date(F.substring(col_(c), 1, 10), fmt)


def parse_us_date(c: str | Column) -> Column:
    """SCL-10: strict ``M/d/yyyy``; the job fails on a bad date."""
    return F.to_date(col_(c), "M/d/yyyy")


def _two_digit_year_date(s: Column) -> Column:
    """``dd-MMM-yy`` with the C-library pivot: 69..99 -> 19xx, 00..68 -> 20xx."""
    m = F.regexp_extract(s, r"^([0-9]{2})-([A-Za-z]{3})-([0-9]{2})$", 0)
    yy = F.regexp_extract(m, r"([0-9]{2})$", 1).try_cast("int")
    century = F.when(yy >= 69, F.lit("19")).otherwise(F.lit("20"))
    full = F.concat(F.substring(m, 1, 7), century, F.substring(m, 8, 2))
    return F.try_to_timestamp(F.when(m != "", full), F.lit("dd-MMM-yyyy"))


def parse_zoned_timestamp(c: str | Column,
                          zones: Mapping[str, str] = ZONE_NAMES,
                          default_zone: str = DEFAULT_ZONE_NAME) -> Column:
    """SCL-11: ``01/02/2024 03:04:05 PM Central Standard Time`` to a UTC
    timestamp. The first 22 characters are the local time, the rest names the
    zone (default Eastern). When the zone is unknown or the time does not parse,
    the first 22 characters are tried as ``dd-MMM-yy`` (a date with no zone);
    anything else is null. Result type: TIMESTAMP (instant)."""
    s = col_(c)
    dt_part = F.substring(s, 1, 22)
    zone_text = strip(F.substring(s, 24, 1 << 30))
    zone_text = F.when(zone_text == "", F.lit(default_zone)).otherwise(zone_text)
    zone = _map_literal(zones)[zone_text]
    local = F.try_to_timestamp(dt_part, F.lit("MM/dd/yyyy hh:mm:ss a")).cast("timestamp_ntz")
    zoned = F.to_utc_timestamp(local.cast("timestamp"), zone)
    fallback = _two_digit_year_date(dt_part)
    return F.when(s.isNull(), None).when(
        zone.isNotNull() & local.isNotNull(), zoned).otherwise(fallback)


_THREE_PARTS = r"^[^/]*/[^/]*/[^/]*$"
_TWO_PARTS = r"^[^/]*/[^/]*$"


def _complete_token(tok: Column, position: str) -> Column:
    month = F.try_to_date(tok, "M/yyyy")
    if position == "end":
        month = F.last_day(month)
    return F.when(tok.rlike(_THREE_PARTS), F.try_to_date(tok, "M/d/yyyy")).when(tok.rlike(_TWO_PARTS), month)


def complete_month(c: str | Column, position: str = "start") -> Column:
    """SCL-13: ``MM/YYYY`` -> first (start) or last (end) day of that month;
    ``MM/DD/YYYY`` is taken as is; anything else is null."""
    return _complete_token(strip(c), position)


# first and last token of a period: runs of letters, digits and "/"
_FIRST_TOKEN = r"^[^0-9/a-zA-Z]*([0-9/a-zA-Z]+)"
_LAST_TOKEN = r"([0-9/a-zA-Z]+)[^0-9/a-zA-Z]*$"


def parse_period(c: str | Column) -> Column:
    """SCL-12: ``02/2025 – 05/2025`` -> struct(start DATE, end DATE).

    Every character other than letters, digits and ``/`` separates tokens; the
    first token is the start and the last the end (one token: both). Month
    tokens are completed to the first / last day. ``Not Applicable``, null and
    text without a parsable token give null dates. Two regex extractions per
    value, no arrays, so the whole expression stays in generated code."""
    s = col_(c)
    first = F.regexp_extract(s, _FIRST_TOKEN, 1)
    last = F.regexp_extract(s, _LAST_TOKEN, 1)
    return F.struct(_complete_token(first, "start").alias("start"),
                    _complete_token(last, "end").alias("end"))


def parse_range(c: str | Column) -> Column:
    """SCL-14: numbers in text to struct(lower, upper) bounds.

    Two or more numbers: first and last. One number: upper bound when the
    text holds ``<``, else lower bound. ``-?\\d+\\.?\\d*`` is kept as is, so
    ``0.5-0.8`` reads as 0.5 and -0.8."""
    s = col_(c)
    nums = F.regexp_extract_all(s, F.lit(r"(-?\d+\.?\d*)"), 1)
    n = F.size(nums)
    first = F.try_element_at(nums, F.lit(1)).try_cast("double")
    last = F.try_element_at(nums, F.lit(-1)).try_cast("double")
    has_lt = F.instr(s, "<") > 0
    return F.struct(
        F.when(n >= 2, first).when((n == 1) & ~has_lt, first).alias("lower"),
        F.when(n >= 2, last).when((n == 1) & has_lt, first).alias("upper"),
    )


# ---------------------------------------------------------------------------
# Text
# ---------------------------------------------------------------------------

def clean_text(c: str | Column, phrases: Iterable[str] = ("(Monday - Friday)", "\x96")) -> Column:
    """SCL-16: remove fixed phrases, then strip whitespace."""
    s = col_(c)
    for p in phrases:
        s = F.replace(s, F.lit(p), F.lit(""))
    return strip(s)


def flag_codes(c: str | Column, codes: Iterable[str] = ("NQ", "NR", "NB", "BR"),
               prefix: str = "rate_") -> dict[str, Column]:
    """SCL-17: one boolean per sentinel code, false (not null) when absent.
    Compute these from the raw text, before any numeric coercion."""
    s = col_(c)
    return {f"{prefix}{code.lower()}": F.coalesce(s == code, F.lit(False)) for code in codes}


def null_tokens(c: str | Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """SCL-18: the text tokens a pandas reader treats as missing become null."""
    s = col_(c)
    return F.when(~s.isin(*tokens), s)


def concat_label(code: str | Column, value: str | Column, sep: str = ": ") -> Column:
    """SCL-19: ``code: value``; null when either side is null."""
    return F.concat(col_(code), F.lit(sep), col_(value))


def _words(c: str | Column) -> Column:
    """Whitespace-separated words. After stripping, splitting on whitespace
    runs yields no empty word (an empty text gives an empty array), so no
    lambda is needed and the expression stays in generated code."""
    s = strip(c)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, f"{_WS}+"))


def last_token(c: str | Column) -> Column:
    """SCL-20: last whitespace-separated word of a heading."""
    return F.try_element_at(_words(c), F.lit(-1))


def all_but_last(c: str | Column) -> Column:
    """SCL-20: the heading without its last word, words joined by one space."""
    w = _words(c)
    return F.array_join(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), " ")


def split_heading(c: str | Column, sep: str = ":") -> tuple[Column, Column]:
    """RSH-5: ``C01: Name`` -> (``C01``, ``Name``): first and last part."""
    s = col_(c)
    return strip(F.substring_index(s, sep, 1)), strip(F.substring_index(s, sep, -1))
