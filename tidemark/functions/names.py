"""Header-name rules (PRJ-1, PRJ-2, PRJ-11).

These act on column *names* only, on the driver, before the plan runs; no
data passes through them. The same rules are exposed as Column functions so
that header cells held as data (cell tables, RSH-2..4) are normalised on the
executors with the identical result.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col_


def normalize_name(name: str | None) -> str:
    """``  Plan Enrollment `` -> ``plan_enrollment``;
    ``Out-of-Pocket (OOP)`` -> ``outofpocket_oop``.

    Trim, drop every character that is neither a word character nor
    whitespace, lower-case, and turn each run of whitespace into ``_``."""
    if name is None:
        return ""
    s = re.sub(r"[^\w\s]", "", str(name).strip())
    return re.sub(r"\s+", "_", s.strip()).lower()


def normalize_name_col(c: str | Column) -> Column:
    """Column twin of :func:`normalize_name` for header cells held as data."""
    s = F.regexp_replace(F.trim(col_(c)), r"[^\w\s]", "")
    s = F.regexp_replace(F.trim(s), r"\s+", "_")
    return F.lower(s)


def camel_name(name: str) -> str:
    """``CMSContractNumber`` -> ``c_m_s_contract_number``: drop non-word
    characters, put ``_`` before every capital but the first, lower-case."""
    s = re.sub(r"\W+", "", str(name))
    return re.sub(r"(?<!^)(?=[A-Z])", "_", s).lower()


def dedupe_names(names: Iterable[str]) -> list[str]:
    """Second ``X`` becomes ``X.1``, third ``X.2`` (as pandas names them)."""
    seen: dict[str, int] = {}
    taken = set()
    out = []
    for n in names:
        if n in seen or n in taken:
            k = seen.get(n, 0)
            cand = f"{n}.{k + 1}"
            while cand in taken:
                k += 1
                cand = f"{n}.{k + 1}"
            seen[n] = k + 1
            out.append(cand)
            taken.add(cand)
        else:
            seen[n] = 0
            out.append(n)
            taken.add(n)
    return out
