"""Column expressions: code-prefix flags, dates, label lookups, class scores.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlab.functions.codes import ITEM_ID_TO_LABEL


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def prefix_match(code, sets: dict[int, list[str]]) -> Column:
    """True when substring(code, 1, k) is in the k-character list, for any k.

    NULL codes give NULL (callers turn that into 0 / drop the row).  Each
    ``isin`` over more than a handful of literals is planned as a hash-set test.
    """
    code = _c(code)
    return reduce(or_, [F.substring(code, 1, k).isin(list(codes)) for k, codes in sorted(sets.items())])


def prefix_flag(code, sets: dict[int, list[str]]) -> Column:
    """CASE WHEN <prefix matches> THEN 1 ELSE 0 END (NULL code -> 0)."""
    return F.when(prefix_match(code, sets), F.lit(1)).otherwise(F.lit(0))


def later_of(a, b) -> Column:
    """``a`` when a > b, else ``b``.  Kept as written: a NULL on either side yields ``b``
    (``greatest`` would skip NULLs instead)."""
    a, b = _c(a), _c(b)
    return F.when(a > b, a).otherwise(b)


def parse_date(c, fmt: str | None = None) -> Column:
    """Lenient date parse: a bad string becomes NULL instead of failing the job (ANSI-safe)."""
    c = _c(c)
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


def parse_us_date(c) -> Column:
    """``M/d/yyyy`` (accepts one- or two-digit month and day)."""
    return parse_date(c, "M/d/yyyy")


def parse_iso_date(c) -> Column:
    """``yyyy-MM-dd``, tolerating a trailing time of day."""
    c = _c(c)
    return F.coalesce(F.try_to_date(c), F.to_date(F.try_to_timestamp(c)))


def anchor_day(max_date="max_date", angus="angus") -> Column:
    """Last observation day: the anchor date, one day earlier for sepsis patients."""
    return F.when(_c(angus) == 1, F.date_sub(_c(max_date), 1)).otherwise(_c(max_date))


def vital_label(itemid="itemid") -> Column:
    """Chart item id -> vital label; ids outside the map give NULL."""
    itemid = _c(itemid)
    items = list(ITEM_ID_TO_LABEL.items())
    expr = F.when(itemid == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        expr = expr.when(itemid == k, F.lit(v))
    return expr


def nan_to_null(c) -> Column:
    """NaN -> NULL, so that avg / median / max skip it like pandas does."""
    c = _c(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def argmax_class(scores) -> Column:
    """0-based index of the largest score; ties go to the first index, and a NULL or NaN score leaves no class."""
    scores = _c(scores)
    known = F.forall(scores, lambda s: s.isNotNull() & ~F.isnan(s))
    return F.when(known, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))
