"""Column -> Column functions used by staging and the facts.

All are built-in Spark expressions, so they stay inside whole-stage codegen
and never raise on bad input (ANSI-safe variants throughout): a malformed
row yields NULL, which the quality checks then count.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from cubewise.schemas import (
    COUNTY_FROM_CENTRE_PATTERN,
    COUNTY_PREFIX_PATTERN,
    EDGE_WHITESPACE_PATTERN,
    MONTH_NUMBERS,
    NATIONAL_CENTRE_LABEL,
    NATIONAL_COUNTY_LABEL,
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_part(c: Column | str, i: int) -> Column:
    """``i``-th space-separated token of a period label; NULL when absent.

    ``get`` (not ``[]``) so a label without a space gives NULL instead of
    failing the whole job.
    """
    return F.get(F.split(_c(c), " "), i)


def period_year(c: Column | str) -> Column:
    """'2021 January' -> '2021'."""
    return period_part(c, 0)


def period_month(c: Column | str) -> Column:
    """'2021 January' -> 'January'; '2021M01' -> NULL."""
    return period_part(c, 1)


def county_from_centre(c: Column | str) -> Column:
    """Centre label -> county label.

    The national total maps to the national label; otherwise the first
    ``, Co. <word>`` is extracted. No match gives NULL (not ''), so such
    centres drop out of the facts.
    """
    c = _c(c)
    extracted = F.nullif(F.regexp_extract(c, COUNTY_FROM_CENTRE_PATTERN, 1), F.lit(""))
    return F.when(c == F.lit(NATIONAL_CENTRE_LABEL), F.lit(NATIONAL_COUNTY_LABEL)).otherwise(extracted)


def trim_whitespace(c: Column | str) -> Column:
    """Strip leading and trailing whitespace of any kind (not only spaces)."""
    return F.regexp_replace(_c(c), EDGE_WHITESPACE_PATTERN, "")


def strip_county_prefix(c: Column | str) -> Column:
    """'Co. Galway' -> 'Galway'. The prefix needs whitespace after it, so
    'Co.Dublin' is kept as is."""
    return trim_whitespace(F.regexp_replace(_c(c), COUNTY_PREFIX_PATTERN, ""))


def _month_map() -> Column:
    return F.create_map(*chain.from_iterable(
        (F.lit(k), F.lit(v).cast("bigint")) for k, v in MONTH_NUMBERS.items()))


def month_number(c: Column | str) -> Column:
    """Month text -> 1..12: English short or full name in any case, else the
    text read as an integer, else NULL."""
    c = _c(c)
    return F.coalesce(F.try_element_at(_month_map(), F.lower(c)), c.try_cast("bigint"))


def month_start(year: Column | str, month_no: Column | str) -> Column:
    """(year text, month number) -> first day of that month, NULL if invalid."""
    m = _c(month_no)
    text = F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(m.cast("string"), 2, "0"))
    # Padding would cut a longer number to its first two digits.
    return F.when(m.between(1, 12), F.try_to_date(text, "yyyy-MM"))


def month_name(date: Column | str) -> Column:
    """Date -> English month name ('January')."""
    return F.date_format(_c(date), "MMMM")


def safe_cast(c: Column | str, type_name: str) -> Column:
    """Cast that yields NULL instead of failing."""
    return _c(c).try_cast(type_name)
