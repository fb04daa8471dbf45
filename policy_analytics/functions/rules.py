"""Value rules of the cleaning step as column expressions.

Every rule is a pure ``Column -> Column`` built from JVM functions, so it runs inside
whole-stage codegen; no Python UDF is involved.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Id formats, tenant domain and date bounds of the cleaning rules.
CONTRACT_ID_PATTERN = "^V[0-9]+$"
CUSTOMER_ID_PATTERN = "^K[0-9]+$"
TENANTS = ("LV1", "LV2")
MIN_BIRTHDATE = dt.date(1900, 1, 1)
MIN_SERIES_DATE = dt.date(1990, 1, 1)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_prefixed_id(c, letter: str, strict: bool = False) -> Column:
    """Keep ``letter`` and digits, ``^<letter>0*`` -> ``<letter>``, length < 2 -> NULL.

    Lower-case letters are deleted, so ``v12`` becomes ``12`` and is kept (X2); with
    ``strict=True`` anything not matching ``^<letter>[0-9]+$`` becomes NULL.
    """
    s = F.regexp_replace(_col(c).cast("string"), f"[^{letter}0-9]", "")
    s = F.regexp_replace(s, f"^{letter}0*", letter)
    # keep-if-long-enough written so that ``s`` is evaluated once (a CASE WHEN would
    # compute the regex chain for the test and again for the value)
    keep = f"^{letter}[0-9]+$" if strict else "^.{2,}$"
    return F.nullif(F.regexp_extract(s, keep, 0), F.lit(""))


def clean_contract_id(c="contractid", strict: bool = False) -> Column:
    return clean_prefixed_id(c, "V", strict)


def clean_customer_id(c="customerid", strict: bool = False) -> Column:
    return clean_prefixed_id(c, "K", strict)


def clean_tenant(c="mandantid", casefold: bool = False) -> Column:
    """Delete ``[^LV12]``, upper; ``LV.*1`` -> LV1, then ``LV.*2`` -> LV2; else NULL.

    Lower-case input loses its letters before upper-casing (X3) unless ``casefold``.
    """
    s = _col(c).cast("string")
    if casefold:
        s = F.upper(s)
    s = F.upper(F.regexp_replace(s, "[^LV12]", ""))
    return F.when(s.rlike("LV.*1"), F.lit("LV1")).when(s.rlike("LV.*2"), F.lit("LV2"))


def _iso_date(s: Column) -> Column:
    """Leading ``yyyy-M-d`` of ``s`` as a date; impossible dates give NULL."""
    return F.regexp_extract(s, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}", 0).try_cast("date")


def parse_date_multi(c, data_type: T.DataType | None = None) -> Column:
    """Per-row parse of ISO (optionally with a time part), ``yyyy/M/d``, ``d.M.yyyy``, ``d/M/yyyy``.

    A date or timestamp column is cast directly. Impossible dates give NULL. The
    non-ISO layouts are rewritten to ISO by one anchored regex each and cast, which is
    much cheaper than pattern-based parsing.
    """
    col = _col(c)
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    s = F.trim(col.cast("string"))
    return F.coalesce(
        _iso_date(s),
        _iso_date(F.regexp_replace(F.regexp_extract(s, r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$", 0), "/", "-")),
        _iso_date(F.regexp_replace(F.regexp_extract(s, r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$", 0),
                                   r"^([0-9]+)\.([0-9]+)\.([0-9]+)$", "$3-$2-$1")),
        _iso_date(F.regexp_replace(F.regexp_extract(s, r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", 0),
                                   r"^([0-9]+)/([0-9]+)/([0-9]+)$", "$3-$2-$1")),
    )


def parse_date_iso(c, data_type: T.DataType | None = None) -> Column:
    """ISO date (optionally followed by a time part); date/timestamp input is cast."""
    col = _col(c)
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    return _iso_date(F.trim(col.cast("string")))


def within_dates(d: Column, lo: dt.date, hi: dt.date) -> Column:
    """NULL outside ``[lo, hi]``.

    Clamp to ``[lo - 1 day, hi + 1 day]`` and turn the two sentinels into NULL, so the
    (costly) parsed date is evaluated once instead of once per test and once for the value.
    """
    below, above = F.lit(lo - dt.timedelta(days=1)), F.lit(hi + dt.timedelta(days=1))
    return F.nullif(F.nullif(F.least(F.greatest(d, below), above), below), above)


def signed_amount(c, data_type: T.DataType | None = None, decimal_comma: bool = False) -> Column:
    """Text -> delete ``[^0-9.-]`` -> double (unparseable NULL), negatives kept.

    Numeric input is cast directly (X4). ``decimal_comma`` reads ``1.234,56`` as 1234.56.
    """
    col = _col(c)
    if isinstance(data_type, T.NumericType):
        return col.cast("double")
    s = col.cast("string")
    if decimal_comma:
        s = F.regexp_replace(F.regexp_replace(s, r"\.", ""), ",", ".")
    return F.regexp_replace(s, "[^0-9.-]", "").try_cast("double")


def parse_amount(c, data_type: T.DataType | None = None, decimal_comma: bool = False) -> Column:
    """The amount of :func:`signed_amount`; negatives -> NULL; 0 kept."""
    v = signed_amount(c, data_type, decimal_comma)
    return F.when(v >= 0, v)


def is_missing_text(c) -> Column:
    """Missing in the quality sense: NULL, ``""``, ``"NULL"``, ``"null"``."""
    col = _col(c)
    return col.isNull() | col.cast("string").isin("", "NULL", "null")
