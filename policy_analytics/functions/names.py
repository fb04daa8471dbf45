"""Column-name rules (C1, C2). Plan-time only: they touch ``df.columns``, never rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Canonical column names per table type and the aliases that map to
# them. The canonical names carry no underscore. "r_ckkaufswert" is what the name rule
# makes of the German umlaut spelling, so both spellings map to surrender_value.
ALIASES = {
    "contracts": {
        "contract_id": "contractid", "contractid": "contractid",
        "customer_id": "customerid", "customerid": "customerid",
        "mandant_id": "mandantid", "mandantid": "mandantid",
    },
    "customers": {
        "customer_id": "customerid", "customerid": "customerid",
        "birth_date": "birthdate", "birthdate": "birthdate",
        "date_of_birth": "birthdate", "dob": "birthdate",
    },
    "timeseries": {
        "contract_id": "contractid", "contractid": "contractid",
        "rueckkaufswert": "surrender_value", "rückkaufswert": "surrender_value",
        "r_ckkaufswert": "surrender_value", "surrender_value": "surrender_value",
        "value": "surrender_value",
        "date": "date", "datum": "date",
    },
}


def normalise_name(name: str) -> str:
    """lower(trim) -> non ``[a-z0-9_]`` to ``_`` -> collapse runs of ``_`` -> drop one trailing ``_``."""
    s = name.strip().lower()
    s = re.sub(r"[^a-z0-9_]", "_", s)
    s = re.sub(r"_{2,}", "_", s)
    return re.sub(r"_$", "", s)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column by :func:`normalise_name`."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def alias_renames(columns: list[str], table_type: str) -> dict[str, str]:
    """The renames for ``table_type``; two sources of one target raise."""
    mapping = ALIASES.get(table_type, {})
    renames: dict[str, str] = {}
    targets: dict[str, str] = {}
    for c in columns:
        t = mapping.get(c)
        if t is None:
            continue
        if t in targets:
            raise ValueError(f"columns {targets[t]!r} and {c!r} both map to {t!r}")
        targets[t] = c
        if c != t:
            renames[c] = t
    clash = [c for c in columns if c not in mapping and c in targets]
    if clash:
        raise ValueError(f"renamed columns collide with existing columns: {clash}")
    return renames


def standardise_columns(df: DataFrame, table_type: str) -> tuple[DataFrame, list[str]]:
    """C1 + C2: normalised, aliased frame and the ``"old -> new"`` rename log."""
    df = normalise_columns(df)
    renames = alias_renames(df.columns, table_type)
    log = [f"{o} -> {n}" for o, n in renames.items()]
    return (df.withColumnsRenamed(renames) if renames else df), log


def require(df: DataFrame, cols, what: str = "input") -> None:
    """Raise ``ValueError`` when a required column is absent (plan time, no job)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what} must contain columns {missing}; has {df.columns}")
