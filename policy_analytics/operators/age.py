"""Age analytics (A1-A6): ages, age bands, band distribution and band summary.

Ages are ``round(days / 365.25, 1)`` on an injected ``as_of`` date, so the domain of an
age column is bounded (one value per 0.1 year), which keeps the exact ``median`` cheap
here: its per-group value map has at most a few thousand entries at any data size.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import require
from ..functions.stats import bin_left_closed, percent_of_total, rnd

# The default age bands and labels.
DEFAULT_BREAKS = (30, 50)
DEFAULT_LABELS = ("<30", "30-50", ">50")
DAYS_PER_YEAR = 365.25


def age_years(birthdate, as_of: dt.date, digits: int | None = 1) -> Column:
    """A1: ``round(datediff(as_of, birthdate) / 365.25, digits)``."""
    b = F.col(birthdate) if isinstance(birthdate, str) else birthdate
    return rnd(F.datediff(F.lit(as_of), b) / DAYS_PER_YEAR, digits)


def band_breaks(breaks: Sequence[float]) -> list[float]:
    return [0.0, *[float(b) for b in breaks], math.inf]


def classify_age_groups(customers: DataFrame, as_of: dt.date,
                        breaks: Sequence[float] = DEFAULT_BREAKS,
                        labels: Sequence[str] = DEFAULT_LABELS) -> DataFrame:
    """A2/A3: keep rows with a birthdate; add ``age`` and left-closed ``age_group``.

    Bands are ``[0, b1), [b1, b2), ..., [bk, inf)``; a negative age has no band. A column
    that is no date is an error when the frame is built; rows of which none has a birthdate are an
    error when it is read (one matching row ends that search). An empty table gives an empty result.
    """
    require(customers, ["birthdate"], "customers")
    kind = customers.schema["birthdate"].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"birthdate must be a date, not {kind.simpleString()}")
    if len(labels) != len(breaks) + 1:
        raise ValueError(f"{len(breaks)} breaks need {len(breaks) + 1} labels")
    born = F.col("birthdate").isNotNull()
    any_born = customers.where(born).select(F.lit(True).alias("found")).limit(1).scalar()
    none_born = F.when(any_born.isNull(), F.raise_error(F.lit("no customer has a valid birthdate")).cast("boolean"))
    return (customers.where(F.when(born, True).otherwise(F.coalesce(none_born, F.lit(False))))
            .withColumn("age", age_years("birthdate", as_of))
            .withColumn("age_group", bin_left_closed("age", band_breaks(breaks), labels)))


def age_distribution(classified: DataFrame, labels: Sequence[str] = DEFAULT_LABELS,
                     digits: int | None = 1) -> DataFrame:
    """A4: customers and % per band; every band listed (empty ones with 0), NULL band excluded.

    Rows are unordered (a set); order by ``label_rank`` for display.
    """
    spark = classified.sparkSession
    bands = spark.createDataFrame([(lab, i + 1) for i, lab in enumerate(labels)],
                                  "age_group string, band_rank int")
    counts = (classified.where(F.col("age_group").isNotNull())
              .groupBy("age_group").agg(F.count(F.lit(1)).alias("customers")))
    # counts are grouped by band, so at most one row per label: a proven broadcast bound
    out = (bands.join(F.broadcast(counts), "age_group", "left")
           .withColumn("customers", F.coalesce("customers", F.lit(0)).cast("long")))
    return (out.withColumn("percentage", F.coalesce(percent_of_total("customers", digits=digits), F.lit(0.0)))
            .drop("band_rank"))


def age_overall(classified: DataFrame, digits: int | None = 1) -> DataFrame:
    """A5: min / max / mean / median age over all classified customers."""
    a = F.col("age")
    return classified.agg(
        F.count(a).alias("customers"),
        rnd(F.min(a), digits).alias("min_age"),
        rnd(F.max(a), digits).alias("max_age"),
        rnd(F.avg(a), digits).alias("mean_age"),
        rnd(F.median(a), digits).alias("median_age"),
    )


def create_age_summary(classified: DataFrame, labels: Sequence[str] = DEFAULT_LABELS,
                       digits: int | None = 1) -> DataFrame:
    """Per band count, min, max, mean, median, sd and % of all; NULL band kept as a group.

    Rows are unordered (a set); order by ``label_rank("age_group", labels)`` for display.
    """
    require(classified, ["age_group", "age"], "age summary input")
    a = F.col("age")
    summary = classified.groupBy("age_group").agg(
        F.count(F.lit(1)).alias("count"),
        rnd(F.min(a), digits).alias("min_age"),
        rnd(F.max(a), digits).alias("max_age"),
        rnd(F.avg(a), digits).alias("mean_age"),
        rnd(F.median(a), digits).alias("median_age"),
        rnd(F.stddev_samp(a), digits).alias("std_age"),
    )
    return summary.withColumn("percentage", percent_of_total("count", digits=digits))
