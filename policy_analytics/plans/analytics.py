"""Registered age queries."""

from __future__ import annotations

from ..operators import age
from ..sources import fixtures as fx
from .oracle import AGE, CLASSIFIED, age_band_case, q
from .registry import register

AS_OF_DATE = fx.AS_OF
CUSTOM_BREAKS = (25, 40, 60)
CUSTOM_LABELS = ("<25", "25-40", "40-60", ">60")


def classified(spark, sf_dir, breaks=age.DEFAULT_BREAKS, labels=age.DEFAULT_LABELS):
    return age.classify_age_groups(fx.customers(spark, sf_dir), AS_OF_DATE, breaks, labels)


@register("age_bands", q(f"""
SELECT customerid, birthdate, age, {age_band_case('age', (30, 50), ('<30', '30-50', '>50'))} AS age_group
FROM (SELECT customerid, birthdate, {AGE} AS age FROM customers WHERE birthdate IS NOT NULL) t"""))
def age_bands(spark, sf_dir):
    """A1+A2: customers with a birthdate, their age and default band."""
    return classified(spark, sf_dir)


@register("age_bands_custom", q(f"""
SELECT customerid, birthdate, age, {age_band_case('age', CUSTOM_BREAKS, CUSTOM_LABELS)} AS age_group
FROM (SELECT customerid, birthdate, {AGE} AS age FROM customers WHERE birthdate IS NOT NULL) t"""))
def age_bands_custom(spark, sf_dir):
    """A3: the same operator with bands 25 / 40 / 60."""
    return classified(spark, sf_dir, CUSTOM_BREAKS, CUSTOM_LABELS)


@register("age_distribution", q("""
SELECT b.age_group, CAST(coalesce(c.n, 0) AS BIGINT) AS customers,
       coalesce(round(100.0 * coalesce(c.n, 0) / sum(coalesce(c.n, 0)) OVER (), 1), 0.0) AS percentage
FROM (VALUES ('<30'), ('30-50'), ('>50')) b(age_group)
LEFT JOIN (SELECT age_group, count(*) AS n FROM classified WHERE age_group IS NOT NULL GROUP BY age_group) c
  ON b.age_group = c.age_group""", CLASSIFIED))
def age_distribution(spark, sf_dir):
    """A4: customers and share per band, empty bands listed with 0."""
    return age.age_distribution(classified(spark, sf_dir))


@register("age_overall", q("""
SELECT count(age) AS customers, round(min(age), 1) AS min_age, round(max(age), 1) AS max_age,
       round(avg(age), 1) AS mean_age, round(median(age), 1) AS median_age
FROM classified""", CLASSIFIED))
def age_overall(spark, sf_dir):
    """A5: youngest, oldest, mean and median age."""
    return age.age_overall(classified(spark, sf_dir))


@register("age_summary", q("""
SELECT age_group, count(*) AS count, round(min(age), 1) AS min_age, round(max(age), 1) AS max_age,
       round(avg(age), 1) AS mean_age, round(median(age), 1) AS median_age,
       round(stddev_samp(age), 1) AS std_age,
       round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS percentage
FROM classified GROUP BY age_group""", CLASSIFIED), headline=True)
def age_summary(spark, sf_dir):
    """A1+A2+A6: band summary with count, min, max, mean, median, sd and share."""
    return age.create_age_summary(classified(spark, sf_dir))
