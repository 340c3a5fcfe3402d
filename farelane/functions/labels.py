"""Decode codes to labels by value (never by position)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Licence codes of the ride-hail companies.
COMPANY_LABELS = {"HV0002": "Juno", "HV0003": "Uber", "HV0004": "Via", "HV0005": "Lyft"}
# Month names, January first.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July",
               "August", "September", "October", "November", "December"]
# Spark dayofweek 1..7 is Sunday..Saturday.
WEEKDAY_NAMES = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def _map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def company_label(c) -> Column:
    return F.element_at(_map(COMPANY_LABELS), F.col(c) if isinstance(c, str) else c)


def month_name(c) -> Column:
    return F.element_at(_map(dict(enumerate(MONTH_NAMES, 1))), F.col(c) if isinstance(c, str) else c)


def weekday_name(c) -> Column:
    return F.element_at(_map(dict(enumerate(WEEKDAY_NAMES, 1))), F.col(c) if isinstance(c, str) else c)


def with_labels(df: DataFrame, company="hvfhs_license_num", month=None, weekday=None) -> DataFrame:
    cols = {}
    if company and company in df.columns:
        cols["company"] = company_label(company)
    if month and month in df.columns:
        cols["month_name"] = month_name(month)
    if weekday and weekday in df.columns:
        cols["weekday_name"] = weekday_name(weekday)
    return df.withColumns(cols)
