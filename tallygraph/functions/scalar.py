"""Scalar column expressions. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Appointment metric -> status code.
APPOINTMENT_STATUS = {
    "Bike.Appointment": "0",
    "Bike.Outtime.Appointment": "1",
    "Bike.Cancel.Appointment": "2",
    "Bike.Auto.Cancel.Appointment": "3",
}

# Classification flag -> good (1) or bad (0).
GOOD_FLAG = {1: 0, 2: 0, 3: 1}


def words(text: Column) -> Column:
    """Words of a line: cut at blanks and tabs, empty pieces dropped."""
    return F.filter(F.split(text, "[ \t]"), lambda w: F.length(w) > 0)


def rounded(value: Column, digits: int = 2) -> Column:
    """Half-up rounding through a decimal, so that 0.285 gives 0.29."""
    return F.round(value.cast("decimal(18,6)"), digits).cast("double")


def fixed_point(value: Column, digits: int = 4) -> Column:
    """A double as an integer number of 10^-digits; independent of summation order."""
    return F.floor(value * (10**digits) + F.lit(0.5)).cast("bigint")


def epoch_millis(epoch: Column) -> Column:
    """Epoch in ms, from ms or from ten-digit seconds."""
    return F.when(F.length(epoch.cast("string")) == 10, epoch * 1000).otherwise(epoch)


def epoch_date(epoch: Column) -> Column:
    """Calendar date of an epoch in seconds or ms."""
    return F.timestamp_millis(epoch_millis(epoch)).cast("date")


def between_markers(text: Column, pattern: str, group: int = 1) -> Column:
    """First piece of the text the pattern captures, null when there is none."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(F.length(found) > 0, found)


def network_label(network: Column) -> Column:
    """Coarse network class of a reported network type."""
    kind = F.lower(network)
    return (
        F.when(kind == "2g", "2G")
        .when(kind.isin("3g", "4g"), "3G/4G")
        .when(kind == "wifi", "Wifi")
        .otherwise("其他")
    )


def appointment_status(metric: Column) -> Column:
    """Status code of an appointment metric, null for any other metric."""
    status = F.lit(None).cast("string")
    for name, code in APPOINTMENT_STATUS.items():
        status = F.when(metric == name, code).otherwise(status)
    return status


def property_digest(rel: Column, val: Column) -> Column:
    """MD5 identifier of a property value."""
    return F.md5(F.concat(rel.cast("string"), val.cast("string")))


def dot(a: Column, b: Column) -> Column:
    """Scalar product of two array columns."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, term: total + term,
    )


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two array columns."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double")),
        F.lit(0.0),
        lambda total, term: total + term * term,
    )
