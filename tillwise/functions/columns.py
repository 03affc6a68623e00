"""Scalar expressions shared by the jobs. All of them stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwise import model

UNKNOWN_KEY = -1


def surrogate_key(natural: Column) -> Column:
    """Non-negative 64-bit key of a natural id; a missing id is the unknown member.

    The smallest long has no absolute value, so it is raised by one first.
    """
    hashed = F.greatest(F.xxhash64(natural), F.lit(-(2**63) + 1))
    return F.when(natural.isNull(), F.lit(UNKNOWN_KEY).cast("long")).otherwise(F.abs(hashed))


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_date(key: Column) -> Column:
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def week_ending(day: Column) -> Column:
    """The Sunday on which the week of ``day`` ends; a Sunday ends its own week."""
    return F.next_day(F.date_sub(day, 1), "SU")


def age_group(age: Column, strict: bool = False) -> Column:
    """Left-closed age bucket. ``strict`` gives NULL outside the covered ages."""
    inside = (age >= model.AGE_STRICT_LOW) & (age < model.AGE_STRICT_HIGH)
    bucket = F.when(age.isNull() | (~inside if strict else F.lit(False)), F.lit(None).cast("string"))
    for upper, label in model.AGE_BUCKETS:
        bucket = bucket.when(age < upper, label)
    return bucket.otherwise(model.AGE_LAST)


def labelled(code: Column, labels: dict) -> Column:
    """Label of a code; NULL for a code without one."""
    result = F.lit(None).cast("string")
    for value, label in labels.items():
        result = F.when(code == F.lit(value), label).otherwise(result)
    return result


def readable(text: Column, names: dict[str, str] | None = None) -> Column:
    """Replace technical column names in running text."""
    for raw, plain in (names or model.READABLE).items():
        text = F.replace(text, F.lit(raw), F.lit(plain))
    return text


def share(part: Column, total: Column, digits: int | None = None) -> Column:
    """Percent of a total; NULL when the total is zero."""
    percent = F.try_divide(part.cast("double") * 100, total.cast("double"))
    return percent if digits is None else F.round(percent, digits)


def ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def sample_order(key: Column, seed: int) -> Column:
    """A fixed pseudo-random order of rows: equal seeds give equal samples on every run."""
    return F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\n\x0b\f\r"))
