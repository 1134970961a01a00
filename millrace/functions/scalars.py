"""Small scalar expressions shared by several operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_low(value: Column, floor: float = 1e-4) -> Column:
    return F.greatest(value, F.lit(floor))


def request_id(existing: Column) -> Column:
    """The given id, or a new random one where it is missing."""
    return F.coalesce(existing, F.uuid())


def content_id(*columns) -> Column:
    """An id that stays the same when the job is run again: a digest of the content."""
    return F.md5(F.to_json(F.struct(*columns)))


def iso_timestamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def window_id(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd_HHmm")


def days_before(moment: Column, days: int) -> Column:
    return moment - F.make_dt_interval(F.lit(days))


def milliseconds(seconds: Column, digits: int = 2) -> Column:
    return F.round(seconds * 1000, digits)


def default(value: Column, fallback) -> Column:
    return F.coalesce(value, F.lit(fallback))


def map_value(entries: Column, key: str, fallback=None) -> Column:
    found = F.try_element_at(entries, F.lit(key))
    return found if fallback is None else F.coalesce(found, F.lit(fallback))


def label_name(code: Column, names: dict) -> Column:
    """Code-to-name lookup by a literal map; unknown codes give null."""
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), code)
