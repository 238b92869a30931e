"""Text clean-up, keys and display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_text(value: Column) -> Column:
    return value.cast("string")


def is_blank(value: Column) -> Column:
    """NULL, empty or only spaces. Never NULL itself."""
    return value.isNull() | (F.trim(as_text(value)) == "")


def code(value: Column) -> Column:
    """State and country codes: padding removed, upper case."""
    return F.upper(F.trim(as_text(value)))


def lower_text(value: Column) -> Column:
    return F.lower(as_text(value))


def null_if_blank(value: Column) -> Column:
    return F.nullif(F.trim(as_text(value)), F.lit(""))


def surrogate_key(tag: Column, identifier: Column) -> Column:
    """md5 of the system tag followed by the id; NULL when the id is NULL."""
    return F.md5(F.concat(tag, as_text(identifier)))


def truthy(value: Column) -> Column:
    """TRUE, the number 1, "true" and "1" count as true; everything else, NULL included, as false."""
    number = F.typeof(value).rlike("^(float|double|decimal)")
    return F.coalesce(F.when(number, value.try_cast("double") == 1).otherwise(as_text(value).isin("true", "1")), F.lit(False))


def text_or(value: Column, fallback: Column) -> Column:
    """NULL and empty text give the fallback."""
    return F.when(value != "", value).otherwise(fallback)


def title_from_slug(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("_"), F.lit(" ")))


def check_label(test_name: Column) -> Column:
    return title_from_slug(F.regexp_replace(test_name, "^assert_no_", ""))


def state_label(name: Column, state_code: Column) -> Column:
    with_name = F.format_string("%s (%s)", name, state_code)
    return F.when(name != "", with_name).otherwise(text_or(state_code, F.lit("—")))


def tier_label(tier: Column) -> Column:
    return text_or(F.replace(F.lower(tier), F.lit("_"), F.lit(" ")), F.lit("—"))
