"""Cleaning of names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The honorifics to remove, with or without a dot, in any case. A bare honorific
# needs a space behind it, so that a name such as "Drauzio" stays whole.
HONORIFIC = r"(?i)^(srta|sra|sr|dra|dr)(\s*\.\s*|\s+)"

# Labels of rows whose product is not in the catalogue.
UNREGISTERED_PRODUCT = "Produto nao cadastrado"
UNREGISTERED = "Não cadastrado"


def strip_honorific(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.trim(name), HONORIFIC, ""))


def has_honorific(name: Column) -> Column:
    return F.trim(name).rlike(HONORIFIC)


def title_case(name: Column) -> Column:
    return F.initcap(name)


def person_name(name: Column) -> Column:
    """The name without its honorific, in title case."""
    return title_case(strip_honorific(name))


def product_name(name: Column) -> Column:
    """One spelling per product name: no outer spaces, title case."""
    return title_case(F.trim(F.lower(name)))


def label_or(key: Column, value: Column, missing: str, unknown: str | None = None) -> Column:
    """``value``, but ``missing`` where the key found no match and ``unknown`` where the value is NULL."""
    found = value if unknown is None else F.coalesce(value, F.lit(unknown))
    return F.when(key.isNull(), F.lit(missing)).otherwise(found)
