"""Column expressions for decoding and cleaning codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_codes(code: Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Label for each code; anything unlisted, NULL included, gets ``default`` (NULL if not given)."""
    decoded = F.lit(None).cast("string")
    if default is not None:
        decoded = F.lit(default)
    chain = None
    for value, label in labels.items():
        chain = F.when(code == value, label) if chain is None else chain.when(code == value, label)
    return chain.otherwise(decoded) if chain is not None else decoded


def merge_code(code: Column, old: str, new: str) -> Column:
    """Replace one code by another and leave the rest, NULL included, alone."""
    return F.when(code == old, new).otherwise(code)


def placeholder_to_null(text: Column, to_type: str, placeholder: str = "?") -> Column:
    """Number from text where the placeholder (or anything that is no number) is NULL."""
    return F.nullif(F.trim(text), F.lit(placeholder)).try_cast(to_type)


def blank_to(text: Column, label: str) -> Column:
    """Trimmed text with NULL and blanks unified into one label."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(label))


def is_blank(text: Column) -> Column:
    """True for a present value made of blanks only; a NULL is not blank."""
    return text.isNotNull() & (F.trim(text) == "")


def signed(kind: Column, amount: Column, credit: str) -> Column:
    """Amount with a plus for the credit kind and a minus for every other, NULL included."""
    return F.when(kind == credit, amount).otherwise(-amount)


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))
