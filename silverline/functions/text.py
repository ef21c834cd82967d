"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(value: Column, null_policy: str = "null") -> Column:
    """True for NULL, and under the `blank` policy also for empty or whitespace text."""
    if null_policy == "null":
        return value.isNull()
    if null_policy == "blank":
        return value.isNull() | (F.trim(value) == "")
    raise ValueError(f"unknown null policy: {null_policy}")


def blank_to_null(value: Column, trim: bool = True) -> Column:
    """NULL for blank text; the trimmed value otherwise."""
    return F.nullif(F.trim(value) if trim else value, F.lit(""))


def strip_money(value: Column) -> Column:
    """Remove currency signs and thousands separators."""
    return F.translate(value, "$,", "")


def base_id(value: Column, separators: Sequence[str]) -> Column:
    """The part in front of the first listed separator that occurs, else the whole value."""
    out = value
    for mark in reversed(separators):
        out = F.when(F.contains(value, F.lit(mark)), F.split_part(value, F.lit(mark), F.lit(1))).otherwise(out)
    return out


def revision_text(value: Column, separators: Sequence[str]) -> Column:
    """The part after the first listed separator that occurs; '0' when none does."""
    out = F.lit("0")
    for mark in reversed(separators):
        out = F.when(F.contains(value, F.lit(mark)), F.split_part(value, F.lit(mark), F.lit(2))).otherwise(out)
    return out


def digits(value: Column) -> Column:
    """Only the digits of the text."""
    return F.regexp_replace(value, "[^0-9]", "")


def drop_first_non_digit(value: Column) -> Column:
    """Remove the first character that is not a digit, and only that one."""
    return F.regexp_replace(value, "(?s)^([0-9]*)[^0-9]", "$1")


def match_name(value: Column) -> Column:
    """Upper-case ASCII letters, digits and spaces: a form names can be matched on."""
    return F.upper(F.trim(F.regexp_replace(value, "[^A-Za-z0-9 ]", "")))


def part_count(value: Column, separator: str = ",") -> Column:
    """Number of separated parts, 0 for NULL or empty text."""
    return (
        F.when(value.isNull() | (F.length(value) == 0), F.lit(0))
        .otherwise(F.length(value) - F.length(F.replace(value, F.lit(separator), F.lit(""))) + 1)
        .cast("int")
    )


def has_text(value: Column) -> Column:
    """Not NULL and at least one character long (never NULL itself)."""
    return value.isNotNull() & (F.coalesce(F.length(value), F.lit(0)) > 0)


def row_hash(columns: Sequence[str], mode: str = "row", null_marker: str | None = None) -> Column:
    """md5 over the pipe-joined columns.

    `mode="first_column"` hashes only the first column, which is what a per-column expansion
    of the expression yields under the name `row_hash`. NULLs are left out of the join unless
    `null_marker` is given.
    """
    names = list(columns)[:1] if mode == "first_column" else list(columns)
    if mode not in ("row", "first_column"):
        raise ValueError(f"unknown row hash mode: {mode}")
    parts = [F.col(f"`{name}`").cast("string") for name in names]
    if null_marker is not None:
        parts = [F.coalesce(part, F.lit(null_marker)) for part in parts]
    return F.md5(F.concat_ws("|", *parts))
