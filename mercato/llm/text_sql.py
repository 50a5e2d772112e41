"""Column expressions on words shared by the native operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, functions as F

ASCII_SPACE = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    other = text.rlike(r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]")
    return F.when(other, F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))


def words(text: Column, between: str) -> Column:
    return F.array_remove(F.split(text, between), "")


def ahead(a: Column | str, k: int) -> Column:
    """The array without its first k elements (start + length of a slice must stay below 2^31)."""
    return F.slice(a, k + 1, 1 << 30)


def joined(a: Column | str, b: Column | str) -> Column:
    """Element-wise hash of two arrays; where one has ended, of the other alone."""
    return F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))


def lower_of(a: Column | str, b: Column | str) -> Column:
    return F.zip_with(a, b, lambda x, y: F.least(x, y))
