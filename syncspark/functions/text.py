"""Text and number helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Everything up to and including the space counts as white space.
BLANKS = "".join(chr(code) for code in range(0x21))


def strip_blanks(value: Column) -> Column:
    return F.btrim(value, F.lit(BLANKS))


def trim_to_null(value: Column) -> Column:
    return F.nullif(strip_blanks(value), F.lit(""))


def is_blank(value: Column) -> Column:
    return trim_to_null(value).isNull()


def parse_csv(value: Column) -> Column:
    """Trimmed, non-empty tokens of a comma list; null when none is left."""
    tokens = F.filter(F.transform(F.split(value, ","), strip_blanks), lambda token: token != "")
    return F.when(F.size(tokens) > 0, tokens)


def create_csv(values: Column) -> Column:
    return F.array_join(values, ",", "null")


def node_int(value: Column, numeric: bool = False, strict: bool = True) -> Column:
    """Whole number of a value: numbers are truncated, text must be all digits.

    ``numeric`` says the column has a number type. With ``strict`` unusable text
    fails the query, otherwise it becomes null.
    """
    if numeric:
        return value.try_cast("int")
    digits = F.when(value.rlike(r"^[+-]?[0-9]+\z"), value.try_cast("int"))
    if not strict:
        return digits
    bad = value.isNotNull() & digits.isNull()
    return F.when(bad, F.raise_error(F.concat(F.lit("not a whole number: "), value))).otherwise(digits)
