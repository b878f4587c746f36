"""EAN-13 arithmetic."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerforge.functions.text import digits


def check_digit(stem: Column) -> Column:
    """The check digit of the first twelve digits: weights 1 and 3 in turn. Null without twelve.

    Plain arithmetic on one number: a function of an array's elements would be interpreted, row by row.
    """
    return F.when(F.length(stem) >= 12, _check(F.substring(stem, 1, 12).try_cast("bigint")))


def _check(number: Column) -> Column:
    digit = lambda i: F.call_function("div", number, F.lit(10 ** (12 - i)).cast("bigint")) % 10
    odd, even = (sum((digit(i) for i in range(k + 2, 13, 2)), digit(k)) for k in (1, 2))
    return ((10 - (odd + 3 * even) % 10) % 10).cast("int")


def normalize_ean(raw: Column) -> Column:
    """Thirteen digits without spaces and dashes, a twelve-digit code led by 0; null if malformed, all zero or misprinted."""
    bare = F.regexp_replace(F.trim(raw), r"[ \-]", "")
    full = F.when(F.length(bare) == 12, F.concat(F.lit("0"), bare)).otherwise(bare)
    shaped = F.when(full.rlike("^[0-9]{13}$") & ~full.rlike("^0+$"), full)
    return F.when(F.substring(shaped, 13, 1) == check_digit(shaped).cast("string"), shaped)


def ean_from_stem(stem: Column) -> Column:
    return F.when(stem.rlike("^[0-9]{12}$"), F.concat(stem, check_digit(stem).cast("string")))


def ean_from_number(number: Column) -> Column:
    """Of a whole number of at most twelve digits: with zeros before it and its check digit behind it."""
    return F.concat(F.lpad(number.cast("string"), 12, "0"), _check(number.cast("bigint")).cast("string"))


def ean_from_code(prefix: Column, code: Column) -> Column:
    """From a seven-digit company prefix and a code's five digits."""
    number = F.regexp_replace(code, "[^0-9]", "")
    return F.when((F.length(number) == 5) & (F.length(prefix) == 7), ean_from_stem(F.concat(prefix, number)))


def plausible_barcode(raw: Column) -> Column:
    """Eight to fourteen digits that aren't all zero, else null."""
    return F.when(raw.rlike("^[0-9]{8,14}$") & ~raw.rlike("^0+$"), raw)


def retail_ean(raw: Column, prefixes: list[str]) -> Column:
    """A valid thirteen-digit barcode of one of the company prefixes; longer and shorter numbers are no retail barcodes."""
    bare = digits(F.trim(raw.cast("string")))
    ean = normalize_ean(F.when(F.length(bare) == 13, bare))
    return F.when(reduce(or_, (F.startswith(ean, F.lit(p)) for p in prefixes), F.lit(False)), ean)
