"""Identifiers and numbers: ISBN, years, series positions, ratings, counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.bind import let

#: First and last year of publication taken for real (fixed values), and of an author's life.
YEARS = (1400, 2100)
LIFE_YEARS = (-3000, 2100)
#: More distinct ISBNs than this belong to a work, not to an edition (fixed value).
MOST_ISBNS = 8


def isbn_clean(column: Column) -> Column:
    """Without white space, hyphens and dashes; upper case."""
    return F.upper(F.regexp_replace(column, r"[\s\x{a0}\-\x{2010}-\x{2015}]", ""))


def _weighted(digits: Column, weights: list[int]) -> Column:
    parts = F.array(*[F.lit(w) for w in weights])
    each = F.transform(parts, lambda w, i: w * F.substring(digits, i + 1, F.lit(1)).cast("int"))
    return F.aggregate(each, F.lit(0), lambda total, x: total + x)


def isbn13_check_digit(twelve: Column) -> Column:
    return F.pmod(10 - _weighted(twelve, [1, 3] * 6) % 10, F.lit(10)).cast("string")


def isbn10_check_digit(nine: Column) -> Column:
    rest = F.pmod(11 - _weighted(nine, list(range(10, 1, -1))) % 11, F.lit(11))
    return F.when(rest == 10, F.lit("X")).otherwise(rest.cast("string"))


def to_isbn13(column: Column) -> Column:
    """13 valid digits (978 or 979, not 9790), converted from a valid ISBN-10 where need be; else null."""
    return let(isbn_clean(column), _clean_isbn13)


def _clean_isbn13(code: Column) -> Column:
    long = F.when(code.rlike(r"^97(?:8|9(?!0))\d{10}$"), code)
    short = F.when(code.rlike(r"^\d{9}[\dX]$"), code)
    valid = F.when(F.substring(long, 13, 1) == isbn13_check_digit(F.substring(long, 1, 12)), long)
    nine = F.when(F.substring(short, 10, 1) == isbn10_check_digit(F.substring(short, 1, 9)), F.substring(short, 1, 9))
    stem = F.concat(F.lit("978"), nine)
    return F.coalesce(valid, F.concat(stem, isbn13_check_digit(stem)))


def isbns13(column: Column) -> Column:
    """The valid ones of an array, converted, each once, in order."""
    return F.array_distinct(F.array_compact(F.transform(F.coalesce(column, F.array().cast("array<string>")), to_isbn13)))


def canonical_isbn(column: Column) -> Column:
    """The smallest of an array's ISBNs; null where there is none, or too many to be one edition's."""
    codes = isbns13(column)
    return F.when(F.size(codes).between(1, MOST_ISBNS), F.array_min(codes))


def roman_value(text: Column) -> Column:
    """Value of a canonical Roman numeral up to 3999, else null. The numeral's four decimal places are read separately."""
    form = r"^(M{0,3})(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})$"
    upper = F.upper(text)
    places = [
        ("", "M", "MM", "MMM"),
        ("", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"),
        ("", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"),
        ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"),
    ]
    value = F.lit(0)
    for k, names in enumerate(places):
        digit = F.array_position(F.array(*[F.lit(n) for n in names]), F.regexp_extract(upper, form, k + 1)) - 1
        value = value * 10 + digit
    return F.when(upper.rlike(form) & (F.length(upper) > 0), value.cast("int"))


def parse_year(column: Column) -> Column:
    """The first isolated run of four digits decides; without one, the first word of two or more Roman letters does."""
    digits = F.regexp_extract(column, r"(?<!\d)(\d{4})(?!\d)", 1)
    letters = F.regexp_extract(column, r"(?i)(?<![\p{L}\p{N}])([MDCLXVI]{2,})(?![\p{L}\p{N}])", 1)
    year = F.when(digits != "", digits.cast("int")).when(letters != "", roman_value(letters))
    return F.when(year.between(*YEARS), year.cast("smallint"))


def author_year(column: Column) -> Column:
    text = F.trim(column)
    year = F.when(text.rlike(r"^[+-]?\d{1,4}$"), text.cast("int"))
    return F.when(year.between(*LIFE_YEARS), year.cast("smallint"))


def series_position(column: Column) -> Column:
    """A finite decimal from 0 to 999999.99, else null; checked before it is rounded to two places."""
    text = F.trim(column)
    exact = F.when(text.rlike(r"^\+?\d*\.?\d+$|^\+?\d+\.$"), text.try_cast("decimal(20,6)"))
    return F.when((exact >= 0) & (exact <= F.lit("999999.99").cast("decimal(20,6)")), exact.cast("decimal(8,2)"))


def rating(column: Column) -> Column:
    value = F.trim(column).try_cast("decimal(10,4)")
    return F.when(value.between(0, 5), value.cast("decimal(3,2)"))


def positive_int(column: Column) -> Column:
    text = F.trim(column.cast("string"))
    value = F.when(text.rlike(r"^\d{1,9}$"), text.cast("int"))
    return F.when(value > 0, value)
