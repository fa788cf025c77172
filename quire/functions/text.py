"""Text forms: folding, titles, authors, subjects, MARC codes, HTML."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Punctuation folded before comparison (fixed values): single and double quotes, dashes, no-break space.
PUNCTUATION = {
    "\u2018": "'", "\u2019": "'", "\u201a": "'", "\u201b": "'", "\u201c": '"', "\u201d": '"', "\u201e": '"',
    "\u2013": "-", "\u2014": "-", "\u2010": "-", "\u2011": "-", "\u00a0": " ",
}
#: White space as Unicode has it, with the separators U+001C to U+001F.
SPACES = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
#: A lifespan at the end of a name; a dash is what makes it one.
_LIFE_DATES = r",?\s*\p{Nd}{3,4}\s*-\s*\p{Nd}{0,4}\s*$"
#: Punctuation of names that says nothing (fixed values). Apostrophes and hyphens are part of a name.
_NAME_PUNCTUATION = r"[.,;:()\[\]]"


def squeeze(column: Column) -> Column:
    """White space of any kind as single blanks, none at the ends."""
    return F.trim(F.regexp_replace(column, SPACES, " "))


@F.pandas_udf(StringType())
def _compose_fold(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    table = str.maketrans(PUNCTUATION)
    for batch in batches:
        yield batch.map(lambda v: None if v is None else " ".join(unicodedata.normalize("NFC", v).translate(table).split()).casefold())


@F.pandas_udf(StringType())
def _strip_marks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda v: None if v is None else "".join(c for c in unicodedata.normalize("NFD", v) if not unicodedata.combining(c)))


def fold(column: Column) -> Column:
    """Composed, punctuation folded, white space squeezed, case folded.

    ASCII stays in the JVM; only other text goes through Arrow to be composed and case folded as Unicode has it.
    """
    ascii_only = column.rlike(r"^[\x00-\x7F]*$")
    return F.when(ascii_only, F.lower(squeeze(column))).otherwise(_compose_fold(F.when(~ascii_only, column)))


def title_form(column: Column) -> Column:
    folded = fold(column)
    return F.when(F.length(folded) > 0, folded)


subject_form = title_form


@F.pandas_udf(StringType())
def _casefold(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield batch.map(lambda v: None if v is None else v.casefold())


def casefold(column: Column) -> Column:
    """Case folded as Unicode has it; ASCII stays in the JVM."""
    ascii_only = column.rlike(r"^[\x00-\x7F]*$")
    return F.when(ascii_only, F.lower(column)).otherwise(_casefold(F.when(~ascii_only, column)))


def author_form(column: Column) -> Column:
    """A name for comparison: without life dates, given name first if exactly one comma parts two names, no accents."""
    bare = F.regexp_replace(fold(column), _LIFE_DATES, "")
    surname, given = F.trim(F.substring_index(bare, ",", 1)), F.trim(F.substring_index(bare, ",", -1))
    inverted = (F.regexp_count(bare, F.lit(",")) == 1) & (F.length(surname) > 0) & (F.length(given) > 0)
    turned = F.when(inverted, F.concat_ws(" ", given, surname)).otherwise(bare)
    flat = F.regexp_replace(turned, _NAME_PUNCTUATION, " ")
    marked = flat.rlike(r"[^\x00-\x7F]")
    clean = squeeze(F.when(marked, _strip_marks(F.when(marked, flat))).otherwise(flat))
    return F.when(F.length(clean) > 0, clean)


def strip_marc(column: Column) -> Column:
    """Without subfield codes such as ``$b``; a text without any is left as it is, one of nothing else is null."""
    code = r"[$|\x{2021}][a-z](?=" + SPACES[:-1] + ")"
    bare = squeeze(F.regexp_replace(column, code, ""))
    return F.when(column.rlike(code), F.when(F.length(bare) > 0, bare)).otherwise(column)


@F.pandas_udf(StringType())
def unescape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """HTML entities resolved."""
    for batch in batches:
        yield batch.map(lambda v: None if v is None else html.unescape(v))


def unescaped(column: Column) -> Column:
    """``unescape`` where there is an entity to resolve."""
    has = column.contains("&")
    return F.when(has, unescape(F.when(has, column))).otherwise(column)


def html_text(column: Column) -> Column:
    """Text of an HTML fragment: breaks and block ends as newlines (two at most), tags gone, then entities resolved, welded
    sentences parted; null if nothing is left."""
    blocks = F.regexp_replace(F.regexp_replace(column, r"(?i)<br\s*/?>", "\n"), r"(?i)</(?:p|div|li|h[1-6])>", "\n\n")
    plain = unescaped(F.regexp_replace(blocks, r"<[^>]+>", ""))
    parted = F.regexp_replace(F.regexp_replace(plain, r"([.!?])([A-Z])", "$1 $2"), r"[ \t]+", " ")
    around = SPACES.replace(r"\s", r" \t\r\f\x{0b}").replace("]+", "]*")
    out = F.regexp_replace(F.regexp_replace(F.regexp_replace(parted, around + r"\n" + around, "\n"), r"\n{3,}", "\n\n"), f"^{SPACES}|{SPACES}$", "")
    return F.when(F.length(out) > 0, out)


def slug(column: Column) -> Column:
    """Lower-case letters and digits with one hyphen between runs of them."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(column)), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
