"""Similarity of titles and candidates, and what is read from pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from quire.functions import text
from quire.functions.bind import let

#: Weights and floors of the candidate score (fixed values).
TITLE_FLOOR, ISBN_FLOOR, TITLE_WEIGHT, AUTHOR_WEIGHT, NO_OVERLAP = 0.75, 0.3, 0.6, 0.4, 0.5
#: Words that make a note in parentheses an edition's, not a series' (fixed values); so is a bare year.
EDITION_NOTES = "edition illustrated abridged unabridged reprint paperback hardcover boxed set omnibus annotated translated audiobook"
_NOTE = r"(?i)^(?:\d{4}|.*\b(?:" + EDITION_NOTES.replace("boxed set", "boxed_set").replace(" ", "|").replace("_", " ") + r")\b.*)$"
#: Marks of an image that stands for a missing cover (fixed values).
NO_COVER = ("nophoto", "no-photo", "no_photo")


@F.pandas_udf(DoubleType())
def _indel(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Twice the longest common subsequence over the summed lengths, by bit-parallel rows."""

    def ratio(a: str, b: str) -> float | None:
        if a is None or b is None:
            return None
        if not a or not b:
            return float(a == b)
        places: dict[str, int] = {}
        for i, letter in enumerate(a):
            places[letter] = places.get(letter, 0) | 1 << i
        whole = (1 << len(a)) - 1
        row = whole
        for letter in b:
            hit = row & places.get(letter, 0)
            row = (row + hit | row - hit) & whole
        return 2.0 * (len(a) - row.bit_count()) / (len(a) + len(b))

    for left, right in batches:
        yield pd.Series([ratio(a, b) for a, b in zip(left, right)], dtype="float64")


def tokens(column: Column) -> Column:
    """Distinct runs of ASCII letters and digits, case folded."""
    return F.array_distinct(F.regexp_extract_all(text.casefold(column), F.lit(r"[0-9a-z]+"), F.lit(0)))


def token_f1(x: Column, y: Column) -> Column:
    """F1 of two sets of tokens; null where they share none."""
    shared = F.size(F.array_intersect(x, y)).cast("double")
    return F.when(shared > 0, 2 * shared / (F.size(x) + F.size(y)))


def similarity(a: Column, b: Column) -> Column:
    """F1 of the two token sets; without a common token, half the indel ratio; 0 where one has no token."""
    some = F.coalesce(F.size(tokens(a)) > 0, F.lit(False)) & F.coalesce(F.size(tokens(b)) > 0, F.lit(False))
    f1 = let(F.struct(tokens(a).alias("x"), tokens(b).alias("y")), lambda both: token_f1(both["x"], both["y"]))
    strange = some & f1.isNull()
    low = lambda c: F.when(strange, text.casefold(F.trim(c)))
    return F.when(some, F.coalesce(f1, NO_OVERLAP * _indel(low(a), low(b)))).otherwise(F.lit(0.0))


def candidate_score(title: Column, author: Column, found_title: Column, found_author: Column) -> Column:
    """Weighted title and author similarity; 0 below the title floor; the title's alone where an author is missing."""
    return _score(similarity(title, found_title), similarity(author, found_author), (F.length(author) > 0) & (F.length(found_author) > 0))


def _score(by_title: Column, by_author: Column, both: Column) -> Column:
    return F.when(by_title < TITLE_FLOOR, 0.0).when(F.coalesce(both, F.lit(False)), TITLE_WEIGHT * by_title + AUTHOR_WEIGHT * by_author).otherwise(by_title)


def plausible(title: Column, found_title: Column) -> Column:
    """Whether a record found by ISBN can be the book asked for; blank titles pass."""
    blank = (F.length(F.trim(title)) == 0) | (F.length(F.trim(found_title)) == 0) | title.isNull() | found_title.isNull()
    return F.coalesce(blank, F.lit(True)) | (similarity(title, found_title) >= ISBN_FLOOR)


def split_by_author(column: Column) -> Column:
    """struct(title, author): cut at the last `` by ``."""
    form = r"(?is)^(.*)\s+by\s+(.*)$"
    cut = column.rlike(form)
    return F.struct(
        F.when(cut, F.trim(F.regexp_extract(column, form, 1))).otherwise(column).alias("title"), F.when(cut, F.trim(F.regexp_extract(column, form, 2))).alias("author")
    )


def title_series(title: Column) -> Column:
    """struct(name, position, bare) of a trailing ``(Name, #2.5)`` or ``(Name)``: the series and the title before it; null
    for edition notes and years, and where no title is left. A position that is no number is null."""
    form = r"\s*\(([^()]+?)(?:,\s*#([\d.]+))?\)\s*$"
    name, bare = F.trim(F.regexp_extract(title, form, 1)), F.trim(F.regexp_replace(title, form, ""))
    position = F.regexp_extract(title, form, 2)
    number = F.when(position.rlike(r"^(?:\d+\.?\d*|\.\d+)$"), position)
    found = title.rlike(form) & (F.length(name) > 0) & ~name.rlike(_NOTE) & (F.length(bare) > 0)
    return F.when(found, F.struct(name.alias("name"), number.alias("position"), bare.alias("bare")))


def aria_series(label: Column) -> Column:
    """struct(name, position) of ``Book N in the X series`` anywhere in a label; a position that is no number is null."""
    form = r"(?i)Book\s+([\d.]+)\s+in\s+the\s+(.+?)\s+series"
    position, name = F.regexp_extract(label, form, 1), F.trim(F.regexp_extract(label, form, 2))
    number = F.when(position.rlike(r"^(?:\d+\.?\d*|\.\d+)$"), position)
    return F.when(label.rlike(form) & (F.length(name) > 0), F.struct(name.alias("name"), number.alias("position")))


def series_id(href: Column, name: Column) -> Column:
    """The number of a ``/series/12-slug`` link, if its slug, where it has one, is the series' name."""
    form = r"(?i)/series/(\d+)(?:-([a-z0-9-]+))?"
    number, slug = F.regexp_extract(href, form, 1), F.regexp_extract(href, form, 2)
    return F.when((F.length(number) > 0) & ((slug == "") | (text.slug(slug) == text.slug(name))), number)


def cover(url: Column) -> Column:
    """A cover's address without its size and over https; null for images that stand for a missing cover."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(url), r"(?i)\._S[XY]\d+_(?=\.[a-z]{3,4}$)", ""), r"^http://", "https://")
    missing = F.lit(False)
    for mark in NO_COVER:
        missing = missing | F.lower(url).contains(mark)
    return F.when(~missing & (F.length(plain) > 0), plain)


def json_ld(page: Column) -> Column:
    """The first Book or Product block of a page's JSON-LD scripts, as variant."""
    scripts = F.regexp_extract_all(page, F.lit(r"(?is)<script[^>]*type=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"), F.lit(1))
    whole = F.transform(scripts, F.try_parse_json)
    listed = F.flatten(F.transform(whole, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.array(v))))
    kind = lambda v: F.try_variant_get(v, "$.@type", "string").isin("Book", "Product")
    return F.try_element_at(F.filter(listed, kind), F.lit(1))
