"""What a book's page and its list of editions say.

Markup is taken apart by Python's HTML parser in Arrow batches, which hands out raw pieces only (the structured-data scripts,
a description's markup, labels and links, the first edition's text); what they mean is read by column expressions.
Pages never fail a row: a piece that is missing or strange is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import numbers, similarity, text

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_PIECES = "scripts array<string>, description string, labels array<struct<label:string,href:string>>, edition string"
MONTHS = "January February March April May June July August September October November December"
MOST_EDITION = 2000


class _Pieces(HTMLParser):
    """Collects the pieces while it walks a page; elements that are open form a stack."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.scripts: list[str] = []
        self.labels: list[list[str | None]] = []
        self.description: list[str] | None = None
        self.editions: dict[str, list[str]] = {}
        self.stack: list[tuple[str, dict]] = []
        self.parted = True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._write(self.get_starttag_text() or "")
        self.parted = True
        held = dict(attrs)
        mark: dict = {}
        if tag == "script" and held.get("type") == "application/ld+json":
            self.scripts.append("")
            mark["script"] = True
        if held.get("aria-label"):
            self.labels.append([held["aria-label"], held.get("href")])
            mark["label"] = len(self.labels) - 1
        if tag == "a" and "/series/" in (held.get("href") or ""):
            for _, outer in self.stack:
                if "label" in outer and self.labels[outer["label"]][1] is None:
                    self.labels[outer["label"]][1] = held["href"]
        if held.get("data-testid") == "description" and self.description is None:
            self.description = []
            mark["description"] = True
        kind = "cell" if held.get("data-testid") == "editionCell" else "data" if "editionData" in (held.get("class") or "").split() else None
        if kind and kind not in self.editions:
            self.editions[kind] = []
            mark["edition"] = kind
        if tag not in _VOID:
            self.stack.append((tag, mark))

    def handle_endtag(self, tag: str) -> None:
        self.parted = True
        if tag in _VOID or all(open_tag != tag for open_tag, _ in self.stack):
            return
        while self.stack:
            open_tag, mark = self.stack.pop()
            if not mark.get("description"):
                self._write(f"</{open_tag}>")
            if open_tag == tag:
                break

    def _write(self, piece: str) -> None:
        if self.description is not None and any(mark.get("description") for _, mark in self.stack):
            self.description.append(piece)

    def _text(self, piece: str) -> None:
        self._write(piece)
        if self.stack and self.stack[-1][1].get("script"):
            self.scripts[-1] += piece
        elif not (self.stack and self.stack[-1][0] in ("script", "style")):
            for _, mark in self.stack:
                if "edition" in mark:
                    texts = self.editions[mark["edition"]]
                    # An entity does not part a text, a tag does.
                    if self.parted or not texts:
                        texts.append(piece)
                    else:
                        texts[-1] += piece
            self.parted = False

    handle_data = _text

    def handle_entityref(self, name: str) -> None:
        self._text(f"&{name};")

    def handle_charref(self, name: str) -> None:
        self._text(f"&#{name};")


def _walk(markup: str | None) -> tuple:
    walker = _Pieces()
    try:
        walker.feed(markup or "")
        walker.close()
    except (AssertionError, ValueError):
        pass
    edition = walker.editions.get("cell", walker.editions.get("data"))
    return (
        [s.strip() for s in walker.scripts if s.strip()], None if walker.description is None else "".join(walker.description), [tuple(p) for p in walker.labels],
        None if edition is None else "\n".join(edition),
    )


def page_pieces(markup: Column | str) -> Column:
    """struct(scripts, description, labels, edition) of a page's markup."""

    @F.pandas_udf(_PIECES)
    def take_apart(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([_walk(m) for m in batch], columns=["scripts", "description", "labels", "edition"])

    # Not run again for each piece that is asked for.
    return take_apart.asNondeterministic()(markup)


def _member(document: Column, name: str) -> Column:
    """A text member of a document that is no blank."""
    value = F.when(F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant")) == "STRING", F.try_variant_get(document, f"$.{name}", "string"))
    return F.when(F.length(F.trim(value)) > 0, value)


def json_ld_authors(document: Column) -> Column:
    """Every author of a document, in order, once: a text, an object with a name, or a list of either."""
    one = F.try_variant_get(document, "$.author", "variant")
    listed = F.when(F.schema_of_variant(one).startswith("ARRAY"), F.try_variant_get(one, "$", "array<variant>")).otherwise(F.array(one))
    name = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.try_variant_get(v, "$.name", "string"))
    names = F.filter(F.transform(F.coalesce(listed, F.array().cast("array<variant>")), lambda v: F.trim(name(v))), lambda n: F.length(n) > 0)
    return F.array_distinct(names)


def work_id(markup: Column) -> Column:
    return F.nullif(F.regexp_extract(markup, r"/work/editions/(\d+)", 1), F.lit(""))


def page_state_year(markup: Column) -> Column:
    """The year of the publication time in a page's own state, as text: epoch milliseconds say more than is known."""
    moment = F.nullif(F.regexp_extract(markup, r'"publicationTime"\s*:\s*(\d{10,})', 1), F.lit("")).try_cast("bigint")
    return F.year(F.timestamp_millis(F.when(moment < 253_402_300_800_000, moment))).cast("string")


def book_page(markup: Column, pieces: Column) -> Column:
    """struct(description, page_count, authors, isbn, published, work_id, series) of a book's page, given its ``page_pieces``."""
    blocks = F.flatten(F.transform(F.transform(pieces["scripts"], F.try_parse_json), lambda v: F.when(F.schema_of_variant(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>")).otherwise(F.array(v))))
    document = F.try_element_at(F.filter(blocks, lambda v: F.try_variant_get(v, "$.@type", "string").isin("Book", "Product")), F.lit(1))
    told = F.filter(F.transform(pieces["labels"], lambda p: F.struct(similarity.aria_series(p["label"]).alias("s"), p["href"].alias("href"), p["label"].alias("label"))), lambda p: p["s"].isNotNull())
    first = F.try_element_at(told, F.lit(1))
    series_id = similarity.series_id(first["href"], first["s"]["name"])
    series = F.when(first.isNotNull(), F.struct(
        first["s"]["name"].alias("name"), series_id.alias("source_series_id"), first["s"]["position"].alias("position"), series_id.isNotNull().alias("confirmed"), first["label"].alias("label")))
    return F.struct(
        F.coalesce(text.html_text(_member(document, "description")), text.html_text(pieces["description"])).alias("description"),
        numbers.positive_int(F.when(F.schema_of_variant(F.try_variant_get(document, "$.numberOfPages", "variant")) != "BOOLEAN", F.try_variant_get(document, "$.numberOfPages", "string"))).alias("page_count"),
        F.coalesce(json_ld_authors(document), F.array().cast("array<string>")).alias("authors"), _member(document, "isbn").alias("isbn"),
        F.coalesce(_member(document, "datePublished"), _member(document, "dateCreated"), page_state_year(markup)).alias("published"),
        work_id(markup).alias("work_id"), series.alias("series"),
    )


def first_edition(pieces: Column) -> Column:
    """struct(isbn13, published, publisher) of the first edition of a list; the others are other books' facts."""
    said = text.unescaped(pieces["edition"])
    isbn = F.nullif(F.regexp_extract(said, r"\b(97[89][\d-]{10,}|\d{9}[\dXx])\b", 1), F.lit(""))
    date = F.nullif(F.regexp_extract(said, r"((?:" + MONTHS.replace(" ", "|") + r")\s+(?:\d{1,2},\s*)?\d{4})", 1), F.lit(""))
    house = F.trim(F.regexp_extract(said, r"(?:Published(?:\s+[^\n]*?)??\s+by|Publisher:)\s*(.+)", 1))
    return F.struct(numbers.to_isbn13(isbn).alias("isbn13"), date.alias("published"), F.nullif(house, F.lit("")).alias("publisher"), F.substring(said, 1, MOST_EDITION).alias("edition_text"))
