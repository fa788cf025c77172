"""Contested and thin accounts resolved against recorded answers and pages, and what they add attached to known books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import pages
from quire.operators import contested, policy


def detail_updates(stored: dict[str, Column], told: dict[str, Column]) -> list[Column]:
    """Columns of an account after a page's detail: only what the page fills (no '', no empty list) replaces what is stored."""

    def filled(c: Column) -> Column:
        return F.when(F.length(c.cast("string")) > 0, c)

    return [F.coalesce(filled(told[name]), old).alias(name) if name in told else old.alias(name) for name, old in stored.items()]


def enrich(backlog: DataFrame, book_pages: DataFrame, edition_pages: DataFrame) -> DataFrame:
    """``backlog`` (source_id, ...) with what its page (source_id, markup) and, only where that has no ISBN or no year, its
    work's list of editions (work_id, markup) say: detail, edition, and ``outcome``: enriched, unchanged or missing."""
    seen = book_pages.select("source_id", "markup").withColumn("pieces", pages.page_pieces("markup"))
    detail = seen.select("source_id", pages.book_page(F.col("markup"), F.col("pieces")).alias("detail"))
    asked = backlog.join(detail, "source_id", "left")
    wanting = asked.where("detail is not null and (detail.isbn is null or detail.published is null) and detail.work_id is not null").select(F.col("detail.work_id").alias("work_id")).distinct()
    listed = edition_pages.join(wanting, "work_id", "left_semi").withColumn("pieces", pages.page_pieces("markup"))
    edition = listed.select("work_id", pages.first_edition(F.col("pieces")).alias("edition"))
    short = F.col("detail.isbn").isNull() | F.col("detail.published").isNull()
    joined = asked.withColumn("work_id", F.when(short, F.col("detail.work_id"))).join(edition, "work_id", "left").drop("work_id")
    some = F.coalesce(F.col("detail.description"), F.col("detail.isbn"), F.col("detail.published"), F.col("edition.isbn13"), F.col("edition.publisher")).isNotNull() | F.coalesce(F.size("detail.authors") > 0, F.lit(False))
    return joined.withColumn("outcome", F.when(F.col("detail").isNull(), "missing").when(some, "enriched").otherwise("unchanged"))


def attach(observations: DataFrame, books: DataFrame) -> DataFrame:
    """``observations`` (book_id, isbn13, ...) re-keyed to their known book (book_id, identity_key): ``refused`` where the
    observation's ISBN is not the book's."""
    known = books.select("book_id", F.col("identity_key").alias("known_key"))
    joined = observations.join(known, "book_id")
    isbn = F.when(F.col("known_key").startswith("isbn:"), F.substring("known_key", 6, 13))
    refused = F.coalesce(F.col("isbn13") != isbn, F.lit(False))
    return joined.withColumn("refused", refused).withColumn("identity_key", F.when(~refused, F.col("known_key"))).drop("known_key")


def resolve_contested(payloads: DataFrame, answers: DataFrame, minimum: int, limit: int, arbiter: str, threshold: int) -> DataFrame:
    """The most contested books beside the arbiter's recorded answers (book_id, failed, payload): ``outcome`` resolved,
    unresolved, failed, or skipped once so many failures in a row have opened the circuit."""
    wanted = contested.find_contested(payloads, minimum, limit, skip_source=arbiter)
    asked = wanted.join(answers.select("book_id", "failed", "payload"), "book_id", "left").withColumn("__all", F.lit(0)).withColumn("__order", -F.col("conflicts"))
    failed = F.coalesce("failed", F.lit(False))
    tried = policy.breaker(asked, ["__all"], ["__order", "book_id"], failed, F.lit(False), threshold)
    outcome = F.when(F.col("open"), "skipped").when(failed, "failed").when(F.col("payload").isNotNull(), "resolved").otherwise("unresolved")
    return tried.select("book_id", "conflicts", outcome.alias("outcome"), F.when(outcome == "resolved", F.col("payload")).alias("payload"))
