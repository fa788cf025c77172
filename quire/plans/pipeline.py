"""Queries of sources, pages, resolution, run lifecycle and event consumers, and the SQL each is compared with.

Files and pages are made from the provider tables, so that what is read back can be told from the tables by SQL.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quire.functions import identity, numbers, pages, similarity, text
from quire.operators import enrichment, policy, runs, search, upsert
from quire.plans.catalogue import _CLEAN, _isbn13_sql, _marc_sql, _raw, _raw_accounts, _title_sql, query
from quire.session import cut_lineage, shared_folder, table
from quire.sources import readers
from quire.streaming import consumers, events


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Dumps, exports, manifests.
def _dump(spark: SparkSession, d: str) -> DataFrame:
    """Editions of a dump file made from the openlibrary records of raw_book, with lines that are none between them."""
    books = _raw(spark, d).where("source = 'openlibrary'")
    doc = F.to_json(F.struct(
        F.concat(F.lit("/books/"), F.col("record_id").cast("string")).alias("key"), "title", F.col("isbns").alias("isbn_13"),
        F.transform("languages", lambda c: F.struct(F.concat(F.lit("/languages/"), c).alias("key"))).alias("languages"),
        F.concat(F.lit("by "), F.get("authors", F.lit(0))["name"]).alias("by_statement"),
    ))
    kind = F.when(F.col("record_id") % 7 == 0, "/type/work").otherwise(readers.EDITION)
    line = F.concat_ws("\t", kind, F.lit("k"), F.lit("1"), F.lit("2020"), F.when(F.col("record_id") % 11 == 0, F.lit("{broken")).otherwise(doc))
    folder = _scratch(spark, "dump")
    books.orderBy("record_id").select(line.alias("value")).coalesce(1).write.option("compression", "gzip").text(folder)
    return readers.scan_dump(spark, folder)


@query(f"""SELECT record_id::VARCHAR AS candidate_key, trim(title) AS title, nullif(trim(authors[1].name, ' .'), '') AS author, (SELECT count(DISTINCT {_isbn13_sql('x')}) FROM unnest(isbns) t(x)) AS n_isbns
    FROM raw_book WHERE source = 'openlibrary' AND record_id % 7 <> 0 AND record_id % 11 <> 0 AND length(trim(title)) > 0
      AND (len(coalesce(languages, [])) = 0 OR list_has_any(languages, ['eng', 'en', 'ger']))
      AND (length(trim(authors[1].name, ' .')) > 0 OR (SELECT count({_isbn13_sql('x')}) FROM unnest(isbns) t(x)) > 0)""")
def dump_candidates(spark: SparkSession, d: str) -> DataFrame:
    found = readers.dump_candidates(_dump(spark, d), ["eng", "en", "ger"])
    return found.select("candidate_key", "title", F.try_element_at("authors", F.lit(1)).alias("author"), F.size("isbns").cast("long").alias("n_isbns"))


@query("""SELECT line, candidate_key FROM (SELECT row_number() OVER (ORDER BY record_id) AS line, record_id::VARCHAR AS candidate_key, * FROM raw_book WHERE source = 'openlibrary')
    WHERE record_id % 7 <> 0 AND record_id % 11 <> 0 AND length(trim(title)) > 0 AND length(trim(authors[1].name, ' .')) > 0 AND line >= 100 ORDER BY line LIMIT 150""")
def dump_resume(spark: SparkSession, d: str) -> DataFrame:
    """The next 150 candidates with an author from line 100 of a dump on."""
    named = readers.dump_candidates(_dump(spark, d)).where(F.size("authors") > 0)
    return readers.dump_slice(named, 0, 100, 150)[0].select("line", "candidate_key")


@query("""SELECT candidate_key, title, authors, languages FROM (SELECT 'gutendex:' || id AS candidate_key, trim(title) AS title, list_filter([trim(a.name) for a in authors], lambda n: length(n) > 0)[1:5] AS authors,
    coalesce(languages, [])[1:3] AS languages, row_number() OVER (PARTITION BY id ORDER BY fetched_at NULLS LAST, title) AS n FROM gutendex_page1
    WHERE length(trim(title)) > 0 AND id IS NOT NULL AND len(list_filter([trim(a.name) for a in authors], lambda n: length(n) > 0)) > 0) WHERE n = 1""")
def manifest_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of a listing written as a manifest, the first fetch of each, and read back."""
    listed = table(spark, d, "gutendex_page1")
    once = listed.groupBy("id").agg(F.min_by(F.struct(*listed.columns), F.when((F.length(F.trim("title")) > 0) & F.exists("authors", lambda a: F.length(F.trim(a["name"])) > 0), F.struct(F.col("fetched_at").isNull(), F.col("fetched_at"), F.col("title")))).alias("r")).where("r is not null").select("r.*")
    path = _scratch(spark, "manifest") + ".jsonl"
    readers.write_manifest(readers.listing_candidates(once), path, "candidate_key")
    return readers.read_manifest(spark, path, "candidate_key string, title string, authors array<string>, languages array<string>")


def _export(spark: SparkSession, d: str) -> DataFrame:
    cards = table(spark, d, "goodreads_autocomplete").select(
        F.col("bookid").alias("goodreadsId"), "title", F.array("author.name").alias("author"), F.col("avgrating").try_cast("double").alias("rating"), F.col("ratingscount").alias("ratingCount"), F.col("imageurl").alias("coverUrl"),
        F.col("card_rank").alias("position"),
    )
    folder = _scratch(spark, "export")
    # One array per part file, as an export is one array per file.
    rows = cards.select(F.spark_partition_id().alias("part"), F.to_json(F.struct(*cards.columns)).alias("r"))
    rows.groupBy("part").agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ","), F.lit("]")).alias("value")).select("value").write.text(folder)
    return readers.scan_export(spark, folder)


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE length(trim(bookid)) > 0 AND length(trim(title)) > 0) AS usable, count(*) FILTER (WHERE coalesce(length(trim(bookid)), 0) = 0) AS missing_id,
    count(*) FILTER (WHERE coalesce(length(trim(title)), 0) = 0) AS missing_title, ['author', 'coverUrl', 'goodreadsId', 'position', 'rating', 'ratingCount', 'title'] AS members FROM goodreads_autocomplete""")
def export_profile(spark: SparkSession, d: str) -> DataFrame:
    return readers.export_profile(_export(spark, d))


@query("""SELECT trim(bookid) AS book_id, trim(title) AS title, trim(author.name) AS author, card_rank AS position, count(*) AS n FROM goodreads_autocomplete
    WHERE length(trim(bookid)) > 0 AND length(trim(title)) > 0 GROUP BY 1, 2, 3, 4""")
def export_translation(spark: SparkSession, d: str) -> DataFrame:
    v = F.try_parse_json(readers.export_payload(F.col("record")))
    told = lambda path: F.try_variant_get(v, path, "string")
    rows = _export(spark, d).select(told("$.bookId").alias("book_id"), told("$.title").alias("title"), told("$.author.name").alias("author"), F.try_variant_get(v, "$._export.position", "int").alias("position"))
    return rows.where("book_id is not null").groupBy(*rows.columns).agg(F.count("*").alias("n"))


# Pages.
_MS = "(card_rank::BIGINT * 20000000000 + 400000000000)"


def _book_pages(spark: SparkSession, d: str) -> DataFrame:
    cards = table(spark, d, "goodreads_autocomplete")
    document = F.to_json(F.struct(F.lit("Book").alias("@type"), "title", F.array(F.struct("author.name"), F.struct(F.lit(" Ghost Writer ").alias("name"))).alias("author"), F.col("numpages").cast("string").alias("numberOfPages")))
    rank = F.col("card_rank").cast("string")
    slug = F.when(F.col("card_rank") % 2 == 0, F.concat(F.lit("the-loom-"), rank)).otherwise(F.lit("elsewhere"))
    markup = F.concat(
        F.lit('<html><head><script type="application/ld+json">{broken</script><script type="application/ld+json">'), document, F.lit('</script></head><body><div data-testid="description"><p>'),
        F.coalesce("description.html", F.lit("")), F.lit('</p><br>End.</div><div aria-label="Book '), rank, F.lit(" in the The Loom "), rank, F.lit(' series"><a href="/series/4'), rank, F.lit("-"), slug,
        F.lit('">x</a></div><a href="/work/editions/'), F.coalesce("workid", F.lit("")), F.lit('">all</a><script>{"publicationTime": '),
        (F.col("card_rank").cast("long") * 20_000_000_000 + 400_000_000_000).cast("string"), F.lit("}</script></body></html>"),
    )
    return cards.select("bookid", "card_rank", "fetched_at", markup.alias("markup"))


@query(f"""SELECT bookid, card_rank, fetched_at, CASE WHEN numpages > 0 THEN numpages END AS page_count, list_distinct(list_filter([trim(author.name), 'Ghost Writer'], lambda n: length(n) > 0)).list_sort() AS authors,
    nullif(regexp_extract(workid, '^[0-9]+'), '') AS work_id, year(make_timestamp({_MS} * 1000))::VARCHAR AS published, 'The Loom ' || card_rank AS series, card_rank::VARCHAR AS position,
    CASE WHEN card_rank % 2 = 0 THEN '4' || card_rank END AS series_id, card_rank % 2 = 0 AS confirmed FROM goodreads_autocomplete WHERE card_rank IS NOT NULL""")
def page_detail(spark: SparkSession, d: str) -> DataFrame:
    seen = _book_pages(spark, d).where("markup is not null").withColumn("p", pages.page_pieces("markup"))
    detail = seen.select("bookid", "card_rank", "fetched_at", pages.book_page(F.col("markup"), F.col("p")).alias("d"))
    return detail.select(
        "bookid", "card_rank", "fetched_at", "d.page_count", F.array_sort("d.authors").alias("authors"), "d.work_id", "d.published", F.col("d.series.name").alias("series"), "d.series.position",
        F.col("d.series.source_series_id").alias("series_id"), "d.series.confirmed",
    )


@query(f"""SELECT id, fetched_at, {_isbn13_sql("volumeinfo.industryidentifiers[1].identifier")} AS isbn13, 'June 19' || lpad((volumeinfo.pagecount % 100)::VARCHAR, 2, '0') AS published, nullif(trim(volumeinfo.publisher), '') AS publisher
    FROM googlebooks_volumes WHERE volumeinfo.pagecount IS NOT NULL AND coalesce(regexp_full_match(volumeinfo.industryidentifiers[1].identifier, '97[89][0-9-]{{10,}}|[0-9]{{9}}[0-9Xx]'), true)""")
def edition_detail(spark: SparkSession, d: str) -> DataFrame:
    told = table(spark, d, "googlebooks_volumes").where("volumeinfo.pagecount is not null").withColumn("isbn", F.get("volumeinfo.industryidentifiers", F.lit(0))["identifier"])
    told = told.where(F.coalesce(F.col("isbn").rlike(r"^(?:97[89][0-9-]{10,}|[0-9]{9}[0-9Xx])$"), F.lit(True)))
    year = F.lpad((F.col("volumeinfo.pagecount") % 100).cast("string"), 2, "0")
    escaped = F.regexp_replace(F.coalesce("volumeinfo.publisher", F.lit("")), "&", "&amp;")
    markup = F.concat(
        F.lit('<div><div data-testid="editionCell"><div>Paperback, 300 pages</div><div>Published June 19'), year, F.when(F.length(F.trim(escaped)) > 0, F.concat(F.lit(" by "), escaped)).otherwise(F.lit("")), F.lit("</div><div>ISBN "), F.coalesce("isbn", F.lit("none")),
        F.lit('</div></div><div data-testid="editionCell"><div>Published May 1901 by Nobody</div><div>9780306406157</div></div></div>'),
    )
    found = told.select("id", "fetched_at", pages.first_edition(pages.page_pieces(markup)).alias("e"))
    return found.select("id", "fetched_at", "e.isbn13", "e.published", "e.publisher")


@query("""SELECT bookid, card_rank, fetched_at, CASE WHEN html IS NOT NULL THEN nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'),
    '([.!?])([A-Z])', '\\1 \\2', 'g'), '[ \\t]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), ' ' || chr(10)), '') END AS description FROM (SELECT *, description.html AS html FROM goodreads_autocomplete)""")
def html_clean(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "goodreads_autocomplete").select("bookid", "card_rank", "fetched_at", text.html_text(F.col("description.html")).alias("description"))


# Scalar forms that no other query reaches.
@query("""SELECT id, position, CASE WHEN birth_year BETWEEN -3000 AND 2100 THEN birth_year END AS birth_year, CASE WHEN try_cast(trim(name) AS INT) BETWEEN -3000 AND 2100 THEN try_cast(trim(name) AS INT) END AS in_name, n FROM (
    SELECT id, position, a.birth_year AS birth_year, a.name AS name, count(*) AS n FROM (SELECT id, unnest(range(len(authors))) AS position, unnest(authors) AS a FROM gutendex_page1) GROUP BY 1, 2, 3, 4)""")
def author_years(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "gutendex_page1").select("id", F.posexplode("authors").alias("position", "a")).groupBy("id", "position", "a").agg(F.count("*").alias("n"))
    return rows.select("id", F.col("position").cast("long").alias("position"), numbers.author_year(F.col("a.birth_year").cast("string")).cast("int").alias("birth_year"), numbers.author_year(F.col("a.name")).cast("int").alias("in_name"), "n")


@query(f"""SELECT record_id, position, CASE WHEN confirmed AND length(sid) > 0 THEN 'srcseries:' || source || ':' || sid ELSE 'series:' || sha256(form) END AS series_key FROM (
    SELECT record_id, source, position, m.confirmed AS confirmed, m.source_series_id AS sid, {_title_sql('m.name')} AS form FROM (SELECT record_id, source, unnest(range(len(series))) AS position, unnest(series) AS m FROM raw_book))""")
def series_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw(spark, d).select("record_id", "source", F.posexplode("series").alias("position", "m"))
    key = identity.series_key(F.col("source"), F.col("m.source_series_id"), F.col("m.name"), F.col("m.confirmed"))
    return rows.select("record_id", F.col("position").cast("long").alias("position"), key.alias("series_key"))


@query("""SELECT bookid, card_rank, fetched_at, CASE WHEN try_cast(trim(avgrating) AS DECIMAL(10,4)) BETWEEN 0 AND 5 THEN try_cast(trim(avgrating) AS DECIMAL(10,4))::DECIMAL(3,2) END AS rating,
    CASE WHEN numpages > 0 THEN numpages END AS pages, CASE WHEN ratingscount > 0 AND ratingscount < 1000000000 THEN ratingscount::INT END AS ratings FROM goodreads_autocomplete""")
def scalar_coercions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "goodreads_autocomplete").select("bookid", "card_rank", "fetched_at", numbers.rating(F.col("avgrating")).alias("rating"), numbers.positive_int(F.col("numpages")).alias("pages"), numbers.positive_int(F.col("ratingscount")).alias("ratings"))


@query("""SELECT p_partkey, sha256('{"a":' || p_size || ',"b":{"c":"' || p_brand || '","d":[1,2]}}') AS hash FROM part""")
def payload_hash_order(spark: SparkSession, d: str) -> DataFrame:
    """The hash of JSON whose members stand in another order and with white space between."""
    payload = F.concat(F.lit('{ "b" : {"d":[1, 2], "c":"'), "p_brand", F.lit('"},\n "a":'), F.col("p_size").cast("string"), F.lit("}"))
    return table(spark, d, "part").select("p_partkey", identity.payload_hash(payload).alias("hash"))


@query("""SELECT record_id, CASE WHEN title IS NOT NULL THEN CASE WHEN len(authors) > 0 AND authors[1].name IS NOT NULL THEN title || ' by ' || authors[1].name ELSE title END END AS lookup, isbns[1] AS preferred_isbn FROM raw_book""")
def lookup_queries(spark: SparkSession, d: str) -> DataFrame:
    author = F.get("authors", F.lit(0))["name"]
    lookup = F.when(F.col("title").isNotNull(), F.concat_ws(" by ", "title", author))
    return _raw(spark, d).select("record_id", lookup.alias("lookup"), F.get("isbns", F.lit(0)).alias("preferred_isbn"))


_WORDS = "list_distinct(regexp_extract_all(lower({0}), '[0-9a-z]+'))"
_F1 = "(2.0 * len(list_intersect({0}, {1})) / (len({0}) + len({1})))"


@query(f"""WITH asked AS (SELECT record_id, {_WORDS.format('title')} AS t, {_WORDS.format('authors[1].name')} AS a FROM raw_book WHERE source = 'gutendex' AND authors[1].name IS NOT NULL AND title IS NOT NULL),
    cards AS (SELECT DISTINCT bookid, {_WORDS.format('booktitlebare')} AS t, {_WORDS.format('author.name')} AS a FROM goodreads_autocomplete WHERE bookid IS NOT NULL AND booktitlebare IS NOT NULL AND author.name IS NOT NULL),
    met AS (SELECT DISTINCT x.record_id, y.bookid, x.t, y.t AS u, x.a, y.a AS b FROM (SELECT *, unnest(a) AS w FROM asked) x JOIN (SELECT *, unnest(a) AS w FROM cards) y ON x.w = y.w WHERE length(x.w) > 3 AND len(list_intersect(x.t, y.t)) > 0),
    scored AS (SELECT record_id, bookid, CASE WHEN {_F1.format('t', 'u')} < 0.75 THEN 0.0 ELSE 0.6 * {_F1.format('t', 'u')} + 0.4 * {_F1.format('a', 'b')} END AS score, {_F1.format('t', 'u')} >= 0.3 AS plausible FROM met)
    SELECT record_id, bookid, round(score, 6) AS score, plausible, place FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY score DESC, bookid) AS place FROM scored WHERE score >= 0.5) WHERE place <= 3""")
def candidate_score(spark: SparkSession, d: str) -> DataFrame:
    """The three best cards for each listed title, among those that share a word of the author's name and of the title."""
    author, most = F.get("authors", F.lit(0))["name"], 3
    words = lambda c: F.array_sort(similarity.tokens(c))
    # Words are read once per row, in tables: read per pair, each use of them would be a Python worker of its own.
    asked = _raw(spark, d).where("source = 'gutendex'").where(author.isNotNull() & F.col("title").isNotNull())
    asked = cut_lineage(asked.select("record_id", words(F.col("title")).alias("t"), words(author).alias("a")).distinct())
    cards = table(spark, d, "goodreads_autocomplete").where("bookid is not null and booktitlebare is not null and author.name is not null")
    # Variants of one card count once: those of one set of words score alike.
    cards = cut_lineage(cards.select(F.col("bookid").alias("index"), words(F.col("booktitlebare")).alias("u"), words(F.col("author.name")).alias("b")).distinct())
    # Cards of the same words score alike too, so only the first of them can be among the best.
    first = cards.withColumn("i", F.row_number().over(Window.partitionBy("u", "b").orderBy("index"))).where(F.col("i") <= most).drop("i")
    by_title, by_author = similarity.token_f1(F.col("t"), F.col("u")), similarity.token_f1(F.col("a"), F.col("b"))
    scored = search.like_titles(asked, cards, similarity.TITLE_FLOOR).join(first, ["u", "b"])
    scored = scored.select("t", "a", "index", similarity._score(by_title, by_author, F.lit(True)).alias("score"), (by_title >= similarity.ISBN_FLOOR).alias("plausible"))
    best = policy.ranked_answers(scored, ["t", "a"], 0.5, most).drop("place")
    return policy.ranked_answers(asked.join(best, ["t", "a"]), ["record_id"], 0.5, most).select("record_id", F.col("index").alias("bookid"), F.round("score", 6).alias("score"), "plausible", "place")


# Resolution and policies.
@query(f"""WITH asked AS (SELECT record_id, {_title_sql('title')} AS k, page_count FROM raw_book),
    ol AS (SELECT {_title_sql('title')} AS k, min(CASE WHEN fetched_at IS NULL THEN 5 WHEN len(author_name) > 0 THEN 1 ELSE 2 END) AS s FROM openlibrary_search GROUP BY 1),
    gb AS (SELECT {_title_sql('volumeinfo.title')} AS k, min(CASE WHEN fetched_at IS NULL THEN 5 WHEN len(volumeinfo.authors) > 0 THEN 1 ELSE 2 END) AS s FROM googlebooks_volumes GROUP BY 1),
    found AS (SELECT record_id, coalesce(page_count = 300, false) AS kept, coalesce(ol.s, 3) AS o, coalesce(gb.s, 3) AS g FROM asked LEFT JOIN ol ON asked.k = ol.k LEFT JOIN gb ON asked.k = gb.k),
    names AS (SELECT ['resolved', 'partial', 'no_match', 'contract_failure', 'unavailable'] AS n)
    SELECT record_id AS candidate_key, 'retained' AS source, 0 AS attempt_no, 'resolved' AS outcome FROM found WHERE kept
    UNION ALL SELECT record_id, 'openlibrary', 1, CASE WHEN kept THEN 'skipped' ELSE n[o] END FROM found, names UNION ALL SELECT record_id, 'googlebooks', 2, CASE WHEN kept OR o = 1 THEN 'skipped' ELSE n[g] END FROM found, names""")
def attempt_outcomes(spark: SparkSession, d: str) -> DataFrame:
    asked = _raw(spark, d).select(F.col("record_id").alias("candidate_key"), text.title_form(F.col("title")).alias("k"), "page_count")

    def answers(name: str, source: str, title: str, authors: str) -> DataFrame:
        state = F.when(F.col("fetched_at").isNull(), "unavailable").when(F.size(authors) > 0, "resolved").otherwise("partial")
        rows = table(spark, d, name).select(text.title_form(F.col(title)).alias("k"), state.alias("state")).distinct()
        return rows.join(asked.select("candidate_key", "k"), "k").select("candidate_key", F.lit(source).alias("source"), "state")

    told = answers("openlibrary_search", "openlibrary", "title", "author_name").unionByName(answers("googlebooks_volumes", "googlebooks", "volumeinfo.title", "volumeinfo.authors"))
    _, attempts = policy.resolve_candidates(asked, told, ["openlibrary", "googlebooks"], retained=F.col("page_count") == 300)
    return attempts.select("candidate_key", "source", "attempt_no", "outcome")


@query("""SELECT event_id, least(60.0, coalesce(CASE WHEN value > 150 THEN value END, 0.5 * 2 ** (event_id % 8))) AS retry, least(300.0, 10.0 * 6.0 ** (event_id % 4)) AS blocked FROM events""")
def retry_waits(spark: SparkSession, d: str) -> DataFrame:
    attempt = (F.col("event_id") % 8 + 1).cast("int")
    return table(spark, d, "events").select("event_id", policy.retry_wait(attempt, F.when(F.col("value") > 150, F.col("value")), 0.5, 60.0).alias("retry"), policy.block_wait((F.col("event_id") % 4 + 1).cast("int"), 300.0).alias("blocked"))


@query("""WITH RECURSIVE placed AS (SELECT event_id, event_type, epoch_us(ts) / 1e6 AS came, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS i FROM events),
    sent(event_type, i, released) AS (SELECT event_type, i, came FROM placed WHERE i = 1 UNION ALL SELECT p.event_type, p.i, greatest(p.came, s.released + 400.0) FROM sent s JOIN placed p ON p.event_type = s.event_type AND p.i = s.i + 1)
    SELECT event_id, round(released, 2) AS released FROM sent JOIN placed USING (event_type, i)""")
def token_bucket(spark: SparkSession, d: str) -> DataFrame:
    requests = table(spark, d, "events").select("event_id", "event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    return policy.release_times(requests, ["event_type"], "at", "event_id", 400.0).select("event_id", F.round("released", 2).alias("released"))


@query("""SELECT e.event_id, EXISTS (SELECT 1 FROM events b WHERE b.user_id = e.user_id AND b.value >= 20 AND (b.ts < e.ts OR (b.ts = e.ts AND b.event_id < e.event_id)) AND epoch_us(e.ts) - epoch_us(b.ts) <= 86400000000) AS hit FROM events e""")
def result_cache(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "events").select("event_id", "user_id", "value", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("at"))
    return policy.cache_hits(asked, ["user_id"], "at", "event_id", 86_400.0, F.col("value") < 20).select("event_id", "hit")


# Runs.
@query("SELECT user_id AS run_id, min(ts) AS started_at FROM events GROUP BY user_id ORDER BY started_at DESC, run_id LIMIT 5")
def recent_runs(spark: SparkSession, d: str) -> DataFrame:
    return runs.recent_runs(table(spark, d, "events").groupBy(F.col("user_id").alias("run_id")).agg(F.min("ts").alias("started_at")))


@query("""SELECT run_id, candidates, resolved, CASE WHEN candidates IS NULL THEN 'running' WHEN resolved = 0 THEN 'failed' WHEN resolved >= candidates THEN 'success' ELSE 'partial_success' END AS status,
    CASE WHEN candidates = 0 THEN 'no candidates' WHEN resolved = 0 THEN 'none resolved' END AS verdict FROM (SELECT DISTINCT user_id AS run_id FROM events) LEFT JOIN (
    SELECT user_id AS run_id, count(*) AS candidates, count(*) FILTER (WHERE value > 50) AS resolved FROM events WHERE event_type <> 'error' GROUP BY 1) USING (run_id)""")
def run_endings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events")
    running = rows.select(F.col("user_id").alias("run_id")).distinct().withColumn("status", F.lit("running"))
    counts = rows.where("event_type <> 'error'").groupBy(F.col("user_id").alias("run_id")).agg(F.count("*").alias("candidates"), F.count_if(F.col("value") > 50).alias("resolved"))
    return runs.assess(runs.finish_runs(running, counts)).select("run_id", "candidates", "resolved", "status", "verdict")


@query("""SELECT user_id AS run_id, event_type AS source, arg_max(props, (ts, event_id)) AS reason, 'skipped' AS status FROM events GROUP BY 1, 2""")
def source_skips(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("source"), F.col("props").alias("reason"), "ts", "event_id")
    last = lambda part: part.groupBy("run_id", "source").agg(F.max_by("reason", F.struct("ts", "event_id")).alias("reason"))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    before = runs.skip_sources(spark.createDataFrame([], "run_id bigint, source string, reason string, status string"), last(rows.where(F.col("ts") < cut)))
    return runs.skip_sources(before, last(rows.where(F.col("ts") >= cut)))


@query(f"""WITH {_CLEAN}, one AS (SELECT book_id, min(isbn13) AS isbn13, min(published_year) AS published_year, count(DISTINCT source) AS sources FROM accounts GROUP BY 1)
    SELECT count(*) AS books, count(isbn13) AS with_isbn, count(published_year) AS with_year, round(100.0 * count(isbn13) / count(*), 2) AS isbn_percent, (SELECT count(*) FROM book_sources) AS accounts,
    count(*) FILTER (WHERE sources > 1) AS of_several_sources, (SELECT count(*) FROM (SELECT book_id FROM (SELECT book_id, unnest(authors).name AS n FROM accounts) GROUP BY 1 HAVING count(DISTINCT n) > 1)) AS of_several_authors FROM one""")
def observability_report(spark: SparkSession, d: str) -> DataFrame:
    from quire.operators import merge

    accounts = cut_lineage(merge.canonicalise(_raw_accounts(spark, d)).select("book_id", "source", "isbn13", F.col("published_year").cast("int").alias("published_year"), "authors"))
    books = accounts.groupBy("book_id").agg(F.min("isbn13").alias("isbn13"), F.min("published_year").alias("published_year"))
    return runs.report(books, accounts, accounts.select("book_id", F.explode("authors.name").alias("name")))


_LAGS = "(SELECT event_type AS topic, ts AS came, event_id, row_number() OVER w * 3 - (CASE WHEN event_id % 500 = 0 THEN 2000 ELSE 0 END) AS lag FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))"


@query(f"""WITH grown AS (SELECT *, lag - lag(lag) OVER (PARTITION BY topic ORDER BY came, event_id) AS g FROM {_LAGS})
    SELECT event_id, lag > 1000 AND NOT coalesce(min(g) OVER (PARTITION BY topic ORDER BY came RANGE BETWEEN INTERVAL 15 MINUTE PRECEDING AND CURRENT ROW) < 0, false) AS alert FROM grown""")
def lag_alerts(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql.window import Window

    place = F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id"))
    rows = table(spark, d, "events").select(F.col("event_type").alias("topic"), F.col("ts").alias("at"), "event_id", (place * 3 - F.when(F.col("event_id") % 500 == 0, 2000).otherwise(0)).alias("lag"))
    return runs.lag_alerts(rows).select("event_id", "alert")


@query("""SELECT book_id, list_sort(list(DISTINCT name)) AS names FROM (SELECT b.book_id, unnest(r.authors).name AS name FROM book_sources b JOIN raw_book r ON b.source = r.source AND b.source_id = r.source_id)
    WHERE name IS NOT NULL GROUP BY book_id""")
def names_per_book(spark: SparkSession, d: str) -> DataFrame:
    return _raw_accounts(spark, d).select("book_id", F.explode("authors.name").alias("name")).where("name is not null").groupBy("book_id").agg(F.array_sort(F.collect_set("name")).alias("names"))


@query(f"""WITH m AS (SELECT b.book_id, r.source, r.source_id, unnest(range(len(r.series))) AS place, unnest(r.series) AS s FROM book_sources b JOIN raw_book r ON b.source = r.source AND b.source_id = r.source_id)
    SELECT book_id, {_title_sql('s.name')} AS series_key, source, source_id, arg_min(s.position, place) FILTER (WHERE s.position IS NOT NULL) AS position, bool_or(coalesce(s.confirmed, false)) AS confirmed
    FROM m WHERE {_title_sql('s.name')} IS NOT NULL GROUP BY 1, 2, 3, 4""")
def series_provenance(spark: SparkSession, d: str) -> DataFrame:
    return upsert.series_provenance(_raw_accounts(spark, d), "book_id", text.title_form(F.col("member.name")))[1]


# Events.
@query("""SELECT delivery_id, CASE WHEN coalesce(schema_version, -1) <> 1 THEN 'unsupported_version' WHEN event_type IS NULL OR event_type NOT IN ('book.raw', 'book.clean', 'run.partition_complete') THEN 'unknown_type'
    WHEN coalesce(event_id, '') = '' OR run_id IS NULL OR emitted_at IS NULL THEN 'invalid' WHEN event_type <> 'run.partition_complete' AND NOT coalesce(length(source) > 0 AND length(source_id) > 0, false) THEN 'invalid'
    WHEN event_type = 'book.clean' AND identity_key IS NULL THEN 'invalid' WHEN event_type = 'run.partition_complete' AND (topic IS NULL OR coalesce(partition_no, -1) < 0) THEN 'invalid' ELSE 'ok' END AS decode_status,
    CASE WHEN event_type = 'book.raw' THEN concat_ws(':', source, source_id) WHEN event_type = 'book.clean' THEN identity_key END AS partition_key FROM book_messages""")
def envelope_decode(spark: SparkSession, d: str) -> DataFrame:
    """Messages as JSON lines, decoded, with the key each is partitioned by."""
    sent = table(spark, d, "book_messages")
    line = F.to_json(F.struct(
        "schema_version", "event_id", "run_id", "event_type", F.concat(F.col("emitted_at").cast("string"), F.lit("Z")).alias("emitted_at"), "source", "source_id", "identity_key", F.struct("payload").alias("payload"), "topic",
        F.col("partition_no").alias("partition"),
    ))
    decoded = events.decode(sent.select("delivery_id", line.alias("value")))
    return decoded.select("delivery_id", "decode_status", events.partition_key().alias("partition_key"))


_BARE = """CASE WHEN r.source = 'goodreads' AND regexp_matches(r.title, '\\([^()]+\\)\\s*$') AND NOT regexp_matches(r.title, '(?i)\\((?:[0-9]{{4}}|[^()]*\\b(?:edition|illustrated|abridged|unabridged|reprint|paperback|hardcover|boxed set|omnibus|annotated|translated|audiobook)\\b[^()]*)\\)\\s*$')
    THEN coalesce(nullif(trim(regexp_replace(r.title, '\\s*\\([^()]+\\)\\s*$', '')), ''), r.title) ELSE r.title END""".replace("{{", "{").replace("}}", "}")


@query(f"""WITH {_CLEAN}, shown AS (SELECT c.source, c.source_id, CASE WHEN c.source <> 'goodreads' THEN c.isbn13 END AS isbn13, c.normalised_first_author AS a, c.published_year AS y, {_title_sql(_marc_sql('t'))} AS t FROM accounts c JOIN (
      SELECT r.record_id, {_BARE} AS t FROM raw_book r) USING (record_id))
    SELECT source, source_id, CASE WHEN isbn13 IS NOT NULL THEN 'isbn:' || isbn13 ELSE 'fallback:' || sha256(t || chr(0) || coalesce(a, '') || chr(0) || coalesce(y::VARCHAR, '')) END AS identity_key FROM shown
    WHERE isbn13 IS NOT NULL OR t IS NOT NULL""")
def transform_records(spark: SparkSession, d: str) -> DataFrame:
    """Stored payloads as raw events, decoded, mapped, made canonical and emitted as clean events, which are decoded again.

    A search card states no ISBN and has its series in the title.
    """
    raw = table(spark, d, "book_sources").select(F.to_json(F.struct(
        F.lit(1).alias("schema_version"), F.concat_ws(":", "source", "source_id").alias("event_id"), F.lit("r").alias("run_id"), F.lit("book.raw").alias("event_type"), F.lit("2025-01-01T00:00:00Z").alias("emitted_at"), "source", "source_id",
        F.try_parse_json("raw_payload").alias("payload"),
    )).alias("value"))
    records, _, _ = events.route(events.decode(raw))
    clean, _ = consumers.transform(records, F.lit("2025-01-01 00:00:00").cast("timestamp"))
    again, _, _ = events.route(events.decode(consumers.envelope_lines(clean)))
    return again.select("source", "source_id", "identity_key")


@query("""WITH top AS (SELECT run_id, topic, min(n) AS expected FROM (SELECT DISTINCT run_id, topic, 3::BIGINT AS n FROM book_messages WHERE run_id IS NOT NULL AND topic IS NOT NULL) GROUP BY 1, 2),
    seen AS (SELECT t.run_id, bool_and(coalesce(m.n, 0) >= t.expected) AS whole FROM top t LEFT JOIN (SELECT run_id, topic, count(DISTINCT partition_no) AS n FROM book_messages WHERE event_type = 'run.partition_complete' GROUP BY 1, 2) m
      ON m.run_id = t.run_id AND m.topic = t.topic GROUP BY 1)
    SELECT run_id, CASE WHEN whole THEN 'success' ELSE 'processing' END AS status FROM seen""")
def restart_sweep(spark: SparkSession, d: str) -> DataFrame:
    """Runs after a restart, against the topology frozen at their start: what is frozen later changes nothing."""
    sent = table(spark, d, "book_messages")
    wanted = sent.where("run_id is not null and topic is not null").select("run_id", "topic").distinct()
    none = spark.createDataFrame([], "run_id string, topic string, expected bigint")
    frozen = consumers.freeze_topology(none, wanted.withColumn("expected", F.lit(3).cast("long")))
    frozen = consumers.freeze_topology(frozen, wanted.withColumn("expected", F.lit(9).cast("long")))
    markers = sent.where(F.col("event_type") == events.MARKER).select("run_id", "topic", F.col("partition_no").alias("partition"))
    return consumers.sweep(wanted.select("run_id").distinct().withColumn("status", F.lit("processing")), markers, frozen)


# Enrichment.
@query(f"""WITH d AS (SELECT bookid, min(nullif(regexp_extract(workid, '^[0-9]+'), '')) AS work_id FROM goodreads_autocomplete WHERE card_rank IS NOT NULL AND bookid IS NOT NULL GROUP BY 1),
    b AS (SELECT source_id, source_id IN (SELECT bookid FROM d) AS seen FROM book_sources WHERE source = 'goodreads')
    SELECT source_id, CASE WHEN seen THEN 'enriched' ELSE 'missing' END AS outcome FROM b""")
def enrich_accounts(spark: SparkSession, d: str) -> DataFrame:
    backlog = table(spark, d, "book_sources").where("source = 'goodreads'").select("source_id")
    seen = _book_pages(spark, d).where("markup is not null and bookid is not null").groupBy(F.col("bookid").alias("source_id")).agg(F.min("markup").alias("markup"))
    editions = spark.createDataFrame([], "work_id string, markup string")
    return enrichment.enrich(backlog, seen, editions).select("source_id", "outcome")


@query(f"""WITH {_CLEAN}, kept AS (SELECT book_id, arg_min(isbn13, (source, source_id)) FILTER (WHERE isbn13 IS NOT NULL) AS isbn FROM accounts GROUP BY 1)
    SELECT a.source, a.source_id, a.isbn13 IS NOT NULL AND a.isbn13 <> k.isbn AS refused, CASE WHEN a.isbn13 IS NULL OR a.isbn13 = k.isbn THEN 'isbn:' || k.isbn END AS identity_key FROM accounts a JOIN kept k USING (book_id) WHERE k.isbn IS NOT NULL""")
def attach_known(spark: SparkSession, d: str) -> DataFrame:
    """Accounts re-keyed to their book's ISBN; those of another ISBN are refused."""
    from quire.operators import merge

    accounts = cut_lineage(merge.canonicalise(_raw_accounts(spark, d)).select("book_id", "source", "source_id", "isbn13"))
    known = accounts.where("isbn13 is not null").groupBy("book_id").agg(F.concat(F.lit("isbn:"), F.min_by("isbn13", F.struct("source", "source_id"))).alias("identity_key"))
    return enrichment.attach(accounts, known).select("source", "source_id", "refused", "identity_key")
