"""Queries of the catalogue's operators over the provider tables, and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import identity, numbers, similarity, text
from quire.operators import contested, mapping, merge, policy, search, upsert
from quire.plans import load
from quire.session import cut_lineage, table
from quire.sources import readers
from quire.streaming import events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


# SQL counterparts of the scalar forms, written out for the other engine: none reads a table or pattern of this package.
def _title_sql(c: str) -> str:
    folded = f"""translate(nfc_normalize({c}), chr(8216) || chr(8217) || chr(8218) || chr(8219) || chr(8220) || chr(8221) || chr(8222) || chr(8211) || chr(8212) || chr(8208) || chr(8209) || chr(160),
        repeat(chr(39), 4) || repeat(chr(34), 3) || '---- ')"""
    return f"nullif(replace(lower(trim(regexp_replace({folded}, '\\s+', ' ', 'g'))), 'ß', 'ss'), '')"


def _marc_sql(c: str) -> str:
    code = "\\s*[$|‡][a-z](\\s)"
    return f"CASE WHEN regexp_matches({c}, '{code}') THEN nullif(trim(regexp_replace(regexp_replace({c}, '{code}', '\\1', 'g'), '[\\s ]+', ' ', 'g')), '') ELSE {c} END"


def _author_sql(c: str) -> str:
    bare = f"regexp_replace({_title_sql(c)}, ',?\\s*[0-9]{{3,4}}\\s*-\\s*[0-9]{{0,4}}\\s*$', '')"
    turned = f"""(SELECT CASE WHEN length(x) - length(replace(x, ',', '')) = 1 AND trim(split_part(x, ',', 1)) <> '' AND trim(split_part(x, ',', 2)) <> ''
        THEN trim(split_part(x, ',', 2)) || ' ' || trim(split_part(x, ',', 1)) ELSE x END FROM (SELECT {bare} AS x))"""
    return f"nullif(trim(regexp_replace(strip_accents(translate({turned}, '.,;:()[]', '        ')), '\\s+', ' ', 'g')), '')"


_ROMANS = """(SELECT y, ['', 'M', 'MM'][y // 1000 + 1] || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][(y // 100) % 10 + 1]
    || ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][(y // 10) % 10 + 1]
    || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][y % 10 + 1] AS numeral FROM range(1400, 2101) t(y))"""


def _year_sql(c: str) -> str:
    digits = f"regexp_extract({c}, '(?:^|[^0-9])([0-9]{{4}})(?:[^0-9]|$)', 1)"
    letters = f"upper(regexp_extract({c}, '(?i)(?:^|[^\\p{{L}}\\p{{N}}])([MDCLXVI]{{2,}})(?:[^\\p{{L}}\\p{{N}}]|$)', 1))"
    return f"""CASE WHEN {digits} <> '' THEN CASE WHEN {digits}::INT BETWEEN 1400 AND 2100 THEN {digits}::INT END
        WHEN {letters} <> '' THEN (SELECT y FROM {_ROMANS} r WHERE r.numeral = {letters}) END"""


def _isbn13_sql(x: str) -> str:
    code = f"upper(regexp_replace({x}, '[\\s \\-‐‑‒–—―]', '', 'g'))"
    check13 = lambda c: f"((10 - list_sum([substr({c}, i::INT, 1)::INT * (CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END) for i in range(1, 13)]) % 10) % 10)::INT::VARCHAR"
    check10 = f"""(SELECT CASE WHEN r = 10 THEN 'X' ELSE r::INT::VARCHAR END FROM (SELECT (11 - list_sum([substr({code}, i::INT, 1)::INT * (11 - i) for i in range(1, 10)]) % 11) % 11 AS r))"""
    stem = f"('978' || substr({code}, 1, 9))"
    return f"""CASE WHEN regexp_full_match({code}, '97(8|9[1-9])[0-9]{{10}}') THEN CASE WHEN substr({code}, 13, 1) = {check13(code)} THEN {code} END
        WHEN regexp_full_match({code}, '[0-9]{{9}}[0-9X]') THEN CASE WHEN substr({code}, 10, 1) = {check10} THEN {stem} || {check13(stem)} END END"""


_ISO = """aa=aar ab=abk ae=ave af=afr ak=aka am=amh an=arg ar=ara as=asm av=ava ay=aym az=aze ba=bak be=bel bg=bul bi=bis bm=bam bn=ben bo=bod br=bre bs=bos ca=cat ce=che ch=cha co=cos cr=cre
    cs=ces cu=chu cv=chv cy=cym da=dan de=deu dv=div dz=dzo ee=ewe el=ell en=eng eo=epo es=spa et=est eu=eus fa=fas ff=ful fi=fin fj=fij fo=fao fr=fra fy=fry ga=gle gd=gla gl=glg gn=grn gu=guj
    ha=hau he=heb hi=hin hr=hrv ht=hat hu=hun hy=hye id=ind is=isl it=ita ja=jpn ka=kat kk=kaz km=khm kn=kan ko=kor ku=kur ky=kir la=lat lb=ltz lo=lao lt=lit lv=lav mg=mlg mi=mri mk=mkd ml=mal mn=mon
    mr=mar ms=msa mt=mlt my=mya nb=nob ne=nep nl=nld nn=nno no=nor oc=oci pa=pan pl=pol ps=pus pt=por qu=que rm=roh ro=ron ru=rus rw=kin sa=san sd=snd se=sme si=sin sk=slk sl=slv so=som sq=sqi sr=srp
    su=sun sv=swe sw=swa ta=tam te=tel tg=tgk th=tha tk=tuk tl=tgl tr=tur tt=tat uk=ukr ur=urd uz=uzb vi=vie xh=xho yi=yid yo=yor zh=zho zu=zul alb=sqi arm=hye baq=eus bur=mya chi=zho cze=ces dut=nld
    fre=fra geo=kat ger=deu gre=ell ice=isl mac=mkd mao=mri may=msa per=fas rum=ron slo=slk tib=bod wel=cym"""


def _language_sql(x: str) -> str:
    """By the published code tables; a three-letter code of a language stands for itself."""
    pairs = f"[string_split(p, '=') for p in string_split_regex('{_ISO}', '\\s+')]"
    code = f"lower(trim({x}))"
    return f"""coalesce(list_filter({pairs}, lambda p: p[1] = {code})[1][2], list_filter({pairs}, lambda p: p[2] = {code})[1][2])"""


_ISBNS = f"""isbn AS (SELECT record_id, CASE WHEN count(DISTINCT c) BETWEEN 1 AND 8 THEN min(c) END AS isbn13 FROM (
      SELECT record_id, {_isbn13_sql('raw_isbn')} AS c FROM (SELECT record_id, unnest(isbns) AS raw_isbn FROM raw_book)) GROUP BY record_id),
    lang AS (SELECT record_id, CASE WHEN count(DISTINCT l) = 1 THEN min(l) END AS language FROM (
      SELECT record_id, {_language_sql('x')} AS l FROM (SELECT record_id, unnest(languages) AS x FROM raw_book)) GROUP BY record_id)"""
_CLEAN = f"""{_ISBNS},
    forms AS (SELECT r.record_id, r.source, r.source_id, r.source_updated, r.subtitle, r.publisher, r.description, r.cover_url, r.subjects, r.series,
      r.goodreads_average_rating, CASE WHEN r.page_count > 0 THEN r.page_count END AS page_count, CASE WHEN r.download_count >= 0 THEN r.download_count END AS download_count,
      trim(regexp_replace({_marc_sql('r.title')}, '[\\s ]+', ' ', 'g')) AS title, {_title_sql(_marc_sql('r.title'))} AS normalised_title,
      list_filter(coalesce(r.authors, []), lambda a: length(trim(a.name)) > 0) AS authors,
      i.isbn13, l.language, {_year_sql('r.published')} AS published_year
      FROM raw_book r LEFT JOIN isbn i USING (record_id) LEFT JOIN lang l USING (record_id)),
    named AS (SELECT *, {_author_sql('authors[1].name')} AS normalised_first_author FROM forms),
    clean AS (SELECT *, CASE WHEN isbn13 IS NOT NULL THEN 'isbn:' || isbn13 WHEN normalised_title IS NOT NULL THEN
      'fallback:' || sha256(normalised_title || chr(0) || coalesce(normalised_first_author, '') || chr(0) || coalesce(published_year::VARCHAR, '')) END AS identity_key,
      (length(title) > 0)::INT + (normalised_title IS NOT NULL)::INT + coalesce((length(subtitle) > 0)::INT, 0) + (published_year IS NOT NULL)::INT + (page_count IS NOT NULL)::INT
      + (language IS NOT NULL)::INT + coalesce((length(publisher) > 0)::INT, 0) + coalesce((length(description) > 0)::INT, 0) + coalesce((length(cover_url) > 0)::INT, 0)
      + coalesce((download_count > 0)::INT, 0) + coalesce((goodreads_average_rating > 0)::INT, 0) + (normalised_first_author IS NOT NULL)::INT
      + (len(authors) > 0)::INT + coalesce((len(subjects) > 0)::INT, 0) + coalesce((len(series) > 0)::INT, 0) AS completeness,
      CASE source WHEN 'goodreads' THEN 0 WHEN 'googlebooks' THEN 1 WHEN 'openlibrary' THEN 2 WHEN 'gutendex' THEN 3 ELSE 4 END AS priority FROM named),
    accounts AS (SELECT b.book_id, c.* FROM book_sources b JOIN clean c ON b.source = c.source AND b.source_id = c.source_id)"""


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "raw_book")


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return merge.canonicalise(_raw(spark, d))


def _accounts(spark: SparkSession, d: str) -> DataFrame:
    """Stored accounts of books with their canonical forms: only rows that are accounts are made canonical."""
    return merge.canonicalise(_raw_accounts(spark, d))


def _raw_accounts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "book_sources").select("book_id", "source", "source_id").join(_raw(spark, d), ["source", "source_id"])


@query(f"SELECT record_id, {_title_sql('title')} AS normalised_title FROM raw_book")
def title_normalise(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("record_id", text.title_form(F.col("title")).alias("normalised_title"))


@query(f"""SELECT record_id, position, {_author_sql('name')} AS normalised_name FROM (
    SELECT record_id, unnest(range(len(authors))) AS position, unnest(authors).name AS name FROM raw_book)""")
def author_normalise(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw(spark, d).select("record_id", F.posexplode("authors").alias("position", "author"))
    return rows.select("record_id", F.col("position").cast("long").alias("position"), text.author_form(F.col("author.name")).alias("normalised_name"))


@query(f"SELECT record_id, {_marc_sql('title')} AS title FROM raw_book")
def marc_strip(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("record_id", text.strip_marc(F.col("title")).alias("title"))


@query(f"SELECT record_id, {_year_sql('published')} AS published_year FROM raw_book")
def year_parse(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("record_id", numbers.parse_year(F.col("published")).cast("int").alias("published_year"))


@query(f"WITH {_ISBNS} SELECT r.record_id, i.isbn13 FROM raw_book r LEFT JOIN isbn i USING (record_id)")
def isbn_canonical(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("record_id", numbers.canonical_isbn(F.col("isbns")).alias("isbn13"))


@query("""SELECT p_partkey, stem || (10 - list_sum([substr(stem, i::INT, 1)::INT * (CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END) for i in range(1, 13)]) % 10)::INT % 10 AS isbn13
    FROM (SELECT p_partkey, '978' || lpad(p_partkey::VARCHAR, 9, '0') AS stem FROM part)""")
def isbn_check_digits(spark: SparkSession, d: str) -> DataFrame:
    stem = F.concat(F.lit("978"), F.lpad(F.col("p_partkey").cast("string"), 9, "0"))
    return table(spark, d, "part").select("p_partkey", F.concat(stem, numbers.isbn13_check_digit(stem)).alias("isbn13"))


@query(f"WITH {_ISBNS} SELECT r.record_id, l.language FROM raw_book r LEFT JOIN lang l USING (record_id)")
def language_select(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).select("record_id", identity.select_language(F.col("languages")).alias("language"))


@query(f"WITH {_CLEAN} SELECT record_id, identity_key, normalised_first_author, CASE WHEN identity_key IS NULL THEN 'unidentifiable' END AS rejection FROM clean")
def canonical_identity(spark: SparkSession, d: str) -> DataFrame:
    return _clean(spark, d).select("record_id", "identity_key", "normalised_first_author", F.col("rejection.code").alias("rejection"))


@query("""SELECT p_partkey, sha256('{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_size":' || p_size || ',"p_type":"' || p_type || '"}') AS hash FROM part""")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    fields = [(c, F.col(c)) for c in ("p_name", "p_brand", "p_type", "p_size")]
    return table(spark, d, "part").select("p_partkey", identity.content_hash(*fields).alias("hash"))


@query()
def payload_hash(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "book_sources")
    return stored.select("source", "source_id", identity.payload_hash(F.col("raw_payload")).alias("hash"))


@query("""SELECT record_id, trim(regexp_extract(title, '\\s*\\(([^()]+?)(?:,\\s*#([0-9.]+))?\\)\\s*$', 1)) AS name,
    try_cast(nullif(regexp_extract(title, '\\s*\\(([^()]+?)(?:,\\s*#([0-9.]+))?\\)\\s*$', 2), '') AS DECIMAL(8,2)) AS position,
    trim(regexp_replace(title, '\\s*\\([^()]+\\)\\s*$', '')) AS bare
    FROM raw_book WHERE regexp_matches(title, '\\([^()]+\\)\\s*$') AND trim(regexp_replace(title, '\\s*\\([^()]+\\)\\s*$', '')) <> ''
      AND NOT regexp_matches(trim(regexp_extract(title, '\\(([^()]+?)(?:,\\s*#[0-9.]+)?\\)\\s*$', 1)), '(?i)^[0-9]{4}$|\\b(edition|illustrated|abridged|unabridged|reprint|paperback|hardcover|boxed set|omnibus|annotated|translated|audiobook)\\b')""")
def title_series(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw(spark, d).select("record_id", similarity.title_series(F.col("title")).alias("s")).where("s is not null")
    return rows.select("record_id", "s.name", numbers.series_position(F.col("s.position")).alias("position"), "s.bare")


@query("""SELECT a.p_partkey, 2.0 * len(list_intersect(a.t, b.t)) / (len(a.t) + len(b.t)) AS similarity FROM
    (SELECT p_partkey, list_distinct(regexp_extract_all(lower(p_name || ' ' || p_type), '[0-9a-z]+')) AS t FROM part) a
    JOIN (SELECT p_partkey, list_distinct(regexp_extract_all(lower(p_name || ' ' || p_type), '[0-9a-z]+')) AS t FROM part) b ON b.p_partkey = a.p_partkey + 1
    WHERE len(list_intersect(a.t, b.t)) > 0""")
def token_similarity(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("words"))
    after = parts.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("words").alias("other"))
    pairs = parts.join(after, "p_partkey").where(F.arrays_overlap(similarity.tokens(F.col("words")), similarity.tokens(F.col("other"))))
    return pairs.select("p_partkey", similarity.similarity(F.col("words"), F.col("other")).alias("similarity"))


@query("""SELECT bookid, card_rank, fetched_at, CASE WHEN strpos(lower(imageurl), 'nophoto') = 0 AND strpos(lower(imageurl), 'no-photo') = 0 AND strpos(lower(imageurl), 'no_photo') = 0 THEN
    nullif(regexp_replace(regexp_replace(trim(imageurl), '(?i)\\._S[XY][0-9]+_(\\.[a-z]{3,4})$', '\\1'), '^http://', 'https://'), '') END AS cover_url FROM goodreads_autocomplete""")
def cover_upgrade(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "goodreads_autocomplete").select("bookid", "card_rank", "fetched_at", similarity.cover(F.col("imageurl")).alias("cover_url"))


@query("""SELECT record_id, trim(regexp_extract(t, '(?is)^(.*)\\s+by\\s+(.*)$', 1)) AS title, trim(regexp_extract(t, '(?is)^(.*)\\s+by\\s+(.*)$', 2)) AS author FROM (
    SELECT record_id, title || ' by ' || authors[1].name AS t FROM raw_book WHERE len(authors) > 0 AND title IS NOT NULL AND authors[1].name IS NOT NULL)""")
def split_by_author(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw(spark, d).where("size(authors) > 0 and title is not null and get(authors, 0).name is not null")
    joined = F.concat_ws(" by ", F.col("title"), F.get("authors", F.lit(0))["name"])
    return rows.select("record_id", similarity.split_by_author(joined).alias("s")).select("record_id", "s.title", "s.author")



@query("""SELECT source, source_id, CASE source WHEN 'googlebooks' THEN trim(json_extract_string(raw_payload, '$.volumeInfo.title'))
      WHEN 'goodreads' THEN coalesce(nullif(trim(regexp_replace(trim(json_extract_string(raw_payload, '$.title')), '\\s*\\([^()]*#[^()]*\\)\\s*$', '')), ''), trim(json_extract_string(raw_payload, '$.title')))
      ELSE trim(json_extract_string(raw_payload, '$.title')) END AS title,
    CASE source WHEN 'googlebooks' THEN (json_extract(raw_payload, '$.volumeInfo.pageCount'))::INT WHEN 'goodreads' THEN (json_extract(raw_payload, '$.numPages'))::INT
      WHEN 'openlibrary' THEN (json_extract(raw_payload, '$.number_of_pages'))::INT END AS page_count,
    nullif(trim(CASE source WHEN 'googlebooks' THEN json_extract_string(raw_payload, '$.volumeInfo.publishedDate') WHEN 'goodreads' THEN json_extract_string(raw_payload, '$._edition.published')
      WHEN 'openlibrary' THEN json_extract_string(raw_payload, '$.publish_date') END), '') AS published,
    (CASE source WHEN 'googlebooks' THEN coalesce(json_array_length(raw_payload, '$.volumeInfo.categories'), 0)::INT WHEN 'openlibrary' THEN coalesce(json_array_length(raw_payload, '$.subject'), 0)::INT
      WHEN 'gutendex' THEN coalesce(json_array_length(raw_payload, '$.subjects'), 0)::INT END) AS n_subjects,
    nullif(trim(CASE source WHEN 'googlebooks' THEN json_extract_string(raw_payload, '$.volumeInfo.publisher') WHEN 'goodreads' THEN json_extract_string(raw_payload, '$._edition.publisher')
      WHEN 'openlibrary' THEN json_extract_string(raw_payload, '$.publisher[0]') END), '') AS publisher,
    CASE source WHEN 'googlebooks' THEN list_filter([trim(x) for x in (raw_payload->>'$.volumeInfo.authors[*]')], lambda x: length(x) > 0) WHEN 'openlibrary' THEN list_filter([trim(x) for x in (raw_payload->>'$.author_name[*]')], lambda x: length(x) > 0)
      WHEN 'gutendex' THEN list_filter([trim(x) for x in (raw_payload->>'$.authors[*].name')], lambda x: length(x) > 0) ELSE list_filter([trim(json_extract_string(raw_payload, '$.author.name'))], lambda x: length(x) > 0) END AS authors,
    CASE source WHEN 'googlebooks' THEN coalesce(raw_payload->>'$.volumeInfo.industryIdentifiers[*].identifier', []) WHEN 'openlibrary' THEN coalesce(raw_payload->>'$.isbn[*]', []) ELSE [] END AS isbns,
    CASE source WHEN 'googlebooks' THEN list_filter([trim(json_extract_string(raw_payload, '$.volumeInfo.language'))], lambda x: length(x) > 0) WHEN 'openlibrary' THEN coalesce(raw_payload->>'$.language[*]', [])
      WHEN 'gutendex' THEN coalesce(raw_payload->>'$.languages[*]', []) ELSE [] END AS languages
    FROM book_sources""")
def map_payloads(spark: SparkSession, d: str) -> DataFrame:
    mapped, _ = mapping.split(mapping.map_payloads(table(spark, d, "book_sources").select("source", "raw_payload")))
    return mapped.select(
        "source", "raw.source_id", "raw.title", "raw.page_count", "raw.published", F.when(F.col("source") != "goodreads", F.size("raw.subjects")).alias("n_subjects"), "raw.publisher",
        *[F.coalesce(c, F.array().cast("array<string>")).alias(n) for n, c in (("authors", F.col("raw.authors.name")), ("isbns", F.col("raw.isbns")), ("languages", F.col("raw.languages")))],
    )


@query("""SELECT CASE WHEN source IS NULL THEN 'unknown source' WHEN NOT json_valid(payload) OR json_type(payload) <> 'OBJECT' THEN 'payload is no object' ELSE 'no identifier' END AS detail,
    count(*) AS n FROM book_messages WHERE payload IS NOT NULL GROUP BY 1""")
def map_rejections(spark: SparkSession, d: str) -> DataFrame:
    sent = table(spark, d, "book_messages").where("payload is not null").select("source", "payload")
    _, rejected = mapping.split(mapping.map_payloads(sent, "payload"))
    return rejected.groupBy(F.col("rejection.detail").alias("detail")).agg(F.count("*").alias("n"))


@query(f"""WITH {_CLEAN} SELECT book_id, source, source_id, completeness FROM (
    SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY completeness DESC, priority, source_id) AS place FROM accounts) WHERE place = 1""")
def completeness_rank(spark: SparkSession, d: str) -> DataFrame:
    of = _accounts(spark, d)
    best = of.groupBy("book_id").agg(F.min_by(F.struct("source", "source_id", merge.completeness(of).alias("completeness")), merge.rank(of)).alias("w"))
    return best.select("book_id", "w.*")


_FIRST = "arg_min({0}, (-completeness, priority, source_id)) FILTER (WHERE {0} IS NOT NULL)"


@query(f"""WITH {_CLEAN} SELECT book_id, count(*) AS n_records, count(DISTINCT isbn13) > 1 AS conflict,
    {', '.join(f"CASE WHEN count(DISTINCT isbn13) <= 1 THEN {_FIRST.format(f)} END AS {f}" for f in ('title', 'subtitle', 'published_year', 'page_count', 'language', 'publisher', 'cover_url', 'download_count'))},
    CASE WHEN count(DISTINCT isbn13) <= 1 THEN min(isbn13) END AS isbn13 FROM accounts GROUP BY book_id""")
def ranked_merge(spark: SparkSession, d: str) -> DataFrame:
    """Accounts of a book brought to one identity, then merged; those with ISBNs of several books are refused."""
    merged = merge.merge(merge.unify_identity(_accounts(spark, d), "book_id"), "book_id")
    return merged.select("book_id", "n_records", "conflict", "title", "subtitle", F.col("published_year").cast("int").alias("published_year"), "page_count", "language", "publisher", "cover_url", "download_count", "isbn13")


@query(f"""WITH {_CLEAN} SELECT book_id, count(DISTINCT isbn13) > 1 OR (count(isbn13) = 0 AND count(DISTINCT identity_key) > 1) AS conflict,
    CASE WHEN NOT (count(DISTINCT isbn13) > 1 OR (count(isbn13) = 0 AND count(DISTINCT identity_key) > 1)) THEN coalesce('isbn:' || min(isbn13), min(identity_key)) END AS identity_key,
    CASE WHEN NOT (count(DISTINCT isbn13) > 1 OR (count(isbn13) = 0 AND count(DISTINCT identity_key) > 1)) THEN {_FIRST.format('title')} END AS title,
    CASE WHEN NOT (count(DISTINCT isbn13) > 1 OR (count(isbn13) = 0 AND count(DISTINCT identity_key) > 1)) THEN arg_min(len(authors), (-completeness, priority, source_id)) FILTER (WHERE len(authors) > 0) END AS n_authors
    FROM accounts GROUP BY book_id""")
def merge_refusals(spark: SparkSession, d: str) -> DataFrame:
    """Merging without unifying first: unrelated fallback identities are refused as conflicting ISBNs are."""
    merged = merge.merge(_accounts(spark, d), "book_id")
    return merged.select("book_id", "conflict", "identity_key", "title", F.when(F.size("authors") > 0, F.size("authors")).alias("n_authors"))


@query(f"""WITH {_CLEAN}, agreed AS (SELECT book_id, count(DISTINCT isbn13) AS n, min(isbn13) AS isbn, arg_min(identity_key, (-completeness, priority, source_id)) AS best FROM accounts GROUP BY book_id)
    SELECT a.record_id, CASE WHEN n = 1 THEN 'isbn:' || isbn WHEN n = 0 THEN best ELSE a.identity_key END AS identity_key, CASE WHEN n = 1 THEN isbn WHEN n > 1 THEN a.isbn13 END AS isbn13
    FROM accounts a JOIN agreed USING (book_id)""")
def unify_identity(spark: SparkSession, d: str) -> DataFrame:
    return merge.unify_identity(_accounts(spark, d), "book_id").select("record_id", "identity_key", "isbn13")


@query(f"WITH {_CLEAN} SELECT book_id, count(DISTINCT isbn13) AS isbn_count FROM accounts GROUP BY book_id HAVING count(DISTINCT isbn13) > 1")
def conflicting_isbn_split(spark: SparkSession, d: str) -> DataFrame:
    return _accounts(spark, d).groupBy("book_id").agg(F.count_distinct("isbn13").alias("isbn_count")).where("isbn_count > 1")


@query("""SELECT b.book_id, arg_min(r.download_count, r.source_id) FILTER (WHERE r.source = 'gutendex' AND r.download_count IS NOT NULL) AS download_count
    FROM book_sources b JOIN raw_book r ON b.source = r.source AND b.source_id = r.source_id GROUP BY b.book_id""")
def download_override(spark: SparkSession, d: str) -> DataFrame:
    return merge.first_download_count(_raw_accounts(spark, d), "book_id")


_CUT = "TIMESTAMP '2025-07-01 00:00:00'"


_HASHED = ("title", "subtitle", "published_year", "publisher", "page_count", "download_count", "goodreads_average_rating", "language", "description", "cover_url")
_MERGED = ", ".join(f"{_FIRST.format(f)} AS {f}" for f in _HASHED)


@query(f"""WITH {_CLEAN}, old AS (SELECT book_id, {_MERGED} FROM accounts WHERE source_updated < {_CUT} GROUP BY book_id), new AS (SELECT book_id, {_MERGED} FROM accounts GROUP BY book_id)
    SELECT new.book_id, old.book_id IS NULL OR ({', '.join(f'new.{f}' for f in _HASHED)}) IS DISTINCT FROM ({', '.join(f'old.{f}' for f in _HASHED)}) AS changed FROM new LEFT JOIN old USING (book_id)""")
def recompute_changed_only(spark: SparkSession, d: str) -> DataFrame:
    """Books recomputed from all their accounts, brought to the identity of the account seen first: only a changed content moves the stamp."""
    stored = table(spark, d, "book_sources")
    kept = stored.join(_clean(spark, d).select("source", "source_id", "identity_key"), ["source", "source_id"]).groupBy("book_id").agg(
        F.min_by("identity_key", F.struct("first_seen_at", "source", "source_id")).alias("kept"))
    accounts = merge.agree(_accounts(spark, d).join(kept, "book_id"), "kept")

    def hashed(rows: DataFrame) -> DataFrame:
        merged = merge.merge(rows, "book_id", "kept")
        return merged.withColumn("content_hash", merge.content_hash(merged))

    cut = F.lit("2025-07-01 00:00:00").cast("timestamp_ntz")
    old = hashed(accounts.where(F.col("source_updated") < cut)).withColumn("updated_at", cut)
    return merge.changed_only(old, hashed(accounts), "book_id", F.lit("2025-08-01 00:00:00").cast("timestamp_ntz")).select("book_id", "changed")


@query(f"""SELECT coalesce(o.source, n.source) AS source, coalesce(o.source_id, n.source_id) AS source_id, coalesce(n.payload_hash, o.payload_hash) AS payload_hash,
    coalesce(o.first_seen_at, n.first_seen_at) AS first_seen_at, coalesce(n.last_seen_at, o.last_seen_at) AS last_seen_at FROM
    (SELECT source, source_id, payload_hash, first_seen_at, first_seen_at AS last_seen_at FROM book_sources WHERE first_seen_at < {_CUT}) o
    FULL JOIN (SELECT source, source_id, payload_hash, last_seen_at AS first_seen_at, last_seen_at FROM book_sources WHERE last_seen_at >= {_CUT}) n ON o.source = n.source AND o.source_id = n.source_id""")
def source_upsert(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "book_sources").select("source", "source_id", "payload_hash", "first_seen_at", "last_seen_at")
    cut = F.lit("2025-07-01 00:00:00").cast("timestamp_ntz")
    old = stored.where(F.col("first_seen_at") < cut).withColumn("last_seen_at", F.col("first_seen_at"))
    new = stored.where(F.col("last_seen_at") >= cut).withColumn("first_seen_at", F.col("last_seen_at"))
    rules = {"first_seen_at": upsert.fill, "payload_hash": upsert.refresh, "last_seen_at": upsert.refresh}
    return upsert.upsert(old, new, ["source", "source_id"], rules)


_PEOPLE = f"""people AS (SELECT book_id, source, source_id, position, name, birth_year, {_author_sql('name')} AS normalised_name FROM (
    SELECT b.book_id, r.source, r.source_id, unnest(range(len(r.authors))) AS position, unnest(r.authors).name AS name, unnest(r.authors).birth_year AS birth_year
    FROM book_sources b JOIN raw_book r ON b.source = r.source AND b.source_id = r.source_id))"""


@query(f"""WITH {_PEOPLE} SELECT normalised_name, arg_min(name, (source, source_id, position)) AS name,
    arg_min(birth_year, (source, source_id, position)) FILTER (WHERE birth_year IS NOT NULL) AS birth_year FROM people WHERE normalised_name IS NOT NULL GROUP BY normalised_name""")
def author_sync(spark: SparkSession, d: str) -> DataFrame:
    people, _ = upsert.sync_people(_raw_accounts(spark, d), "book_id", text.author_form(F.col("author.name")))
    return people.select("normalised_name", "name", "birth_year")


@query(f"""WITH {_PEOPLE} SELECT book_id, normalised_name, arg_min(position, (source, source_id, position))::INT AS position FROM people WHERE normalised_name IS NOT NULL GROUP BY 1, 2""")
def author_links(spark: SparkSession, d: str) -> DataFrame:
    return upsert.sync_people(_raw_accounts(spark, d), "book_id", text.author_form(F.col("author.name")))[1]


@query(f"""SELECT normalised_name, arg_min(subject, (source, source_id, position)) AS name FROM (
    SELECT source, source_id, position, subject, {_title_sql('subject')} AS normalised_name FROM (
      SELECT r.source, r.source_id, unnest(range(len(r.subjects))) AS position, unnest(r.subjects) AS subject
      FROM book_sources b JOIN raw_book r ON b.source = r.source AND b.source_id = r.source_id)) WHERE normalised_name IS NOT NULL GROUP BY normalised_name""")
def subject_sync(spark: SparkSession, d: str) -> DataFrame:
    return upsert.sync_subjects(_raw_accounts(spark, d), "book_id", text.subject_form(F.col("subject")))[0]


_MEMBERS = f"""members AS (SELECT book_id, source, source_id, m.name AS name, m.position AS position, m.confirmed AS confirmed, {_title_sql('m.name')} AS normalised_name FROM (
    SELECT b.book_id, r.source, r.source_id, unnest(r.series) AS m FROM book_sources b JOIN raw_book r ON b.source = r.source AND b.source_id = r.source_id))"""


@query(f"""WITH {_MEMBERS} SELECT book_id, normalised_name, arg_min(name, (NOT coalesce(confirmed, false), source, source_id)) AS name,
    arg_min(position, (NOT coalesce(confirmed, false), source, source_id)) FILTER (WHERE position IS NOT NULL) AS position, bool_or(coalesce(confirmed, false)) AS confirmed
    FROM members WHERE normalised_name IS NOT NULL GROUP BY 1, 2""")
def series_sync(spark: SparkSession, d: str) -> DataFrame:
    synced = upsert.sync_series(_raw_accounts(spark, d), "book_id", text.title_form(F.col("member.name")))
    return synced.withColumnRenamed("series_key", "normalised_name")


@query(f"""WITH {_MEMBERS} SELECT book_id, string_agg(name, ' ' ORDER BY normalised_name) AS series_search_text FROM (
    SELECT book_id, normalised_name, min(name) AS name FROM members WHERE normalised_name IS NOT NULL GROUP BY 1, 2) GROUP BY book_id""")
def series_search_text(spark: SparkSession, d: str) -> DataFrame:
    members = _raw_accounts(spark, d).select("book_id", F.explode("series").alias("m")).select("book_id", "m.name", text.title_form(F.col("m.name")).alias("normalised_name"))
    return upsert.search_text(members.where("normalised_name is not null"), "book_id")


@query(f"""WITH {_MEMBERS}, keyed AS (SELECT book_id, normalised_name, position, coalesce(confirmed, false) AS confirmed,
      CASE WHEN book_id % 2 = 0 THEN 'srcseries:' || normalised_name ELSE 'series:' || normalised_name END AS series_key FROM members WHERE normalised_name IS NOT NULL),
    sure AS (SELECT normalised_name, min(series_key) AS survivor FROM keyed WHERE series_key LIKE 'srcseries:%' GROUP BY 1),
    led AS (SELECT book_id, normalised_name, position, confirmed, CASE WHEN starts_with(series_key, 'series:') THEN coalesce(survivor, series_key) ELSE series_key END AS series_key FROM keyed LEFT JOIN sure USING (normalised_name))
    SELECT book_id, series_key, normalised_name, arg_min(position, (NOT confirmed, position)) FILTER (WHERE position IS NOT NULL) AS position, bool_or(confirmed) AS confirmed FROM led GROUP BY 1, 2, 3""")
def series_absorb(spark: SparkSession, d: str) -> DataFrame:
    members = _raw_accounts(spark, d).select("book_id", F.explode("series").alias("m"))
    named = members.select("book_id", text.title_form(F.col("m.name")).alias("normalised_name"), "m.position", F.coalesce("m.confirmed", F.lit(False)).alias("confirmed")).where("normalised_name is not null")
    prefix = F.when(F.col("book_id") % 2 == 0, "srcseries:").otherwise("series:")
    return upsert.absorb_inferred(named.withColumn("series_key", F.concat(prefix, "normalised_name")))


@query(f"""WITH RECURSIVE {_CLEAN}, tied AS (SELECT DISTINCT a.book_id AS x, b.book_id AS y FROM accounts a JOIN accounts b ON a.isbn13 = b.isbn13),
    reach(x, y) AS (SELECT x, y FROM tied UNION SELECT r.x, t.y FROM reach r JOIN tied t ON r.y = t.x)
    SELECT x AS book, min(y) AS root FROM reach GROUP BY x""")
def identity_components(spark: SparkSession, d: str) -> DataFrame:
    """Books tied by an ISBN, through a star per ISBN around its smallest book: no pairs within a group."""
    numbered = _accounts(spark, d).where("isbn13 is not null").select("isbn13", F.col("book_id").alias("book_b")).distinct()
    hub = numbered.groupBy("isbn13").agg(F.min("book_b").alias("book_a"))
    return upsert.reconcile_identities(numbered.join(hub, "isbn13").select("book_a", "book_b"))


@query("""SELECT DISTINCT CASE WHEN o_orderkey % 7 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS book_id, l_suppkey AS author_id
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def book_merge_remap(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("book_id"), F.col("l_suppkey").alias("author_id"))
    moved = table(spark, d, "orders").where("o_orderkey % 7 = 0").select(F.col("o_orderkey").alias("old_id"), (F.col("o_orderkey") - 1).alias("new_id"))
    return upsert.remap(links, moved, "book_id", ["book_id", "author_id"])


def _member_sql(names: str) -> str:
    """The text of the first of the members that has a value, at the top level if it is there, else in volumeInfo."""
    picks = []
    for name in names.split():
        found = f"(CASE WHEN list_contains(json_keys(p), '{name}') THEN json_extract(p, '$.{name}') ELSE json_extract(p, '$.volumeInfo.{name}') END)"
        picks.append(f"""CASE WHEN json_type({found}) IN ('NULL') OR {found}::VARCHAR IN ('""', '[]') THEN NULL
            WHEN json_type({found}) = 'ARRAY' THEN coalesce(lower(trim(json_extract_string({found}, '$[0]'))), 'null') ELSE lower(trim(json_extract_string({found}, '$'))) END""")
    return f"nullif(coalesce({', '.join(picks)}), 'null')"


_COUNTS = f"""vals AS (SELECT book_id, source, {_member_sql('title')} AS a, {_member_sql('published first_publish_year publish_date publishedDate')} AS b, {_member_sql('publisher publishers')} AS c,
      {_member_sql('page_count number_of_pages number_of_pages_median pageCount')} AS d FROM (SELECT *, raw_payload::JSON AS p FROM book_sources WHERE json_valid(raw_payload))),
    counts AS (SELECT book_id, count(DISTINCT source) AS n_sources, (count(DISTINCT a) > 1)::INT + (count(DISTINCT b) > 1)::INT + (count(DISTINCT c) > 1)::INT + (count(DISTINCT d) > 1)::INT AS conflicts FROM vals GROUP BY book_id)"""


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def conflict_count(spark: SparkSession, d: str) -> DataFrame:
    return contested.conflict_counts(table(spark, d, "book_sources"))


@query(f"WITH {_COUNTS} SELECT * FROM counts WHERE n_sources > 1 AND conflicts >= 2 ORDER BY conflicts DESC, book_id LIMIT 25")
def contested_books(spark: SparkSession, d: str) -> DataFrame:
    return contested.find_contested(table(spark, d, "book_sources"), 2, 25)


@query(f"""WITH {_COUNTS} SELECT * FROM counts WHERE n_sources > 1 AND conflicts >= 2 AND NOT EXISTS (SELECT 1 FROM book_sources s WHERE s.book_id = counts.book_id AND s.source = 'goodreads')
    ORDER BY conflicts DESC, book_id LIMIT 50""")
def contested_skip_adjudicated(spark: SparkSession, d: str) -> DataFrame:
    return contested.find_contested(table(spark, d, "book_sources"), 2, 50, skip_source="goodreads")


@query("""SELECT source_id, last_seen_at FROM book_sources WHERE source = 'goodreads' AND NOT list_contains(json_keys(raw_payload), '_detail') ORDER BY last_seen_at, source_id LIMIT 100""")
def unenriched_backlog(spark: SparkSession, d: str) -> DataFrame:
    return contested.find_unenriched(table(spark, d, "book_sources"), 100, ("_detail",)).select("source_id", "last_seen_at")


@query("SELECT book_id, count(DISTINCT source) AS sources FROM book_sources GROUP BY book_id HAVING count(DISTINCT source) > 1")
def multi_source(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "book_sources").groupBy("book_id").agg(F.count_distinct("source").alias("sources")).where("sources > 1")


@query(f"WITH {_PEOPLE} SELECT book_id, count(DISTINCT normalised_name) AS authors FROM people GROUP BY book_id HAVING count(DISTINCT normalised_name) > 1")
def multi_author(spark: SparkSession, d: str) -> DataFrame:
    links = upsert.sync_people(_raw_accounts(spark, d), "book_id", text.author_form(F.col("author.name")))[1]
    return links.groupBy("book_id").agg(F.count("*").alias("authors")).where("authors > 1")


@query("SELECT source, count(*) AS n FROM raw_book GROUP BY source ORDER BY n DESC")
def rows_per_source(spark: SparkSession, d: str) -> DataFrame:
    return _raw(spark, d).groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"))


@query(f"""WITH {_CLEAN} SELECT count(*) AS records, count(published_year) AS with_year, count(isbn13) AS with_isbn, round(100.0 * count(isbn13) / count(*), 2) AS isbn_percent FROM clean""")
def coverage(spark: SparkSession, d: str) -> DataFrame:
    n = F.count("*")
    return _clean(spark, d).agg(
        n.alias("records"), F.count("published_year").alias("with_year"), F.count("isbn13").alias("with_isbn"), F.round(100.0 * F.count("isbn13") / n, 2).alias("isbn_percent")
    )


@query("SELECT book_id, list_sort(list(DISTINCT source)) AS sources, count(*) AS payloads, list_sort(list(payload_hash)) AS hashes FROM book_sources GROUP BY book_id")
def payloads_per_book(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "book_sources").groupBy("book_id").agg(F.array_sort(F.collect_set("source")).alias("sources"), F.count("*").alias("payloads"), F.array_sort(F.collect_list("payload_hash")).alias("hashes"))


@query("""SELECT event_type AS source, max(ts) AS last_refusal, round(date_diff('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 60.0, 4) AS minutes_since,
    date_diff('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') / 60.0 < 2000 AS cooling FROM events GROUP BY event_type""")
def cooldown(spark: SparkSession, d: str) -> DataFrame:
    refusals = table(spark, d, "events").select(F.col("event_type").alias("source"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("finished_at"), F.col("ts"))
    known = policy.cooling_down(refusals, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), 2000)
    last = refusals.groupBy("source").agg(F.max("ts").alias("last_refusal"))
    return known.drop("last_refusal").join(last, "source").select("source", "last_refusal", F.round("minutes_since", 4).alias("minutes_since"), "cooling")


@query("""SELECT event_id, CASE WHEN n <= 20 AND NOT coalesce(spent, false) THEN 'tried' ELSE 'skipped' END AS outcome FROM (
    SELECT event_id, row_number() OVER w AS n, bool_or(value > 190) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS spent
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""")
def budget_cap(spark: SparkSession, d: str) -> DataFrame:
    attempts = table(spark, d, "events")
    return policy.budgets(attempts, ["user_id"], ["ts", "event_id"], 20, F.col("value") > 190).select("event_id", "outcome")


@query("""WITH runs AS (SELECT *, sum((NOT failed)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT *, event_type IN ('error', 'click') AS failed FROM events)),
    counted AS (SELECT *, sum(failed::INT) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS failures FROM runs)
    SELECT event_id, failures::BIGINT AS failures, coalesce(bool_or(failures >= 5 OR value > 199) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS open FROM counted""")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    attempts = table(spark, d, "events")
    failed = F.col("event_type").isin("error", "click")
    return policy.breaker(attempts, ["user_id"], ["ts", "event_id"], failed, F.col("value") > 199, 5).select("event_id", F.col("failures").cast("long").alias("failures"), "open")


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN 'challenge' WHEN s IN (401, 403, 429) THEN 'denied' WHEN s >= 500 THEN 'transient' WHEN s >= 400 THEN 'final'
    WHEN value < 1 THEN 'blocked' ELSE 'ok' END AS class FROM (SELECT *, [200, 401, 403, 429, 404, 503][event_id % 6 + 1] AS s FROM events)""")
def response_class(spark: SparkSession, d: str) -> DataFrame:
    status = F.element_at(F.array(*[F.lit(s) for s in (200, 401, 403, 429, 404, 503)]), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", policy.classify(status, F.col("event_type") == "error", F.col("value") < 1).alias("class"))


@query("""SELECT day, candidates, resolved, CASE WHEN candidates = 0 OR resolved = 0 THEN 'failed' WHEN resolved >= candidates THEN 'success' ELSE 'partial_success' END AS status FROM (
    SELECT user_id % 50 AS day, count(*) AS candidates, count(*) FILTER (WHERE value > user_id % 50 * 2) AS resolved FROM events GROUP BY 1)""")
def run_status(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("user_id") % 50
    runs = table(spark, d, "events").groupBy(day.alias("day")).agg(F.count("*").alias("candidates"), F.count_if(F.col("value") > day * 2).alias("resolved"))
    return runs.withColumn("status", policy.run_status(F.col("candidates"), F.col("resolved")))


@query("""SELECT event_id, CASE WHEN event_type = 'view' AND ts < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 12 HOUR THEN 'failed' WHEN event_type = 'view' THEN 'running' ELSE 'processing' END AS status FROM events""")
def abandon_stale(spark: SparkSession, d: str) -> DataFrame:
    runs = table(spark, d, "events").select("event_id", F.col("ts").alias("started_at"), F.when(F.col("event_type") == "view", "running").otherwise("processing").alias("status"))
    return policy.abandon_stale(runs, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).select("event_id", "status")


@query(f"""WITH asked AS (SELECT record_id, {_title_sql('title')} AS k FROM raw_book),
    ol AS (SELECT DISTINCT {_title_sql('title')} AS k FROM openlibrary_search), gb AS (SELECT DISTINCT {_title_sql('volumeinfo.title')} AS k FROM googlebooks_volumes),
    gu AS (SELECT DISTINCT {_title_sql('title')} AS k FROM gutendex_page1)
    SELECT record_id, CASE WHEN ol.k IS NOT NULL THEN 'openlibrary' WHEN gb.k IS NOT NULL THEN 'googlebooks' WHEN gu.k IS NOT NULL THEN 'gutendex' END AS resolved_by
    FROM asked LEFT JOIN ol ON asked.k = ol.k LEFT JOIN gb ON asked.k = gb.k LEFT JOIN gu ON asked.k = gu.k""")
def resolution_outcomes(spark: SparkSession, d: str) -> DataFrame:
    asked = _raw(spark, d).select("record_id", text.title_form(F.col("title")).alias("k"))
    keys = lambda name, column: table(spark, d, name).select(text.title_form(F.col(column)).alias("k"))
    answers = {"openlibrary": keys("openlibrary_search", "title"), "googlebooks": keys("googlebooks_volumes", "volumeinfo.title"), "gutendex": keys("gutendex_page1", "title")}
    return policy.resolve(asked, answers, "k", ["openlibrary", "googlebooks", "gutendex"]).select("record_id", "resolved_by")


_STATUS = """CASE WHEN coalesce(schema_version, -1) <> 1 THEN 'unsupported_version' WHEN event_type IS NULL OR event_type NOT IN ('book.raw', 'book.clean', 'run.partition_complete') THEN 'unknown_type'
    WHEN event_type <> 'run.partition_complete' AND (payload IS NULL OR NOT json_valid(payload)) THEN 'malformed'
    WHEN event_type <> 'run.partition_complete' AND NOT coalesce(length(source) > 0 AND length(source_id) > 0, false) THEN 'invalid'
    WHEN event_type = 'book.clean' AND identity_key IS NULL THEN 'invalid' ELSE 'ok' END"""


@query(f"SELECT delivery_id, {_STATUS} AS decode_status FROM book_messages")
def event_decode(spark: SparkSession, d: str) -> DataFrame:
    return events.message_status(table(spark, d, "book_messages")).select("delivery_id", "decode_status")


@query(f"SELECT delivery_id, {_STATUS} AS code FROM book_messages WHERE {_STATUS} <> 'ok'")
def dlq_split(spark: SparkSession, d: str) -> DataFrame:
    _, _, parked = events.route(events.message_status(table(spark, d, "book_messages")))
    letter = events.dead_letter(F.col("decode_status"), F.lit("not usable"), F.lit(1))
    return parked.select("delivery_id", F.get_json_object(letter, "$._failure.code").alias("code"))


@query(f"""SELECT run_id, topic, count(*) FILTER (WHERE s = 'ok' AND event_type <> 'run.partition_complete') AS loaded, count(*) FILTER (WHERE s <> 'ok') AS parked,
    count(*) FILTER (WHERE s = 'ok' AND event_type = 'run.partition_complete') AS markers FROM (SELECT *, {_STATUS} AS s FROM book_messages) GROUP BY run_id, topic""")
def additive_tally(spark: SparkSession, d: str) -> DataFrame:
    return events.tally(events.message_status(table(spark, d, "book_messages")), ["run_id", "topic"])


_TOPICS = "(SELECT DISTINCT run_id, topic, 3::BIGINT AS expected FROM book_messages WHERE run_id IS NOT NULL AND topic IS NOT NULL)"
_COMPLETE = f"""(SELECT t.run_id, t.topic, t.expected, count(DISTINCT m.partition_no) AS observed, count(DISTINCT m.partition_no) >= t.expected AS complete FROM {_TOPICS} t
    LEFT JOIN book_messages m ON m.run_id = t.run_id AND m.topic = t.topic AND m.event_type = 'run.partition_complete' GROUP BY 1, 2, 3)"""


def _completion(spark: SparkSession, d: str) -> DataFrame:
    sent = table(spark, d, "book_messages")
    topology = sent.where("run_id is not null and topic is not null").select("run_id", "topic").distinct().withColumn("expected", F.lit(3).cast("long"))
    markers = sent.where(F.col("event_type") == events.MARKER).select("run_id", "topic", F.col("partition_no").alias("partition"))
    return events.completed_partitions(markers, topology)


@query(f"SELECT * FROM {_COMPLETE}")
def marker_completion(spark: SparkSession, d: str) -> DataFrame:
    return _completion(spark, d)


@query(f"""SELECT run_id, CASE WHEN bool_and(complete) THEN 'success' ELSE 'processing' END AS status FROM {_COMPLETE} GROUP BY run_id""")
def finalise_runs(spark: SparkSession, d: str) -> DataFrame:
    completed = _completion(spark, d)
    runs = completed.select("run_id").distinct().withColumn("status", F.lit("processing"))
    return events.finalise(runs, completed)


@query("SELECT lower(p_name) AS sort_key, p_partkey FROM part WHERE lower(p_name) > 'h' OR (lower(p_name) = 'h' AND p_partkey > 0) ORDER BY 1, 2 LIMIT 100")
def keyset_page(spark: SparkSession, d: str) -> DataFrame:
    return search.keyset_page(table(spark, d, "part"), "p_name", "p_partkey", ("h", 0), 100)


_TERM = "SELECT record_id, unnest(list_distinct(regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+'))) AS term, {1} AS weight FROM raw_book"


@query(f"""SELECT record_id, sum(weight) AS score FROM ({_TERM.format('title', 1.0)} UNION ALL {_TERM.format('subtitle', 0.4)} UNION ALL {_TERM.format('description', 0.2)})
    WHERE term IN ('lantern', 'the') GROUP BY record_id HAVING count(DISTINCT term) = 2 ORDER BY score DESC, record_id LIMIT 50""")
def weighted_search(spark: SparkSession, d: str) -> DataFrame:
    found = search.search(search.term_table(_raw(spark, d), "record_id"), "record_id", ["the", "Lantern"], 50)
    return found.select("record_id", F.round("score", 6).alias("score"))


_GRAM = "list_distinct(flatten([[substr('  ' || w || ' ', i::INT, 3) for i in range(1, length(w) + 2)] for w in regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}]+')]))"


@query(f"""SELECT record_id, len(list_intersect(g, q)) / len(list_distinct(list_concat(g, q))) AS similarity FROM (
    SELECT record_id, {_GRAM.format('title')} AS g, {_GRAM.format("'the amber railway'")} AS q FROM raw_book WHERE title IS NOT NULL) WHERE len(list_intersect(g, q)) / len(list_distinct(list_concat(g, q))) >= 0.3""")
def trigram_lookup(spark: SparkSession, d: str) -> DataFrame:
    index = search.trigram_table(_raw(spark, d), "record_id", "title")
    return search.trigram_lookup(index, "record_id", "the amber railway", 0.3)


@query("""SELECT 'gutendex:' || id AS candidate_key, trim(title) AS title, list_filter([trim(a.name) for a in authors], lambda n: length(n) > 0)[1:5] AS authors, coalesce(languages, [])[1:3] AS languages
    FROM gutendex_page1 WHERE length(trim(title)) > 0 AND id IS NOT NULL AND len(list_filter([trim(a.name) for a in authors], lambda n: length(n) > 0)) > 0""")
def listing_candidates(spark: SparkSession, d: str) -> DataFrame:
    return readers.listing_candidates(table(spark, d, "gutendex_page1"))


@query("""SELECT record_id, title FROM raw_book WHERE record_id >= 300 ORDER BY record_id LIMIT 200""")
def discover_resume(spark: SparkSession, d: str) -> DataFrame:
    return readers.resume(_raw(spark, d).select("record_id", "title"), "record_id", 300, 200)


@query("""SELECT feed, max(file_id)::BIGINT AS position, (count(*) + 10)::BIGINT AS emitted, bool_or(file_seq >= 8) AS exhausted FROM openlibrary_search_raw GROUP BY feed""")
def position_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Resume positions per feed: the position is overwritten, the count added up, exhaustion overwritten."""
    lines = table(spark, d, "openlibrary_search_raw")
    stored = lines.select("feed").distinct().select("feed", F.lit(0).cast("long").alias("position"), F.lit(10).cast("long").alias("emitted"), F.lit(False).alias("exhausted"))
    read = lines.groupBy("feed").agg(F.max("file_id").alias("position"), F.count("*").alias("emitted"), F.bool_or(F.col("file_seq") >= 8).alias("exhausted"))
    return upsert.upsert(stored, read, ["feed"], {"emitted": upsert.add})


def _observations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "book_sources").select("source", "raw_payload", "source_updated")


def _loaded(stored: dict[str, DataFrame], observations: DataFrame, at: str) -> dict[str, DataFrame]:
    return {name: cut_lineage(frame) for name, frame in load.load_batch(stored, observations, F.lit(at).cast("timestamp")).items()}


@query("""SELECT * FROM (VALUES ('books', 0::BIGINT), ('book_sources', 0), ('authors', 0), ('book_authors', 0), ('subjects', 0), ('book_subjects', 0), ('series', 0), ('book_series', 0),
    ('rejected_records', 0)) t(table_name, changed) UNION ALL SELECT 'accounts', count(*) FROM book_sources""")
def load_twice(spark: SparkSession, d: str) -> DataFrame:
    """All stored payloads loaded into an empty catalogue, and again: rows that differ after the second load, per table (the
    time an account was last seen aside), and how many accounts there are."""
    empty = {name: spark.createDataFrame([], schema) for name, schema in load.SCHEMAS.items()}
    first = _loaded(empty, _observations(spark, d), "2025-01-01 00:00:00")
    again = _loaded(first, _observations(spark, d), "2025-01-02 00:00:00")
    found = first["book_sources"].agg(F.lit("accounts").alias("table_name"), F.count("*").alias("changed"))
    for name in load.SCHEMAS:
        one, two = (tables[name].drop("last_seen_at") for tables in (first, again))
        apart = one.exceptAll(two).unionByName(two.exceptAll(one))
        found = found.unionByName(apart.agg(F.lit(name).alias("table_name"), F.count("*").alias("changed")))
    return found


@query(f"""WITH RECURSIVE {_CLEAN}, mine AS (SELECT source_id, isbn13, 'fallback:' || sha256(normalised_title || chr(0) || coalesce(normalised_first_author, '') || chr(0) || coalesce(published_year::VARCHAR, '')) AS fallback
      FROM accounts WHERE source = 'googlebooks'),
    tied AS (SELECT DISTINCT a.source_id AS x, b.source_id AS y FROM mine a JOIN mine b ON a.isbn13 = b.isbn13 OR a.fallback = b.fallback),
    reach(x, y) AS (SELECT x, y FROM tied UNION SELECT r.x, t.y FROM reach r JOIN tied t ON r.y = t.x)
    SELECT x AS source_id, coalesce('isbn:' || min(m.isbn13), min(m.fallback)) AS identity_key, count(DISTINCT y) AS accounts FROM reach JOIN mine m ON m.source_id = y GROUP BY x""")
def load_promote(spark: SparkSession, d: str) -> DataFrame:
    """One provider's payloads loaded without their ISBNs, then as they are: fallback identities are promoted to ISBNs in
    place, books of one ISBN are merged, and every account stays. Per account its book's identity and number of accounts."""
    own = _observations(spark, d).where("source = 'googlebooks'")
    bare = own.withColumn("raw_payload", F.regexp_replace("raw_payload", r'"industryIdentifiers": ?\[[^\]]*\]', '"industryIdentifiers": []'))
    empty = {name: spark.createDataFrame([], schema) for name, schema in load.SCHEMAS.items()}
    after = _loaded(_loaded(empty, bare, "2025-01-01 00:00:00"), own, "2025-01-02 00:00:00")
    books, accounts = after["books"].select("book_id", "identity_key"), after["book_sources"].select("book_id", "source_id")
    sizes = accounts.groupBy("book_id").agg(F.count("*").alias("accounts"))
    return accounts.join(books, "book_id").join(sizes, "book_id").select("source_id", "identity_key", "accounts")
