"""Pages of repeated keywords, links, tags, menus and prices, told from sentences.

A page is cut into segments (lines, and sentences within lines). Term recurrence is measured at each position of the
page: whether the pair of content words there returns after at most ``MAX_LAG`` words, in sentences rare, in stuffed text
the rule (positional autocorrelation over lag windows); and over sentences: whether a run of words returns in nearly
every one. A segment counts as stuffing if its pairs mostly recur, if it holds what all sentences repeat, if it is a list
of names without function words, or if it is nothing but a link, tags, spelled-out letters or a fragment without a
sentence's end. A page is flagged if more than ``STUFFED_SHARE`` of its characters lie in such segments. The work per
page grows in proportion to its words.

Everything is computed within a row by array functions, so no text is ever shuffled. Identical segments are counted once
when the recurrence of terms is measured: a refrain between differing lines is verse, not stuffing. Segments that recur
``MANY`` times are measured apart: where they make up more than ``MOST`` of the page's characters, those of them whose
words are mostly content words are stuffing. A text of ordinary sentences that is repeated as a whole stays genuine.

Defined results: null, empty and blank texts and texts of fewer than ``MIN_WORDS`` words, repeated ones included, are
genuine unless they hold several links or tags; every copy of a page is judged alike; extra columns are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.bind import let
from quire.session import check_columns

MAX_LAG = 12
MAX_WORD_LAG = 8
MIN_WORDS = 8
#: Measured shares lie below 0.3 for genuine and above 0.45 for stuffed pages; titles inside stuffing pass as prose.
STUFFED_SHARE = 0.4
#: Occurrences from which a segment is a recurring one, and the share of a page above which such segments are judged:
#: refrains measured make up at most 0.52 of a page.
MANY = 4
MOST = 0.6
#: Share of a page's sentences that must hold a run of words for it to be what they repeat, and the least number of them.
KEYWORD_SENTENCES = 0.9
LEAST_SENTENCES = 3
#: Share of function words below which a recurring segment is made of keywords.
KEYWORDS = 0.5
#: Function words of the corpus' languages (fixed values).
FUNCTION_WORDS = (
    "a about after all although always an and any are as at be because been before but by can could did do does for from "
    "had has have he her here him his how i if in into is it its just like me more most my never no nobody not nothing of on "
    "one only or other our out over she so some such than that the their them then there these they this those to too until "
    "up was we were what when where which while who whom whose will with without would you your "
    "aber alle als am an auch auf aus bei bis da dass das dem den der des die doch durch ein eine einem einen einer eines er "
    "es für hat ich ihr im in ist man mehr mit nach nicht nie niemand noch nur ob obwohl oder ohne schon sein sich sie sind so "
    "um und unter vom von vor war wenn wer werden wie wird wurde zu zum zur "
    "au aux avec ce ces cette chaque dans de des du elle en est et il ils je la le les leur lui mais ne on ou où par pas "
    "pendant personne plus pour qu que qui sa sans se ses son sur un une vous y à fut bien jusqu "
    "al aunque como con cuando del durante el ella en entre era es esta este fue ha hasta la las lo los más me mi muy nadie "
    "no o para pero por porque que quien se si sin su sus también tan todo un una y ya sobre"
)
_LINK = (
    r"(?i)<a\s[^>]*>.*?</a>|\[[^\]\n]*\]\([^)\n]*\)|(?:https?:)?//[^\s<>)\"]+|\bwww\.[^\s<>)]+|\b[a-z0-9-]+(?:\.[a-z0-9-]+)+/[^\s<>)]*"
)
_WORD = r"[\p{L}\p{M}\p{N}]+"
_BUCKETS = 128
_LEADER = r"(?:\.\s?){3,}\s*\d+\s*$"
_PRICE = r"[$€£]\s?\d|\d\s?(?:[$€£]|EUR|USD|GBP)\b"
_SPACE_LIKE = r"[\x{200b}-\x{200d}\x{2060}\x{feff}\x{ad}]"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def _tokens(words: Column) -> Column:
    """``words`` with ¤ for each function word, which is looked up in one of ``_BUCKETS`` short strings."""
    table = F.array(*[F.lit(" " + " ".join(bucket) + " ") for bucket in _function_buckets()])
    found = lambda w: F.element_at(table, (F.crc32(w) % _BUCKETS + 1).cast("int")).contains(F.concat(F.lit(" "), w, F.lit(" ")))
    return F.transform(words, lambda w: F.when(found(w), F.lit("¤")).otherwise(w))


def _function_buckets() -> list[list[str]]:
    buckets: list[list[str]] = [[] for _ in range(_BUCKETS)]
    for word in sorted(set(FUNCTION_WORDS.split())):
        buckets[zlib.crc32(word.encode()) % _BUCKETS].append(word)
    return buckets


def _has_link(text: Column) -> Column:
    """Whether a text can hold a link at all: a cheap guard before the pattern."""
    return text.contains("/") | text.contains("](") | text.contains("www.")


def _pairs(words: Column) -> Column:
    """Adjacent content words as one text each, null where a function word is between; as long as ``words`` less one."""
    n = F.size(words)
    pair = lambda x, y: F.when((x != "¤") & (y != "¤"), F.concat(x, F.lit(" "), y))
    return F.zip_with(F.slice(words, 1, F.greatest(n - 1, F.lit(0))), F.slice(words, 2, F.greatest(n - 1, F.lit(0))), pair)


def _recurs(items: Column, lags: int) -> Column:
    """For each position whether its item stands at most ``lags`` positions before or after it as well; null items never do."""

    def near(x: Column) -> Column:
        before = lambda v, i: F.array_contains(F.slice(x, F.greatest(i - lags, F.lit(0)) + 1, F.least(i, F.lit(lags))), v)
        after = lambda v, i: F.array_contains(F.slice(x, i + 2, F.lit(lags)), v)
        return F.transform(x, lambda v, i: v.isNotNull() & F.coalesce(before(v, i) | after(v, i), F.lit(False)))

    return let(items, near)


def recurrences(words: Column) -> Column:
    """struct(pairs, words): per position whether the content pair that starts there recurs within ``MAX_LAG`` words, and
    whether the content word there does within ``MAX_WORD_LAG``: positional autocorrelation over lag windows."""
    content = F.transform(words, lambda w: F.when((w != "¤") & (F.length(w) > 1), F.xxhash64(w)))
    pairs = F.transform(_pairs(words), lambda p: F.when(p.isNotNull(), F.xxhash64(p)))
    return F.struct(_recurs(pairs, MAX_LAG).alias("pairs"), _recurs(content, MAX_WORD_LAG).alias("words"))


def _lines(text: Column) -> Column:
    plain = F.regexp_replace(text, r"(?i)</?(?:p|li|ul|ol|div|br|tr|td|h[1-6]|table)\b[^>]*>", "\n")
    lines = F.split(plain, r"[\n\r\x{85}\x{2028}\x{2029}]+")
    return F.filter(lines, lambda s: s.rlike(r"(?U)\S"))


def _segments(lines: Column) -> Column:
    """Lines with a link as they are, other lines cut after each sentence."""
    cut = lambda s: F.when(_has_link(s) & s.rlike(_LINK), F.array(s)).otherwise(F.split(s, r"(?<=[.!?…。]|[.!?…。][\"”»’)])\s+"))
    return F.filter(F.flatten(F.transform(lines, cut)), lambda s: s.rlike(r"(?U)\S"))


def _runs(words: Column, tokens: Column) -> Column:
    """Hashes of the distinct runs of three words of which two or more are content words."""
    n = F.size(words)

    def run(i: Column) -> Column:
        content = sum(((F.element_at(tokens, i + k) != "¤").cast("int") for k in range(3)), F.lit(0))
        return F.when(content >= 2, F.xxhash64(*[F.element_at(words, i + k) for k in range(3)]))

    return F.when(n >= 3, F.array_distinct(F.array_compact(F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), run)))).otherwise(F.array().cast("array<bigint>"))


def _prepare(segment: Column) -> Column:
    """struct(text, rest without links, links, words of the rest, hash of these words or null without words, runs)."""
    maybe = _has_link(segment)
    rest = F.when(maybe, F.regexp_replace(segment, _LINK, " ")).otherwise(segment)
    links = F.when(maybe, F.regexp_count(segment, F.lit(_LINK))).otherwise(0)
    hashed = lambda w: F.when(F.size(w) > 0, F.xxhash64(w)).alias("hash")
    whole = lambda r, w, k: F.struct(segment.alias("text"), r.alias("rest"), links.alias("links"), k.alias("words"), hashed(w), _runs(w, k).alias("runs"))
    return let(rest, lambda r: let(_words(r), lambda w: let(_tokens(w), lambda k: whole(r, w, k))))


def _keyword_runs(segments: Column) -> Column:
    """Runs of words that stand in nearly every sentence of a page: what the sentences are there to repeat. Sorted, a run
    that ``m`` segments hold is equal to the one ``m`` - 1 places on."""
    told = F.filter(segments, lambda s: s["hash"].isNotNull())

    def held(h: Column, n: Column) -> Column:
        m = F.greatest(F.lit(LEAST_SENTENCES), F.ceil(n * KEYWORD_SENTENCES).cast("int"))
        last = F.greatest(F.size(h) - m + 1, F.lit(0))
        return F.array_distinct(F.array_compact(F.zip_with(F.slice(h, F.lit(1), last), F.slice(h, m, last), lambda a, b: F.when(a == b, a))))

    return let(told, lambda x: let(F.array_sort(F.flatten(F.transform(x, lambda s: s["runs"]))), lambda h: held(h, F.size(x))))


def _recurring(segments: Column) -> Column:
    """Hashes of the segments that occur ``MANY`` times if these make up more than ``MOST`` of the characters, else none."""
    hashes = F.array_sort(F.filter(F.transform(segments, lambda s: s["hash"]), lambda h: h.isNotNull()))
    total = lambda items: F.aggregate(items, F.lit(0).cast("long"), lambda t, s: t + F.length(s["text"]))

    def many(h: Column) -> Column:
        m = F.greatest(F.size(h) - (MANY - 1), F.lit(0))
        same = F.zip_with(F.slice(h, F.lit(1), m), F.slice(h, F.lit(MANY), m), lambda a, b: F.when(a == b, a))
        return F.array_distinct(F.filter(same, lambda a: a.isNotNull()))

    def most(found: Column) -> Column:
        of = F.filter(segments, lambda s: F.array_contains(found, s["hash"]))
        return F.when((F.size(found) > 0) & (total(of) > MOST * total(segments)), found).otherwise(F.array().cast("array<bigint>"))

    return let(let(hashes, many), most)


def _judge(segment: Column, pairs: Column, recurring_words: Column, recurring: Column, keyed: Column) -> Column:
    """True if a prepared segment is stuffing, given which of its pairs and words recur and the page's recurring segments
    and keyword runs."""
    text, rest, words = segment["text"], segment["rest"], segment["words"]
    n = F.size(words).cast("double")
    share = lambda condition: F.size(F.filter(words, condition)) / F.greatest(n, F.lit(1.0))
    true = lambda flags: F.size(F.filter(flags, lambda x: x))
    measures = F.struct(
        n.alias("n"),
        (segment["links"] > 0).alias("linked"),
        share(lambda w: w == "¤").alias("function"),
        share(lambda w: (F.length(w) == 1) & (w != "¤")).alias("letters"),
        (true(pairs) / F.greatest(n - 1, F.lit(1.0))).alias("repeated"),
        true(recurring_words).alias("recurring"),
        F.when(text.contains("#"), F.regexp_count(text, F.lit(r"(?<!\S)#[\p{L}\p{N}]"))).otherwise(0).alias("tags"),
        F.regexp_count(text, F.lit(r"[,;|•·/+>›»–—]|\s-\s")).alias("separators"),
        (rest.rlike(r"[.!?…。,;:][\s\"”»’)\]*_]*$") & rest.rlike(r"\p{L}{2}")).alias("ended"),
        F.coalesce(F.array_contains(recurring, segment["hash"]), F.lit(False)).alias("recurs"),
        F.arrays_overlap(segment["runs"], keyed).alias("keyed"),
    )

    def decide(m: Column) -> Column:
        sentence = m["ended"] & (m["n"] >= 4)
        prose = (m["n"] >= 15) & (m["function"] >= 0.22)
        return (
            F.when(m["linked"] & ~(sentence & (m["n"] >= 8) & (m["function"] >= 0.15)), True)
            .when((m["recurs"] & (m["function"] < KEYWORDS)) | m["keyed"], True)
            .when((m["tags"] >= 3) & (m["tags"] >= 0.4 * m["n"]), True)
            .when((m["letters"] > 0.5) & (m["n"] >= 8), True)
            .when((m["repeated"] >= 0.25) & (m["n"] >= 4), True)
            .when((m["recurring"] >= 3) & (m["recurring"] >= 0.6 * m["n"] * (1 - m["function"])), True)
            .when((m["function"] < 0.12) & (m["n"] >= 10) & (m["separators"] >= 0.2 * m["n"]), True)
            .when((m["n"] < 15) & (m["function"] < 0.4) & text.rlike(_PRICE), True)
            .when(sentence | prose, False)
            .otherwise(~text.rlike(_LEADER))
        )

    return let(measures, decide)


def stuffing_shares(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_links, share: the share of each text's characters that lies in stuffed segments."""

    def page(segments: Column) -> Column:
        n_words = F.aggregate(segments, F.lit(0), lambda n, s: n + F.size(s["words"]))
        hashes = F.transform(segments, lambda s: s["hash"])
        # Identical segments are measured once, at the place of the first.
        unique = let(hashes, lambda h: F.filter(segments, lambda s, i: F.array_position(h, s["hash"]) == i + 1))

        def placed(own: Column) -> Column:
            start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
            step = lambda a, s: F.struct((a["at"] + F.size(s["words"])).alias("at"), F.concat(a["starts"], F.array(a["at"])).alias("starts"))
            flat = F.flatten(F.transform(own, lambda s: s["words"]))
            return F.struct(
                F.transform(own, lambda s: s["hash"]).alias("hashes"), F.aggregate(own, start, step)["starts"].alias("starts"), recurrences(flat).alias("recur"),
                _recurring(segments).alias("recurring"), _keyword_runs(segments).alias("keyed"),
            )

        def judged(m: Column) -> Column:
            def one(s: Column) -> Column:
                n = F.size(s["words"])
                stuffed = let(
                    F.coalesce(F.get(m["starts"], (F.array_position(m["hashes"], s["hash"]) - 1).cast("int")), F.lit(0)),
                    lambda at: _judge(
                        s, F.slice(m["recur"]["pairs"], at + 1, F.greatest(n - 1, F.lit(0))), F.slice(m["recur"]["words"], at + 1, n), m["recurring"], m["keyed"]
                    ),
                )
                return F.struct(F.length(s["text"]).alias("chars"), stuffed.alias("stuffed"), s["links"].alias("links"))

            return F.struct(n_words.alias("n_words"), F.transform(segments, one).alias("segments"))

        return let(let(unique, placed), judged)

    def sums(p: Column) -> Column:
        start = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("chars", "stuffed", "links")])
        add = lambda a, s: F.struct(
            (a["chars"] + s["chars"]).alias("chars"),
            (a["stuffed"] + F.when(s["stuffed"], s["chars"]).otherwise(0)).alias("stuffed"),
            (a["links"] + s["links"]).alias("links"),
        )
        return let(
            F.aggregate(p["segments"], start, add),
            lambda t: F.struct(
                p["n_words"].alias("n_words"), t["links"].alias("n_links"), F.when(t["chars"] > 0, t["stuffed"] / t["chars"]).otherwise(0.0).alias("share")
            ),
        )

    cleaned = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), _SPACE_LIKE, " ")
    texts = check_columns(documents, ["doc_id", "text"])
    return texts.select("doc_id", let(let(F.transform(_segments(_lines(cleaned)), _prepare), page), sums).alias("page")).select("doc_id", "page.*")


def stuffed_pages(documents: DataFrame) -> DataFrame:
    """doc_id of each page most of whose text is stuffing."""
    enough = (F.col("n_words") >= MIN_WORDS) | (F.col("n_links") >= 3)
    return stuffing_shares(documents).where(enough & (F.col("share") > STUFFED_SHARE)).select("doc_id")
