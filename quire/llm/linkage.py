"""Records of different sources that describe the same thing, linked without a common key, with a confidence.

Titles are cleaned of what editions add (carriers, series, inverted articles), misspelt words are led to the common word
near them, and what makes another work of it (a volume, a sequel, a guide, a retelling) becomes part of the title's key.
Records that share a key and an author, an ISBN or, where authors are missing, another attribute are candidates. On
each candidate a set of matching functions votes yes, no or nothing. A generative label model learns from the votes
alone how often each function is right in either class, by expectation maximisation over the distinct vote patterns,
merges functions whose errors are correlated into one factor, and gives each pattern a posterior.

Only vote patterns and their counts reach the driver (at most 3 to the number of functions). Candidates are formed per
key *and* attribute, so a common title (Poems, Home) does not become a block.

Defined results: records without a title match nothing; null attributes abstain; repeated extractions of a record are
records of their own; records of one source are never paired; an empty table gives no pairs.
"""

from __future__ import annotations

import html
import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import names
from quire.operators import skew
from quire.session import check_columns, cut_lineage

FUNCTIONS = ("title", "volume", "derived", "authors", "isbns", "year", "publisher", "pages", "subtitle", "language")
#: Confidence from which a candidate is a match.
THRESHOLD = 0.5
#: Functions whose residual correlation exceeds this are modelled together.
CORRELATED = 0.25
ROUNDS = 200

_NUMBERS = {w: i for i, w in enumerate("zero one two three four five six seven eight nine ten eleven twelve".split())}
_ROMAN = {"i": 1, "ii": 2, "iii": 3, "iv": 4, "v": 5, "vi": 6, "vii": 7, "viii": 8, "ix": 9, "x": 10}
_VOLUME = {"part", "pt", "volume", "vol", "v", "book", "bk", "band", "tome", "teil"}
#: What comes before or after a work's title when another work is meant (fixed values).
BEFORE = (
    ("study", "questions", "for"), ("summary", "of"), ("readers", "guide", "to"), ("study", "guide", "to"), ("companion", "to"), ("notes", "on"), ("return", "to"),
    ("beyond",), ("last", "of"), ("key", "to"), ("analysis", "of"), ("guide", "to"), ("workbook", "for"), ("more", "about"),
)
AFTER = (
    ("continued",), ("retold", "for", "children"), ("the", "workbook"), ("workbook",), ("the", "return"), ("study", "guide"), ("readers", "guide"), ("abridged",),
    ("for", "children"), ("the", "sequel"), ("teachers", "edition"),
)
#: Additions that make no other work of it (fixed values).
EDITIONS = (("a", "facsimile"), ("facsimile",), ("a", "facsimile", "edition"), ("large", "type", "edition"), ("paperback",), ("hardcover",), ("electronic", "resource"), ("reprint",))
GENRES = "novel romance comedy tragedy memoir history mystery fable study companion tale story biography poem play thriller".split()
_ARTICLES = {"the", "a", "an"}
_ROLE = r"(?i)\((?:illustrator|translator|narrator|editor|foreword|introduction|contributor)[^)]*\)"


def title_tokens(title: str | None, subtitle: str | None) -> list[str]:
    """Words of a title and subtitle, | where a colon, semicolon, dash or $b divides them."""
    def plain(text: str | None) -> str:
        text = unicodedata.normalize("NFKD", html.unescape(html.unescape(text or "")))
        text = "".join(c for c in text if not unicodedata.combining(c)).casefold()
        return re.sub(r"(?<=[^\W\d_])1|1(?=[^\W\d_])", "l", text)

    text = re.sub(r"\s*\[[^\]]*\]|\s*\([^)]*\)", " ", plain(title))
    # An article moved behind the title goes back in front of it.
    text = re.sub(r"^([^:;|]*?),\s*(the|a|an)(?=\s*(?:$|[:;.,|]|\$b|(?:part|vol(?:ume)?|v|book|bk)\b))", r"\2 \1", text)
    text = re.sub(r"^(.*),\s*(the|a|an)\s*\.?\s*$", r"\2 \1", text)
    whole = f"{text} : {plain(subtitle)}" if subtitle and subtitle.strip() else text
    whole = re.sub(r"\$b|[:;|]|\s[-–—]\s", " | ", whole.replace("&", " and "))
    whole = re.sub(r"(?<=\w)['’](?=\w)", "", whole)
    words = [w.replace("rn", "m").replace("vv", "w") for w in re.findall(r"[^\W_]+|\|", whole)]
    return words


_FOLD = lambda words: tuple(w.replace("rn", "m").replace("vv", "w") for w in words)


def title_key(tokens: list[str]) -> tuple[str, str, str, str, str] | None:
    """(base, volume, derived, subtitle, head): the title's words; its volume; what it is derived as; the base's first part;
    null without words."""
    parts: list[list[str]] = [[]]
    for t in tokens:
        parts.append([]) if t == "|" else parts[-1].append(t)
    parts = [p for p in parts if p]
    volume, kinds, subtitles, main, head = "", [], [], [], ""

    def without_volume(words: list[str]) -> list[str]:
        nonlocal volume
        for i, w in enumerate(words):
            if w in _VOLUME and i + 1 < len(words) and (n := words[i + 1]) and (n.isdigit() or n in _NUMBERS or n in _ROMAN):
                volume = volume or str(int(n) if n.isdigit() else _NUMBERS.get(n) or _ROMAN.get(n))
                return words[:i] + words[i + 2 :]
        if (len(words) > 1 or main) and (words[-1] in _ROMAN or words[-1].isdigit() and len(words[-1]) < 3):
            volume = volume or str(_ROMAN.get(words[-1]) or int(words[-1]))
            return words[:-1]
        return words

    def bare(words: list[str]) -> list[str]:
        return words[1:] if len(words) > 1 and words[0] in _ARTICLES else words

    for at, words in enumerate(parts):
        words = without_volume(words)
        changed = True
        while changed and words:
            changed = False
            for mark in EDITIONS:
                if tuple(words[-len(mark) :]) == _FOLD(mark) and (at or len(words) > len(mark)):
                    words, changed = words[: -len(mark)], True
            for mark in AFTER:
                if tuple(words[-len(mark) :]) == _FOLD(mark) and (at or len(words) > len(mark)):
                    words, changed = words[: -len(mark)], True
                    kinds.append(" ".join(m for m in mark if m not in _ARTICLES))
            for mark in BEFORE:
                rest = bare(words)
                if not at and tuple(rest[: len(mark)]) == _FOLD(mark) and len(rest) > len(mark) and (mark != ("last", "of") or words[0] == "the"):
                    words, changed = rest[len(mark) :], True
                    kinds.append(" ".join(mark))
        if not words:
            continue
        rest = [w for w in words if w != "or"] if at else words
        generic = rest[:3] == list(_FOLD(("being", "the", "adventures"))) or rest[:2] == list(_FOLD(("notes", "from"))) or (
            len(bare(rest)) <= 2 and (bare(rest)[0] in _FOLD(GENRES) or bare(rest) == ["field", "guide"])
        )
        if at and (generic or words[0] == "or"):
            subtitles.append(" ".join(rest))
        else:
            main += bare(rest)
            head = head or "".join(main)
    key = "".join(main)
    return (key, volume, "+".join(sorted(set(kinds))), " ".join(subtitles), head) if key else None


def year_of(text: str | None) -> int | None:
    digits = re.search(r"(?<!\d)(1[4-9]\d\d|20\d\d|2100)(?!\d)", text or "")
    if digits:
        return int(digits[1])
    roman = re.search(r"\bM{1,2}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})\b", text or "")
    if not roman:
        return None
    worth = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100, "D": 500, "M": 1000}
    values = [worth[c] for c in roman[0]]
    year = sum(-v if v < max(values[i + 1 :], default=0) else v for i, v in enumerate(values))
    return year if 1400 <= year <= 2100 else None


def isbn13_of(text: str | None) -> str | None:
    """A valid ISBN as 13 digits."""
    found = re.match(r"\s*((?:\d[\s-]*){9,12}[\dXx])", text or "")
    code = re.sub(r"[\s-]", "", found[1]).upper() if found else ""
    if len(code) == 10 and sum((10 - i) * (10 if c == "X" else int(c)) for i, c in enumerate(code)) % 11 == 0:
        code = "978" + code[:9]
        return code + str(-sum(int(c) * (1, 3)[i % 2] for i, c in enumerate(code)) % 10)
    ok = len(code) == 13 and code.isdigit() and sum(int(c) * (1, 3)[i % 2] for i, c in enumerate(code)) % 10 == 0
    return code if ok else None


_PREPARED = "tokens array<string>, year int, isbns array<string>, publisher string, languages array<string>"
_UNKNOWN = {"", "sn", "unknown", "none", "na", "unknownpublisher", "publisherunknown", "publishernotidentified", "null"}
_LANGUAGES = {"de": "ger", "fr": "fre", "es": "spa", "en": "eng", "deu": "ger", "fra": "fre", "it": "ita", "nl": "dut"}


def prepare(records: DataFrame) -> DataFrame:
    """record_id, source, tokens, author_names, isbns, year, publisher, pages, languages."""
    wanted = check_columns(records, ["record_id", "source", "title", "subtitle", "authors", "isbns", "published", "publisher", "page_count", "languages"])

    @F.pandas_udf(_PREPARED)
    def clean(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for title, subtitle, isbns, published, publisher, languages in batches:
            rows = []
            for t, s, i, y, p, l in zip(title, subtitle, isbns, published, publisher, languages):
                house = re.sub(r"[\W_]", "", (p or "").casefold())
                first = (re.findall(r"\w+", (p or "").casefold()) or [""])[0]
                rows.append((
                    title_tokens(t, s), year_of(y), sorted({c for x in (i if i is not None else []) if (c := isbn13_of(x))}), None if house in _UNKNOWN else first,
                    sorted({_LANGUAGES.get(x, x) for x in (l if l is not None else []) if x}),
                ))
            yield pd.DataFrame(rows, columns=["tokens", "year", "isbns", "publisher", "languages"]).astype({"year": "Int32"})

    people = F.transform(F.filter(F.coalesce("authors", F.array()), lambda a: a["name"].isNotNull() & ~a["name"].rlike(_ROLE)), lambda a: a["name"])
    done = wanted.withColumn("p", clean.asNondeterministic()("title", "subtitle", "isbns", "published", "publisher", "languages"))
    pages = F.when(F.col("page_count") > 0, F.col("page_count"))
    return done.select("record_id", "source", "p.*", people.alias("author_names"), pages.alias("pages")).where(F.size("tokens") > 0)


def corrected_words(rows: DataFrame) -> DataFrame:
    """word, right: misspelt title words and the commoner word within two edits (one for short ones)."""
    words = rows.select(F.explode("tokens").alias("word")).where(F.length("word") >= 4).groupBy("word").agg(F.count("*").alias("n"))
    words = cut_lineage(words.where(~F.col("word").rlike(r"\d")))
    near = names.towards_common(names.segment_join(words, "word", (), ("n",), 6), (), F.expr(names.COMMONER)).where(
        "(from_n <= 3 or to_n >= 10 * from_n) and (length(`from`) >= 5 or to_n >= 10 * from_n) and (distance <= 1 or length(`from`) >= 7"
        " or (length(`from`) = 6 and to_n >= 20 * from_n) or array_sort(split(`from`, '')) = array_sort(split(`to`, '')))"
    )
    # A misspelling may be nearest to another one: a common word is the goal before a rare one.
    goal = F.struct((F.col("to_n") < 10).alias("rare"), F.col("distance"), -F.col("to_n"), F.col("to"))
    return near.groupBy(F.col("from").alias("word")).agg(F.min_by("to", goal).alias("right"))


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with key, volume, derived (as what), subtitle, head (the key less an unlisted subtitle, null if it has none) and
    authors (family and initial of the given name)."""
    fixes = corrected_words(rows)
    # Only rows that hold a misspelt word are taken apart.
    wrong = (
        rows.select("record_id", F.posexplode("tokens").alias("at", "word")).join(fixes, "word").groupBy("record_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("at", "right"))).alias("fixes"))
    )
    fixed = rows.join(wrong, "record_id", "left")
    tokens = F.transform("tokens", lambda w, i: F.coalesce(F.try_element_at(F.col("fixes"), i), w))

    @F.pandas_udf("key string, volume string, derived string, subtitle string, head string")
    def key(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([title_key(list(t)) or (None,) * 5 for t in batch], columns=["key", "volume", "derived", "subtitle", "head"])

    titled = fixed.withColumn("k", key.asNondeterministic()(tokens))
    titled = titled.select("*", "k.key", "k.volume", "k.derived", "k.subtitle", F.expr("nullif(k.head, k.key)").alias("head")).drop("k", "tokens", "fixes").where("key is not null")

    spelled = rows.select(F.explode("author_names").alias("name")).distinct()
    parsed = names._with_family(cut_lineage(names._oriented(names.parse_names(spelled))))
    formal = F.create_map(*[F.lit(x) for short, full in names.NICKNAMES.items() for x in (short, full[0])])
    initial = F.coalesce(F.try_element_at(formal, F.col("first")), F.substring("first", 1, 1))
    person = parsed.select("name", F.concat_ws("|", "family", initial).alias("author"))
    listed = (
        rows.select("record_id", F.explode("author_names").alias("name")).join(person, "name").groupBy("record_id").agg(F.array_sort(F.collect_set("author")).alias("authors"))
    )
    return titled.join(listed, "record_id", "left").withColumn("authors", F.coalesce("authors", F.array().cast("array<string>"))).drop("author_names")


def _votes() -> list[Column]:
    """One column per matching function over the two sides ``a`` and ``b``: 1, -1, or 0 for no vote."""
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))

    def lists(c: str, against: bool) -> Column:
        some = (F.size(a(c)) > 0) & (F.size(b(c)) > 0)
        return F.when(F.arrays_overlap(a(c), b(c)), 1).when(some & F.lit(against), -1).otherwise(0)

    def scalar(c: str, same: Column) -> Column:
        return F.when(a(c).isNull() | b(c).isNull(), 0).when(same, 1).otherwise(-1)

    words = lambda c: F.when(F.length(c) > 0, c)
    sub_a, sub_b = words(a("subtitle")), words(b("subtitle"))
    added = F.coalesce(a("head") == b("key"), F.lit(False)) | F.coalesce(b("head") == a("key"), F.lit(False))
    marked = (a("volume") == b("volume")) & (a("derived") == b("derived"))
    return [
        # The whole title; a subtitle that only one side has is no contradiction.
        F.when((a("key") == b("key")) & marked, 1).when(added & marked, 0).otherwise(-1).alias("title"),
        F.when(a("volume") == b("volume"), 1).otherwise(-1).alias("volume"),
        F.when(a("derived") == b("derived"), 1).otherwise(-1).alias("derived"),
        lists("authors", True).alias("authors"),
        lists("isbns", False).alias("isbns"),
        scalar("year", F.abs(a("year") - b("year")) <= 1).alias("year"),
        scalar("publisher", a("publisher") == b("publisher")).alias("publisher"),
        scalar("pages", F.abs(a("pages") - b("pages")) <= F.greatest(F.lit(20), a("pages") / 20)).alias("pages"),
        F.when(sub_a.isNull() | sub_b.isNull(), 0).when(F.levenshtein(sub_a, sub_b, 3) >= 0, 1).otherwise(-1).alias("subtitle"),
        lists("languages", True).alias("language"),
    ]


def _meetings(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(probe, index): the keys under which a record asks for others and is found by others, as hashes.

    ``one_way`` keys are asked by one side only. Records meet under a title and an author, ISBN, year (of the year before
    or after as well) or publisher; where one has no author, under the title alone if most records of the title name one
    author; and under a title of which one has a subtitle more.
    """
    key = lambda what, *parts: F.xxhash64(F.lit(what), *parts)
    each = lambda what, title, items: F.transform(items, lambda x: key(what, F.col(title), x.cast("string")))
    none = F.array().cast("array<bigint>")
    when = lambda test, found: F.when(test, found).otherwise(none)
    silent, dated, housed = F.size("authors") == 0, F.col("year").isNotNull(), F.col("publisher").isNotNull()
    marked = rows.join(_one_work(rows), "key", "left").withColumn("few", F.coalesce("few", F.lit(False)))
    both = F.concat(each("author", "key", F.col("authors")), each("isbn", "key", F.col("isbns")))
    house = F.array(key("house", F.col("key"), F.col("publisher")))
    few = F.array(key("few", F.col("key")))
    near = F.array(*[key("year", F.col("key"), F.col("year") + d) for d in (-1, 0, 1)])
    bare = when(F.col("head").isNotNull(), F.concat(each("author", "head", F.col("authors")), each("isbn", "head", F.col("isbns"))))
    two_way = F.concat(both, when(dated, near))
    one_way = F.concat(bare, when(silent & housed, house), when(silent & F.col("few"), few))
    found = F.concat(both, when(dated, F.array(key("year", F.col("key"), F.col("year")))), when(housed, house), when(F.col("few"), few))
    made = cut_lineage(marked.select("record_id", "source", two_way.alias("two_way"), one_way.alias("one_way"), found.alias("found")))
    asks = F.concat(F.transform("two_way", lambda k: F.struct(k.alias("by"), F.lit(False).alias("one_way"))), F.transform("one_way", lambda k: F.struct(k.alias("by"), F.lit(True).alias("one_way"))))
    probe = made.select(F.col("record_id").alias("a"), F.col("source").alias("source_a"), F.explode(F.array_distinct(asks)).alias("k")).select("a", "source_a", "k.*")
    index = made.select(F.col("record_id").alias("b"), F.col("source").alias("source_b"), F.explode(F.array_distinct("found")).alias("by"))
    return probe, index


def _contrasts(rows: DataFrame) -> DataFrame:
    """record_a < record_b: each record beside the first one of a group it belongs to: the records of an ISBN, of a title,
    of an author and a title's first letters. One pair per record and group, however large the group is.

    Most of these are different works that have something in common, which the functions must tell from matches.
    """
    hashed = lambda what, *parts: F.xxhash64(F.lit(what), *parts)
    groups = F.concat(
        F.transform("isbns", lambda c: hashed("isbn", c.cast("string"))),
        F.array(hashed("title", F.col("key"))),
        F.transform("authors", lambda a: hashed("author", a, F.substring("key", 1, 4))),
    )
    member = rows.select("record_id", "source", F.explode(groups).alias("by"))
    # The hub of a group, and for records of the hub's own source the first one of another source.
    first = member.groupBy("by").agg(F.min(F.struct("source", "record_id")).alias("low"), F.max(F.struct("source", "record_id")).alias("high")).where("low.source <> high.source")
    met = member.join(first, "by").select("record_id", F.when(F.col("source") == F.col("low.source"), F.col("high.record_id")).otherwise(F.col("low.record_id")).alias("hub"))
    return met.select(F.least("record_id", "hub").alias("record_a"), F.greatest("record_id", "hub").alias("record_b"))


def candidates(rows: DataFrame) -> DataFrame:
    """record_a < record_b and their votes: the pairs of different sources that meet under a key, and contrasts to them.

    Pairs are formed from ids and hashed keys alone, keys of many records are spread over tasks, and what is known about the
    records joins each distinct pair once. An ISBN alone forms no block, so a placeholder that many records hold costs one
    contrast per record.
    """
    probe, index = _meetings(rows.select("record_id", "source", "key", "head", "year", "isbns", "authors", "publisher"))
    met = skew.salted_join(probe, index, ["by"]).where("source_a <> source_b and a <> b and (one_way or a < b)")
    ids = met.select(F.least("a", "b").alias("record_a"), F.greatest("a", "b").alias("record_b")).unionByName(_contrasts(rows)).distinct()
    # What is only compared for equality travels as numbers.
    known = rows.select(
        "record_id", *[F.xxhash64(c).alias(c) if c == "key" else F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in ("key", "head", "publisher")], "volume", "derived",
        F.transform("authors", lambda a: F.xxhash64(a)).alias("authors"), F.transform("isbns", lambda c: c.cast("long")).alias("isbns"), "year", "pages", "subtitle", "languages",
    )
    side = lambda name: known.select(F.col("record_id").alias(f"record_{name}"), F.struct(*[c for c in known.columns if c != "record_id"]).alias(name))
    return ids.join(side("a"), "record_a").join(side("b"), "record_b").select("record_a", "record_b", *_votes())


def _one_work(rows: DataFrame) -> DataFrame:
    """key, few: the titles of author-less records that no two works contend for: one author is named by most records that name any."""
    asked = rows.where(F.size("authors") == 0).select("key").distinct()
    of = rows.join(asked, "key", "left_semi")
    leading = of.select("key", F.explode("authors").alias("author")).groupBy("key", "author").agg(F.count("*").alias("n"))
    leading = leading.groupBy("key").agg(F.max("n").alias("most"))
    counts = of.groupBy("key").agg(F.count_if(F.size("authors") > 0).alias("named"))
    return counts.join(leading, "key", "left").where("named = 0 or most >= 0.7 * named").select("key", F.lit(True).alias("few"))


class LabelModel:
    """One class of same pairs and one or two of different ones (records differ in more ways than one: other works, other
    parts of a work); in each class, conditionally independent factors of one or two functions. Fitted to vote patterns and
    their counts by expectation maximisation; how many classes there are is told by the Bayesian information criterion.

    An abstention says nothing in any class: a factor counts where it votes, and a pair of correlated functions is one
    factor where both vote. ``PRIOR_VOTES`` pseudo-votes lean each function towards being right.
    """

    PRIOR_VOTES = 5.0

    def __init__(self, patterns: np.ndarray, counts: np.ndarray) -> None:
        self.patterns, self.counts = patterns, counts.astype(float)
        best = min((self._settle(different) for different in (1, 2)), key=lambda fit: fit[0])
        _, self.classes, self.pairs = best
        self.posterior = self.classes[:, 0]

    def _settle(self, different: int) -> tuple[float, np.ndarray, list[tuple[int, int]]]:
        """(criterion, class probabilities per pattern, correlated pairs) of a model of so many classes of different pairs."""
        # A start by majority vote tells same from different; the first function splits the different ones.
        same = 1 / (1 + np.exp(-1.5 * self.patterns.sum(axis=1)))
        split = np.where(self.patterns[:, 0] < 0, 0.9, 0.1)
        start = np.stack([same, 1 - same], axis=1) if different == 1 else np.stack([same, (1 - same) * split, (1 - same) * (1 - split)], axis=1)
        classes, likelihood, free = self._fit(start, [])
        pairs = self._correlated(classes)
        if pairs:
            classes, likelihood, free = self._fit(classes, pairs)
        return free * math.log(max(self.counts.sum(), 2.0)) - 2 * likelihood, classes, pairs

    def _factors(self, pairs: list[tuple[int, int]]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows that vote, code of the vote, number of agreeing functions less disagreeing ones per code)."""
        out = []
        paired = {i: pair for pair in pairs for i in pair}
        for j, i in pairs:
            both = (self.patterns[:, i] != 0) & (self.patterns[:, j] != 0)
            out.append((both, (self.patterns[:, j] > 0) * 2 + (self.patterns[:, i] > 0), np.array([-2, 0, 0, 2])))
        for i in range(self.patterns.shape[1]):
            votes = self.patterns[:, i] != 0
            if i in paired:
                other = paired[i][0] if paired[i][1] == i else paired[i][1]
                votes = votes & (self.patterns[:, other] == 0)
            out.append((votes, (self.patterns[:, i] > 0).astype(int), np.array([-1, 1])))
        return out

    def _fit(self, start: np.ndarray, pairs: list[tuple[int, int]]) -> tuple[np.ndarray, float, int]:
        factors = self._factors(pairs)
        classes, likelihood = start, 0.0
        size = start.shape[1]
        for _ in range(ROUNDS):
            weight = self.counts[:, None] * classes
            share = (weight.sum(axis=0) + 1) / (self.counts.sum() + size)
            score = np.repeat(np.log(share)[None, :], len(self.patterns), axis=0)
            for votes, code, lean in factors:
                right = np.exp(0.7 * lean) / np.exp(0.7 * lean).sum()
                for c in range(size):
                    n = np.bincount(code, weight[:, c] * votes, len(lean)) + self.PRIOR_VOTES * (right if c == 0 else right[::-1])
                    score[:, c] += votes * np.log(n / n.sum())[code]
            top = score.max(axis=1, keepdims=True)
            new = np.exp(np.maximum(score - top, -40))
            likelihood = float((self.counts * (top[:, 0] + np.log(new.sum(axis=1)))).sum())
            new = new / new.sum(axis=1, keepdims=True)
            moved = np.abs(new - classes).max()
            classes = new
            if moved < 1e-6:
                break
        return classes, likelihood, size - 1 + size * sum(len(lean) - 1 for _, _, lean in factors)

    def _correlated(self, classes: np.ndarray) -> list[tuple[int, int]]:
        """Disjoint pairs of functions whose votes are correlated within the classes, strongest first."""
        found = []
        for of_class in classes.T:
            for i in range(self.patterns.shape[1]):
                for j in range(i):
                    both = (self.patterns[:, i] != 0) & (self.patterns[:, j] != 0)
                    weight = self.counts * of_class * both
                    if weight.sum() < 20:
                        continue
                    x, y = (self.patterns[:, k] - np.average(self.patterns[:, k], weights=weight) for k in (i, j))
                    spread = math.sqrt(np.average(x * x, weights=weight) * np.average(y * y, weights=weight)) + 1e-9
                    found.append((abs(np.average(x * y, weights=weight)) / spread, j, i))
        taken: set[int] = set()
        pairs = []
        for strength, j, i in sorted(found, reverse=True):
            if strength > CORRELATED and not {i, j} & taken:
                pairs.append((j, i))
                taken |= {i, j}
        return pairs


def link(records: DataFrame) -> DataFrame:
    """record_a, record_b, the votes, and ``confidence``, the posterior that the two are the same thing."""
    rows = cut_lineage(keyed(cut_lineage(prepare(records))))
    found = cut_lineage(candidates(rows))
    seen = found.groupBy(*FUNCTIONS).agg(F.count("*").alias("n")).collect()
    if not seen:
        return found.withColumn("confidence", F.lit(None).cast("double"))
    model = LabelModel(np.array([[r[f] for f in FUNCTIONS] for r in seen]), np.array([r["n"] for r in seen]))
    learnt = [(*[int(r[f]) for f in FUNCTIONS], float(p)) for r, p in zip(seen, model.posterior)]
    schema = ", ".join(f"{f} int" for f in FUNCTIONS) + ", confidence double"
    return found.join(F.broadcast(records.sparkSession.createDataFrame(learnt, schema)), list(FUNCTIONS))


def matches(records: DataFrame) -> DataFrame:
    """record_a, record_b, confidence of the candidates that the model takes for matches."""
    return link(records).where(F.col("confidence") >= THRESHOLD).select("record_a", "record_b", "confidence")


def open_records(raw_book: DataFrame, book_sources: DataFrame) -> DataFrame:
    """Records whose (source, source_id) no stored account has."""
    return raw_book.join(book_sources.select("source", "source_id"), ["source", "source_id"], "left_anti")
