"""One surviving record for each group of duplicates, field by field, by iterative truth discovery.

Each account of a book claims values for fields. In turn, a value's support is the sum of the reliabilities of the
sources that claim it, and a source's reliability is the mean share of support that its claims get, until the
reliabilities stand still; each field's survivor is the value of the highest support. Where the caller declares an
order of trust, the reliabilities are given, not estimated: weights in which each source outweighs all after it together
pass through the same supports, with one voice per source.

Claims of one group are never gathered: votes are counted per value and source, supports and survivors are partial
aggregates, and only the reliabilities, one number per source, reach the driver.

Defined results: unusable values (stand-ins, boilerplate, cut-off texts, no year, no positive page count) claim nothing;
a field without a usable value has no survivor; null update times rank last; repeated accounts count once each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import check_columns, cut_lineage

#: Most trusted first (fixed values).
TRUST = ("goodreads", "googlebooks", "openlibrary", "gutendex")
FIELDS = ("description", "publisher", "page_count", "published")
#: Sources an order of trust may name: beyond, powers of two are no longer exact.
MOST_TRUSTED = 50
#: Sources whose reliabilities the driver holds; more are an error.
MOST_SOURCES = 10_000
ROUNDS = 10
SETTLED = 1e-4

_EDGE = r"(?U)^\s+|\s+$"
_STAND_IN = (
    r"(?iu)^[\W_]*(?:n\s*/?\s*a|tba|tbd|tbc|null|none|nil|unknown|no (?:description|synopsis|summary|blurb)\b.*|keine? (?:beschreibung|inhaltsangabe)\b.*|"
    r"pas de (?:description|résumé)\b.*|sin (?:descripción|sinopsis|resumen)\b.*|(?:description|synopsis|summary|blurb|details)\s+(?:\S+\s+){0,2}(?:soon|follow|later|pending|unavailable|available)|"
    r"see the publisher\S* page\b.*|beschreibung folgt.*)[\W_]*$"
)
_BOILERPLATE = (
    r"(?iu)printed on demand|print(?:ed)?[- ]on[- ]demand|ships? within \w+ (?:working|business) days|this item is a facsimile|have not altered the scan|"
    r"returns are accepted|sold by a trusted seller|order now|may contain notes|good condition|nachdruck nach bestellung|spuren des originals|versand in \w+ tagen|"
    r"réimpression à la demande|expédié sous|impreso bajo demanda|free shipping|money[- ]back"
)
_CUT = r"(?iu)(?:\.\.+|…|&hellip;|&#8230;|\[\s*(?:\.{2,}|…)\s*\]|\((?:more|continued|cont\.?|mehr|suite|fortsetzung)\)|(?:read|see|show) (?:more|on)|weiterlesen|lire la suite|leer más)[\s.\])»”\"]*$"
_ENDED = r"(?u)[.!?。！？](?:[\s\"”’»')\]*_]|</[a-z]+>)*$"
_YEAR = r"(?<!\d)(?:1[4-9]\d\d|20\d\d|2100)(?!\d)"
_ROMAN = r"(?<![\p{L}\p{N}])(?:M(?:CD|DC{0,3}|CM)(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})|MM(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})|MMC)(?![\p{L}\p{N}])"
_NO_PUBLISHER = r"(?iu)^[\W_]*(?:n\s*/?\s*a|none|null|nil|unknown|unknown publisher|publisher unknown|publisher not identified|(?:no|not) (?:publisher|identified)|s\.?\s*n\.?|sine nomine|o\.?\s*v\.?|tba|self)?[\W_]*$"


def usable_description(text: Column) -> Column:
    """A whole text: at least three words, ended as a sentence, no stand-in, no boilerplate, not cut off."""
    trimmed = F.regexp_replace(text, _EDGE, "")
    words = F.size(F.split(trimmed, r"(?U)\s+"))
    return F.coalesce((words >= 3) & ~trimmed.rlike(_STAND_IN) & ~trimmed.rlike(_CUT) & trimmed.rlike(_ENDED) & ~trimmed.rlike(_BOILERPLATE), F.lit(False))


def usable_publisher(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}") & ~text.rlike(_NO_PUBLISHER), F.lit(False))


def usable_published(text: Column) -> Column:
    """A year from 1400 to 2100 in digits, or in Roman numerals of canonical form."""
    return F.coalesce(text.rlike(_YEAR) | text.rlike(_ROMAN), F.lit(False))


def usable_page_count(number: Column) -> Column:
    return F.coalesce(number > 0, F.lit(False))


USABLE = {"description": usable_description, "publisher": usable_publisher, "page_count": usable_page_count, "published": usable_published}


def comparable_value(field: str, column: Column) -> Column:
    """Values that say the same have one form: a year, a publisher without case, a text without white space."""
    if field == "published":
        digits = F.regexp_extract(column, _YEAR, 0)
        return F.when(digits != "", digits).otherwise(F.upper(column))
    if field == "page_count":
        return column.cast("string")
    return F.sha2(F.lower(F.regexp_replace(column, r"[^\p{L}\p{M}\p{N}]+", " ")), 256)


def accounts(book_sources: DataFrame, raw_book: DataFrame) -> DataFrame:
    """book_id, source, source_id, source_updated, and per field whether its value is usable and the value's form.

    Only flags and forms travel through the join, never the texts.
    """
    wanted = check_columns(raw_book, ["source", "source_id", "source_updated", *FIELDS])
    facts = wanted.select(
        "source", "source_id", "source_updated",
        *[F.when(USABLE[f](F.col(f)), comparable_value(f, F.col(f))).alias(f) for f in FIELDS],
    )
    return check_columns(book_sources, ["book_id", "source", "source_id"]).where("book_id is not null").join(facts, ["source", "source_id"])


def claims(of: DataFrame) -> DataFrame:
    """One row per usable value: book_id, field_name, form, source, source_id, source_updated."""
    listed = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("form")) for f in FIELDS])
    rows = of.select("book_id", "source", "source_id", "source_updated", F.explode(listed).alias("claim"))
    return rows.select("book_id", "source", "source_id", "source_updated", "claim.*").where("form is not null")


def discover(claimed: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """Reliability of each source: the mean share of support its claims get, iterated until it stands still."""
    votes = cut_lineage(claimed.groupBy("book_id", "field_name", "form", "source").agg(F.count("*").alias("n")))
    sources = [r["source"] for r in votes.select("source").distinct().limit(MOST_SOURCES + 1).collect()]
    if len(sources) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    reliability = dict.fromkeys(sources, 0.8)
    for _ in range(rounds):
        shares = _shares(votes, reliability)
        found = {
            r["source"]: r["mean"]
            for r in votes.join(shares, ["book_id", "field_name", "form"]).groupBy("source").agg((F.sum(F.col("n") * F.col("share")) / F.sum("n")).alias("mean")).collect()
        }
        moved = max((abs(found[s] - reliability[s]) for s in found), default=0.0)
        reliability.update(found)
        if moved < SETTLED:
            break
    return reliability


def _shares(votes: DataFrame, reliability: dict[str, float]) -> DataFrame:
    """book_id, field_name, form, support, share of the field's support."""
    rows = [(s, float(r)) for s, r in reliability.items()] or [("", 0.0)]
    weight = F.broadcast(votes.sparkSession.createDataFrame(rows, "source string, weight double"))
    # A source without a reliability supports nothing, but its claims stand where no other does.
    weighed = votes.join(weight, "source", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    supports = weighed.groupBy("book_id", "field_name", "form").agg(F.sum(F.col("weight") * F.col("n")).alias("support"))
    totals = supports.groupBy("book_id", "field_name").agg(F.sum("support").alias("total"))
    return supports.join(totals, ["book_id", "field_name"]).withColumn("share", F.coalesce(F.col("support") / F.nullif("total", F.lit(0.0)), F.lit(0.0)))


def given_weights(trust: Sequence[str]) -> dict[str, float]:
    """Reliabilities in which each source outweighs all that follow it together, however many claims agree: sources vote
    once per value, so powers of two suffice."""
    return {s: float(2 ** (len(trust) - 1 - i)) for i, s in enumerate(trust)}


def survivors(of: DataFrame, trust: Sequence[str] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """book_id, field_name, source, source_id: the account whose value survives, per field.

    The value of the highest support survives, and of the accounts that claim it the one of the weightiest source, then the
    latest, then the smallest source id. Without ``trust`` a value's support is the sum of the reliabilities of its claims,
    which are discovered. With ``trust`` (at most ``MOST_TRUSTED`` sources) the reliabilities are given, and each source
    votes once per value. A source's claims may differ among themselves: the exact check after the vote is that, of a
    trusted source's values, the one of its latest account stands for it.
    """
    claimed = claims(of)
    recent = [F.col("source_updated").isNull().alias("undated"), (-F.unix_micros(F.col("source_updated").cast("timestamp"))).alias("age"), F.col("source_id").alias("id")]
    who = F.struct("source", "source_id")
    if trust is not None:
        if len(trust) > MOST_TRUSTED:
            raise ValueError(f"an order of trust of more than {MOST_TRUSTED} sources")
        weights = given_weights(trust)
        # A source speaks with one voice: its latest claim on a field.
        voices = claimed.groupBy("book_id", "field_name", "source").agg(F.min_by(F.struct("form", "source_id", "source_updated"), F.struct(*recent)).alias("v"))
        claimed = voices.select("book_id", "field_name", "source", "v.*")
        votes = claimed.select("book_id", "field_name", "form", "source", F.lit(1).alias("n"))
    else:
        votes = claimed.groupBy("book_id", "field_name", "form", "source").agg(F.count("*").alias("n"))
        weights = discover(claimed, rounds)
    supports = _shares(votes, weights).select("book_id", "field_name", "form", "support")
    weighty = F.coalesce(*[F.when(F.col("source") == s, F.lit(-w)) for s, w in weights.items()], F.lit(0.0)) if weights else F.lit(0.0)
    ranked = claimed.join(supports, ["book_id", "field_name", "form"]).select(
        "book_id", "field_name", F.struct((-F.col("support")).alias("support"), weighty.alias("weight"), *recent, F.col("source").alias("s")).alias("rank"), who.alias("who")
    )
    return ranked.groupBy("book_id", "field_name").agg(F.min_by("who", "rank").alias("who")).select("book_id", "field_name", "who.*")


def of_several(of: DataFrame, book_sources: DataFrame) -> DataFrame:
    """Accounts of books with two or more of them."""
    several = book_sources.groupBy("book_id").agg(F.count("*").alias("n")).where("n >= 2").select("book_id")
    return of.join(several, "book_id", "left_semi")
