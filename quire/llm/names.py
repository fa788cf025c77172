"""Variant spellings of the names of persons and organisations, linked.

Names are parsed into a surname and given names (or an organisation's words), and variants are linked where they differ:

* a misspelt surname, or a misspelt given name among the bearers of one surname, by a pigeonhole segment join: each
  text is cut into k+1 segments, of which k edits leave one intact, the position-shifted substrings of the others are
  looked up in the inverted index of segments, and what meets is verified by a banded edit distance;
* initials, abbreviations and nicknames by the one bearer of the surname whose given name they fit. If they fit two
  bearers, they name neither.

All steps are joins on surname and segment over distinct forms, so no group of names is gathered in a task.

Defined results: null, blank and collective names (Anonymous, Various) are nobody; a spelling is one node however often
it occurs, and in whichever source; a name of one word is an organisation's or a mononym and links only to equal forms.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.operators import skew
from quire.session import cut_lineage

#: Short forms of given names (fixed values): nickname -> formal names.
NICKNAMES = {
    "abby": "abigail", "aggie": "agnes", "al": "albert alexander alfred", "alec": "alexander", "alex": "alexander", "andy": "andrew",
    "art": "arthur", "bea": "beatrice", "becky": "rebecca", "ben": "benedict benjamin", "bernie": "bernard", "bert": "bertram albert herbert hubert",
    "bess": "elizabeth", "beth": "elizabeth", "betsy": "elizabeth", "bettie": "elizabeth bettina", "betty": "elizabeth bettina", "biddy": "bridget",
    "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert", "bram": "abraham", "cathy": "katherine catherine", "charlie": "charles",
    "chuck": "charles", "cis": "cecily", "cissy": "cecily", "clem": "clement", "con": "conrad konrad", "cordy": "cordelia", "dan": "daniel",
    "dave": "david", "deb": "deborah", "debbie": "deborah", "delia": "cordelia", "dick": "richard", "dolly": "dorothy", "dom": "dominic",
    "dora": "theodora dorothy", "dot": "dorothy", "dottie": "dorothy", "drew": "andrew", "ed": "edmund edward edgar", "eddie": "edmund edward", "edie": "edith",
    "effie": "euphemia", "eli": "elias", "eliza": "elizabeth", "ellie": "eleanor", "ernie": "ernest", "ferdy": "ferdinand", "flo": "florence",
    "flora": "florence", "fran": "frances", "frank": "francis franklin", "fred": "frederick alfred", "freda": "winifred frederica", "freddie": "frederick",
    "gabe": "gabriel", "gail": "abigail", "gene": "eugene", "genny": "genevieve", "geordie": "george", "georgie": "georgina george", "gil": "gilbert",
    "ginny": "virginia", "greg": "gregory", "gus": "gustav augustus angus", "gussie": "augusta", "hal": "henry harold", "hank": "henry", "harry": "henry harold harriet",
    "hattie": "harriet", "hugh": "hubert", "iggy": "ignatius", "imo": "imogen", "izzy": "isabel isidore", "jack": "john", "jake": "jacob", "jem": "jeremy james",
    "jim": "james", "jo": "josephine joanna", "joe": "joseph", "jon": "jonathan", "josie": "josephine", "jude": "judith", "judy": "judith", "kate": "katherine",
    "kathy": "katherine", "kit": "christopher katherine", "kitty": "katherine", "larry": "laurence lawrence", "lena": "helena magdalena", "len": "leonard",
    "leo": "leopold leonard", "lew": "lewis", "libby": "elizabeth", "liz": "elizabeth", "lizzie": "elizabeth", "lou": "louis louisa", "lottie": "charlotte",
    "maddy": "madeleine", "maggie": "margaret", "marty": "martha martin", "matt": "matthew", "mattie": "matilda martha", "max": "maximilian", "meg": "margaret",
    "mike": "michael", "millie": "amelia millicent", "mina": "wilhelmina", "minnie": "wilhelmina", "mira": "miriam", "mort": "mortimer", "nan": "nancy anne",
    "nat": "nathaniel nathan", "ned": "edmund edward", "nell": "eleanor helen", "nellie": "eleanor helen", "nick": "nicholas", "nico": "nicholas", "nora": "eleanor",
    "ollie": "oliver", "oz": "oswald", "ozzie": "oswald", "pat": "patricia patrick", "patty": "patricia", "peg": "margaret", "peggy": "margaret", "penny": "penelope",
    "percy": "percival", "pete": "peter", "phil": "philip philippa", "pip": "philip philippa", "pippa": "philippa", "polly": "mary", "ray": "raymond",
    "reg": "reginald", "reggie": "reginald", "rich": "richard", "rick": "richard", "rob": "robert", "ron": "ronald", "roz": "rosalind", "rosie": "rosalind rose",
    "sadie": "sarah", "sal": "sarah", "sally": "sarah", "sam": "samuel", "sandy": "alexander", "seb": "sebastian", "si": "simon silas", "stan": "stanley",
    "steve": "stephen", "sue": "susannah susan", "sukie": "susannah", "susie": "susannah", "syl": "sylvia", "ted": "theodore edward edmund", "teddy": "theodore edward",
    "terry": "terence", "theo": "theodore", "tilda": "matilda", "tilly": "matilda", "tim": "timothy", "toby": "tobias", "tom": "thomas", "tommy": "thomas",
    "tony": "anthony", "val": "valentine", "vic": "victor victoria", "vicky": "victoria", "vin": "vincent", "vince": "vincent", "wally": "walter", "walt": "walter",
    "wilf": "wilfred", "will": "william", "willie": "william", "win": "winifred", "winnie": "winifred", "zach": "zachary", "zack": "zachary",
}
#: Words of organisations' names and their abbreviations (fixed values).
ORGANISATION = {
    "academy": "acad", "agency": "", "archive": "", "archives": "", "association": "assoc assn", "board": "", "bookbinders": "", "bureau": "", "center": "ctr", "centre": "",
    "church": "", "club": "", "college": "coll", "commission": "", "committee": "comm cttee", "company": "co", "congress": "", "corporation": "corp", "council": "",
    "department": "dept", "education": "educ", "engineers": "", "faculty": "", "federation": "fed", "foundation": "found fdn", "geographical": "geog", "guild": "",
    "historical": "hist", "institute": "inst", "institution": "", "laboratory": "lab", "league": "", "library": "lib", "literary": "lit", "ministry": "min", "museum": "mus",
    "office": "", "orchestra": "", "press": "", "public": "pub", "school": "sch", "society": "soc", "theatre": "theat", "theater": "", "union": "", "university": "univ",
    "botanical": "bot", "agriculture": "agric",
}
COLLECTIVE = {"anonymous", "anon", "various", "various authors", "unknown", "unknown author", "n a", "none", "null", "author unknown", "multiple authors", "et al"}
_EXPAND = {short: word for word, shorts in ORGANISATION.items() for short in shorts.split()}
_FILLER = {"the", "of", "for", "and", "issuing", "body", "eds", "ed", "publisher", "author", "editor", "in", "at", "a", "an"}

_FORM = "kind string, surname string, first string, second string, short boolean, role_first string, role_last string, turned array<string>"


def fold(text: str) -> str:
    """Lower case without accents; entities resolved; a digit inside a word is the letter it was scanned for."""
    plain = unicodedata.normalize("NFKD", html.unescape(text))
    plain = "".join(c for c in plain if not unicodedata.combining(c))
    plain = re.sub(r"(?<=[^\W\d_])1|1(?=[^\W\d_])", "l", plain)
    return re.sub(r"(?<=[^\W\d_])0|0(?=[^\W\d_])", "o", plain)


def parse_name(name: str) -> dict | None:
    """Parts of a name: an organisation's words, or surname, first and second given name, and whether the first is short.

    ``turned`` holds the parts read the other way round (surname first), for names that do not tell.
    """
    text = re.sub(r"\s+", " ", fold(name)).strip()
    bare = " ".join(re.findall(r"\w+", text.casefold()))
    if not re.search(r"[^\W\d_]", bare) or bare in COLLECTIVE:
        return None
    words = [_EXPAND.get(w, w) for w in bare.split()]
    if sum(w in ORGANISATION for w in words) and len(words) > 1:
        key = " ".join(sorted(w for w in words if w not in _FILLER and not w.isdigit()))
        return {"kind": "organisation", "surname": key}
    text = re.sub(r"^(?:by|von|par|de)\s+(?=\S+\s)", "", text, flags=re.I) if text.lower().startswith("by ") else text
    text = re.sub(r"^(?:(?:dr|prof|mr|mrs|ms|sir|rev|dame|lady|lord)\b\.?\s*)+", "", text, flags=re.I)
    text = re.sub(r"(?:,\s*|\s*\()(?:author|editor|ed|eds|illustrator|translator|narrator|foreword|introduction)\b\.?\)?\s*$", "", text, flags=re.I)
    text = re.sub(r",?\s*\(?\b(?:b\.|d\.|ca?\.)?\s*\d{3,4}\s*(?:-\s*(?:\d{2,4})?)?\)?\s*$", "", text)
    text = re.sub(r",?\s*\(?\b\d+\s*(?:B\.?C\.?(?:E\.?)?)\b[^,]*$", "", text)
    inner = re.search(r"\(([^)]*)\)", text)
    outer = re.sub(r"\([^)]*\)|\"[^\"]*\"|“[^”]*”|'[^' ]{2,}'(?=\s)", " ", text)
    if outer.count(",") >= 1:
        before, after = (p.strip() for p in outer.split(",", 1))
        given = inner[1] if inner and re.fullmatch(r"(?:\w\.?\s*)+", after) and len(inner[1].split()) >= len(re.findall(r"\w+", after)) > 0 else after
        return _person(_tokens(before), _tokens(given), told=True)
    tokens = _tokens(outer)
    if not tokens:
        return None
    if len(tokens) == 1:
        return {"kind": "single", "surname": tokens[0][0]}
    # Capitals or single letters at the end are the given names' initials: the surname stands first.
    last = tokens[-1][0]
    run = re.findall(r"\w+", outer)[-1]
    if len(tokens[0][0]) > 2 and (len(last) == 1 or len(run) <= 3 and run.isupper()):
        rest = tokens[1:] if len(last) == 1 else [*tokens[1:-1], *[(c, True) for c in last]]
        return _person([tokens[0]], rest, told=True)
    person = _person([tokens[-1]], tokens[:-1], told=False)
    if person:
        person["role_first"], person["role_last"] = tokens[0][0], tokens[-1][0]
        other = _person([tokens[0]], tokens[1:], told=False)
        person["turned"] = [other["surname"], other["first"], other["second"] or "", str(other["short"])] if other else None
    return person


def _tokens(text: str) -> list[tuple[str, bool]]:
    """(word in lower case, whether it is abbreviated)."""
    return [(w.casefold(), dot == "." or len(w) == 1) for w, dot in re.findall(r"([^\W\d_]+(?:['’-][^\W\d_]+)*)(\.?)", text)]


def _person(surname: list[tuple[str, bool]], given: list[tuple[str, bool]], told: bool) -> dict | None:
    if not surname or not given:
        word = " ".join(w for w, _ in [*surname, *given])
        return {"kind": "single", "surname": word} if word else None
    # A dot after the last of several given names ends the name, it shortens nothing.
    first, short = given[0]
    return {
        "kind": "person", "surname": " ".join(w for w, _ in surname), "first": first, "second": given[1][0] if len(given) > 1 else None,
        "short": bool(short and len(first) <= 4), "role_first": None if not told else given[0][0], "role_last": None if not told else surname[-1][0], "turned": None,
    }


def parse_names(names: DataFrame) -> DataFrame:
    """name, form: a struct of the parts; null where the name is nobody's."""

    @F.pandas_udf(_FORM)
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        columns = ["kind", "surname", "first", "second", "short", "role_first", "role_last", "turned"]
        for batch in batches:
            rows = [parse_name(n) or {} for n in batch]
            yield pd.DataFrame([{c: r.get(c) for c in columns} for r in rows], columns=columns)

    return names.select("name", parse.asNondeterministic()("name").alias("form")).where("form.kind is not null")


def segment_keys(text: Column, most: int, probe: bool) -> Column:
    """array<struct<length, segment, part>>: a text's own segments, or as ``probe`` the substrings that may equal a
    segment of a text up to ``most`` shorter, shifted by up to ``most`` places."""
    pieces = most + 1
    n = F.length(text)

    def parts(length: Column) -> Column:
        short, longer = F.floor(length / pieces), length % pieces

        def part(i: int) -> Column:
            # The last (length mod pieces) segments are one letter longer.
            size = (short + F.when(F.lit(i) >= pieces - longer, 1).otherwise(0)).cast("int")
            start = (short * i + F.greatest(F.lit(i) - (pieces - longer), F.lit(0))).cast("int")
            shifts = range(-most, most + 1) if probe else [0]
            made = [
                F.when(
                    (start + s >= 0) & (start + s + size <= n) & (size > 0),
                    F.struct(length.cast("int").alias("length"), F.lit(i).alias("segment"), F.substring(text, start + s + 1, size).alias("part")),
                )
                for s in shifts
            ]
            return F.array(*made)

        return F.array_compact(F.flatten(F.array(*[part(i) for i in range(pieces)])))

    lengths = [n - d for d in range(most + 1)] if probe else [n]
    return F.array_distinct(F.flatten(F.array(*[parts(length) for length in lengths])))


#: Texts of fewer letters are within one edit of each other or not near at all.
LONG = 8


def segment_join(texts: DataFrame, text: str, group: tuple[str, ...] = (), carry: tuple[str, ...] = (), long: int = LONG) -> DataFrame:
    """Pairs (group..., shorter, longer, distance) of different texts of one group within one edit or one swap of letters, or
    within two edits where the longer has ``long`` letters or more, each with the ``carry`` columns of both sides
    (shorter_x, longer_x); the rows of ``texts`` must be distinct.

    No such pair is missed: k edits leave one of k + 1 segments intact. Short texts are cut into two segments only, since
    thirds of them are single letters that half the vocabulary shares; a segment that many texts share is spread over tasks.
    """
    keep = list(group)
    n = F.length(text)

    def side(name: str, probe: bool) -> DataFrame:
        own = [F.col(c).alias(f"{name}_{c}") for c in carry]
        cuts = lambda most: F.transform(segment_keys(F.col(text), most, probe), lambda k: F.xxhash64(F.lit(most), k["length"], k["segment"], k["part"], *[F.col(g) for g in group]))
        none = F.array().cast("array<bigint>")
        # One edit: both below ``long``; two edits: the longer has ``long`` letters, so the shorter at least two fewer.
        letters = F.array_join(F.array_sort(F.split(F.col(text), "")), "")
        swapped = F.array(F.xxhash64(F.lit(0), letters, *[F.col(g) for g in group]))
        one = F.when(n < long, F.concat(cuts(1), swapped)).otherwise(none)
        two = F.when(n >= (long if probe else long - 2), cuts(2)).otherwise(none)
        return texts.select(*([] if probe else keep), F.col(text).alias(name), *own, *([F.col(g).alias(f"__{g}") for g in group] if probe else []), F.explode(F.concat(one, two)).alias("segment"))

    same = reduce(lambda a, g: a & F.col(g).eqNullSafe(F.col(f"__{g}")), group, F.lit(True))
    met = skew.salted_join(side("longer", True), side("shorter", False), ["segment"]).where(same & F.expr("shorter <> longer"))
    letters = lambda c: F.array_sort(F.split(F.col(c), ""))
    near = met.withColumn("distance", F.levenshtein("shorter", "longer", 2)).where(
        (F.col("distance") >= 0) & ((F.col("distance") <= 1) | (F.length("longer") >= long) | (letters("shorter") == letters("longer")))
    )
    return near.drop("segment", *[f"__{g}" for g in group]).distinct()


def towards_common(pairs: DataFrame, group: tuple[str, ...], more: Column) -> DataFrame:
    """``pairs`` as from -> to with the ``n`` (and ``families``) of both; ``more``: whether the shorter text is the goal."""
    carried = [c.removeprefix("shorter_") for c in pairs.columns if c.startswith("shorter_")]
    pick = lambda yes, no, name: F.when(more, F.col(yes)).otherwise(F.col(no)).alias(name)
    return pairs.select(
        *group, "distance", pick("longer", "shorter", "from"), pick("shorter", "longer", "to"),
        *[pick(f"longer_{c}", f"shorter_{c}", f"from_{c}") for c in carried], *[pick(f"shorter_{c}", f"longer_{c}", f"to_{c}") for c in carried],
    )


COMMONER = "shorter_n > longer_n or (shorter_n = longer_n and shorter < longer)"


def _oriented(forms: DataFrame) -> DataFrame:
    """name, kind, surname, first, second, short: names without a comma are turned round where the corpus uses their
    first word as a surname more than as a given name. Roles are learnt from the names that tell."""
    parsed = cut_lineage(forms)
    words = F.array(F.struct(F.col("form.role_first").alias("word"), F.lit(-1).alias("lean")), F.struct(F.col("form.role_last").alias("word"), F.lit(1).alias("lean")))
    told = parsed.where("form.kind = 'person'").select(F.explode(words).alias("w")).where("w.word is not null")
    family = told.groupBy(F.col("w.word").alias("word")).agg(F.sum("w.lean").alias("lean")).where("lean > 0").select("word", F.lit(True).alias("turn"))
    asked = parsed.join(family, (F.col("form.role_first") == F.col("word")) & F.col("form.turned").isNotNull(), "left")
    t, turn = F.col("form.turned"), F.coalesce("turn", F.lit(False))
    pick = lambda i, c: F.when(turn, F.nullif(t[i], F.lit(""))).otherwise(F.col(f"form.{c}")).alias(c)
    short = F.when(turn, t[3] == "True").otherwise(F.coalesce("form.short", F.lit(False)))
    return asked.select("name", F.col("form.kind").alias("kind"), pick(0, "surname"), pick(1, "first"), pick(2, "second"), short.alias("short"))


def _with_family(parsed: DataFrame) -> DataFrame:
    """``parsed`` with ``family``: rare surnames led to the common one within two edits (one for short ones)."""
    weights = cut_lineage(parsed.groupBy("kind", "surname").agg(F.count("*").alias("n")))
    pairs = towards_common(segment_join(weights, "surname", ("kind",), ("n",)), ("kind",), F.expr(COMMONER))
    likely = pairs.where("(from_n <= 2 or to_n >= 4 * from_n) and (length(`from`) >= 8 or distance <= 1) and length(`from`) >= 4")
    best = likely.groupBy("kind", F.col("from").alias("surname")).agg(F.min_by("to", F.struct((F.col("to_n") <= 2).alias("rare"), F.col("distance"), -F.col("to_n"), F.col("to"))).alias("family"))
    return parsed.join(best, ["kind", "surname"], "left").withColumn("family", F.coalesce("family", "surname"))


def _bearers(people: DataFrame) -> DataFrame:
    """family, first -> bearer: the full given name that a given name, misspelt or familiar, stands for."""
    full = people.where("not short and length(first) > 1").groupBy("family", "first").agg(F.count("*").alias("n"))
    full = cut_lineage(full)
    full = cut_lineage(full.join(full.groupBy("first").agg(F.count("*").alias("families")), "first"))
    goal = F.expr("shorter_n > longer_n or (shorter_n = longer_n and shorter_families > longer_families)")
    pairs = towards_common(segment_join(full, "first", ("family",), ("n", "families"), 6), ("family",), goal)
    misspelt = pairs.where(
        "(to_n > from_n or to_families > from_families) and from_families <= to_families and (from_families < 3 or from_families * 8 <= to_families)"
        " and (least(length(`from`), length(`to`)) >= 4 or distance <= 1)"
    )
    best = misspelt.groupBy("family", F.col("from").alias("first")).agg(F.min_by("to", F.struct((F.col("to_n") <= 1).alias("rare"), F.col("distance"), F.col("to"))).alias("bearer"))
    fixed = cut_lineage(full.join(best, ["family", "first"], "left").select("family", "first", F.coalesce("bearer", "first").alias("bearer")))
    table = F.create_map(*[F.lit(x) for pair in NICKNAMES.items() for x in pair])
    asked = fixed.select("family", "first", F.explode(F.split(F.try_element_at(table, F.col("first")), " ")).alias("formal"))
    held = fixed.select("family", F.col("bearer").alias("formal")).distinct()
    familiar = asked.join(held, ["family", "formal"]).groupBy("family", "first").agg(F.count("*").alias("fits"), F.min("formal").alias("formal")).where("fits = 1")
    return fixed.join(familiar.drop("fits"), ["family", "first"], "left").select("family", "first", F.coalesce("formal", "bearer").alias("bearer"))


def name_entities(names: DataFrame) -> DataFrame:
    """name, entity: each distinct spelling and the key of the person or organisation it names."""
    spellings = names.select("name").where("name is not null").distinct()
    parsed = cut_lineage(_oriented(parse_names(spellings)))
    # Organisations and single words: the whole key is a surname without given names.
    placed = cut_lineage(_with_family(parsed))
    others = placed.where("kind <> 'person'").select("name", F.concat_ws("|", "kind", "family").alias("entity"))

    people = placed.where("kind = 'person'").select("name", "family", "first", "second", "short")
    named = F.col("short") | (F.length("first") <= 1)
    full = cut_lineage(people.where(~named).join(_bearers(people), ["family", "first"]).select("name", "family", "bearer", "second"))
    # Who bears the surname: given names and the initials of second names seen with them.
    seconds = full.groupBy("family", "bearer").agg(F.collect_set(F.substring("second", 1, 1)).alias("initials"))
    wanted = people.where(named).select("name", "family", "first", "second").withColumn("initial", F.substring("first", 1, 1))
    fits = wanted.join(seconds.withColumn("initial", F.substring("bearer", 1, 1)), ["family", "initial"], "left").withColumn(
        "fits", F.coalesce(F.col("bearer").startswith(F.col("first")), F.lit(False))
    )
    agrees = F.col("fits") & (F.col("second").isNull() | F.array_contains("initials", F.substring("second", 1, 1)))
    open_to = F.col("fits") & (agrees | (F.size("initials") == 0))
    ranked = fits.groupBy("name", "family", "first", "second").agg(
        F.count_if(agrees).alias("sure"), F.count_if(open_to).alias("all"), F.min(F.when(agrees, F.col("bearer"))).alias("a"), F.min(F.when(open_to, F.col("bearer"))).alias("b")
    )
    led = F.when(F.col("sure") == 1, F.col("a")).when((F.col("sure") == 0) & (F.col("all") == 1), F.col("b"))
    nobody = F.concat(F.col("first"), F.lit("."), F.coalesce("second", F.lit("")))
    everyone = full.unionByName(ranked.select("name", "family", F.coalesce(led, nobody).alias("bearer"), "second"))
    # Second names that contradict each other tell persons apart; then a name without one is neither's.
    everyone = cut_lineage(everyone)
    several = everyone.groupBy("family", "bearer").agg(F.min(F.substring("second", 1, 1)).alias("a"), F.max(F.substring("second", 1, 1)).alias("b")).where("a <> b")
    told = everyone.join(several.select("family", "bearer", F.lit(True).alias("several")), ["family", "bearer"], "left")
    apart = F.when(F.col("several"), F.coalesce(F.substring("second", 1, 1), F.lit("?")))
    person = told.select("name", F.concat_ws("|", F.lit("person"), "family", "bearer", apart).alias("entity"))
    return person.unionByName(others)


def name_pairs(names: DataFrame) -> DataFrame:
    """name_a < name_b by code points: each pair of different spellings of one person or organisation.

    The pairs are what is asked for; ``name_entities`` says the same in one row per spelling.
    """
    entities = cut_lineage(name_entities(names))
    a, b = entities.toDF("name_a", "entity"), entities.toDF("name_b", "entity")
    return skew.salted_join(a, b, ["entity"]).where("name_a < name_b").select("name_a", "name_b")


def spellings(columns: list[DataFrame]) -> DataFrame:
    """One column ``name`` of several one-column frames."""
    return reduce(DataFrame.union, [c.toDF("name") for c in columns])
