"""Keys and hashes that make a record recognisable, languages, and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions import text

#: ISO 639-1 codes with their three-letter codes (fixed values).
TWO_LETTER = (
    "aa aar ab abk ae ave af afr ak aka am amh an arg ar ara as asm av ava ay aym az aze ba bak be bel bg bul bi bis bm bam bn ben bo bod br bre bs bos ca cat ce che ch cha "
    "co cos cr cre cs ces cu chu cv chv cy cym da dan de deu dv div dz dzo ee ewe el ell en eng eo epo es spa et est eu eus fa fas ff ful fi fin fj fij fo fao fr fra fy fry "
    "ga gle gd gla gl glg gn grn gu guj gv glv ha hau he heb hi hin ho hmo hr hrv ht hat hu hun hy hye hz her ia ina id ind ie ile ig ibo ii iii ik ipk io ido is isl it ita "
    "iu iku ja jpn jv jav ka kat kg kon ki kik kj kua kk kaz kl kal km khm kn kan ko kor kr kau ks kas ku kur kv kom kw cor ky kir la lat lb ltz lg lug li lim ln lin lo lao "
    "lt lit lu lub lv lav mg mlg mh mah mi mri mk mkd ml mal mn mon mr mar ms msa mt mlt my mya na nau nb nob nd nde ne nep ng ndo nl nld nn nno no nor nr nbl nv nav ny nya "
    "oc oci oj oji om orm or ori os oss pa pan pi pli pl pol ps pus pt por qu que rm roh rn run ro ron ru rus rw kin sa san sc srd sd snd se sme sg sag sh hbs si sin sk slk "
    "sl slv sm smo sn sna so som sq sqi sr srp ss ssw st sot su sun sv swe sw swa ta tam te tel tg tgk th tha ti tir tk tuk tl tgl tn tsn to ton tr tur ts tso tt tat tw twi "
    "ty tah ug uig uk ukr ur urd uz uzb ve ven vi vie vo vol wa wln wo wol xh xho yi yid yo yor za zha zh zho zu zul"
)
#: Bibliographic codes with their terminological codes (fixed values).
BIBLIOGRAPHIC = (
    "alb sqi arm hye baq eus bur mya chi zho cze ces dut nld fre fra geo kat ger deu gre ell ice isl mac mkd mao mri may msa per fas rum ron slo slk tib bod wel cym"
)
#: Languages of books that have a three-letter code only (fixed values); codes beyond these come as a parameter.
THREE_LETTER = (
    "akk ang arc arn ast ban bas ceb chr cop crh dsb dum egy enm fil frm fro fur gmh goh got grc gsw haw hmn hsb ilo kab kha lad mai mni mul nah nap nds new non oji pau peo "
    "pro rom rup sah sco scn syr tet tpi tvl udm uga und war xal yap zap zxx zza"
)


def _pairs(table: str) -> list[tuple[str, str]]:
    words = table.split()
    return list(zip(words[::2], words[1::2]))


def language(column: Column, more: Sequence[str] = ()) -> Column:
    """Three-letter terminological code of a two- or three-letter code in any case, else null; ``more``: further three-letter
    codes that stand for themselves (of the 7,900 of ISO 639-3, those of ISO 639-1 and the commonest others are built in)."""
    known = dict(_pairs(BIBLIOGRAPHIC)) | dict(_pairs(TWO_LETTER))
    known |= {c: c for c in (*(three for _, three in _pairs(TWO_LETTER)), *THREE_LETTER.split(), *more)}
    # One text and one search in it: a map is read from its start for each lookup.
    table = F.lit("".join(f" {code}:{target}" for code, target in sorted(known.items())))
    code = F.lower(F.trim(column))
    at = F.position(F.concat(F.lit(" "), code, F.lit(":")), table)
    return F.when(code.rlike(r"^[a-z]{2,3}$") & (at > 0), F.substring(table, at + F.length(code) + 2, F.lit(3)))


def select_language(codes: Column) -> Column:
    """The one language of an array; null where there is none or more than one."""
    known = F.array_distinct(F.array_compact(F.transform(F.coalesce(codes, F.array().cast("array<string>")), lambda c: language(c))))
    return F.when(F.size(known) == 1, known[0])


def _hash(*parts: Column) -> Column:
    # concat_ws skips nulls, which would let fields slide into each other.
    return F.sha2(F.concat_ws("\0", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def fallback_key(title: Column, author: Column, year: Column) -> Column:
    """``fallback:`` and the hash of title, author and year; null without a title."""
    return F.when(F.length(title) > 0, F.concat(F.lit("fallback:"), _hash(title, author, year)))


def identity_key(isbn13: Column, title: Column, author: Column, year: Column) -> Column:
    return F.coalesce(F.concat(F.lit("isbn:"), isbn13), fallback_key(title, author, year))


def payload_hash(payload: Column) -> Column:
    """Hash of JSON text that key order and white space do not change; null for text that is no JSON."""
    return F.sha2(F.to_json(F.try_parse_json(payload)), 256)


def content_hash(*fields: tuple[str, Column]) -> Column:
    """Hash of named values without nulls, in order of their names."""
    return F.sha2(F.to_json(F.struct(*[c.alias(n) for n, c in sorted(fields, key=lambda f: f[0])])), 256)


def series_form(name: Column) -> Column:
    return text.title_form(text.unescaped(name))


def series_key(source: Column, source_series_id: Column, name: Column, confirmed: Column) -> Column:
    own = F.when(confirmed & (F.length(source_series_id) > 0), F.concat_ws(":", F.lit("srcseries"), source, source_series_id))
    return F.coalesce(own, F.concat(F.lit("series:"), F.sha2(series_form(name), 256)))
