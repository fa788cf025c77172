"""Freely typed values mapped to a canonical list.

The list, with the paths under which its entries are also written (aliases, singulars, scanning confusions), is a trie.
An entry is cut at its separators, its added forms, shelf words and inversions are undone, and each piece is searched
in the trie with a Levenshtein automaton: the automaton's states (a bit vector per number of edits, adjacent swaps counting
once) are carried down the trie, and a branch is left as soon as no state is within the distance that the piece's
length allows. The search returns all entries within that distance; the nearest is the piece's meaning.

The trie is read by every Python worker, so the list is bounded: more than ``MOST_TERMS`` entries are an error. Only
distinct texts pass the workers.

Defined results: null and blank entries, and entries of no list (null or empty lists), stand for nothing; a list's entry
is addressed by its position from 0; a record fetched again counts once; ties go to the smallest term id.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import thesaurus
from quire.operators import skew

MOST_TERMS = 100_000
#: Resolved spellings a worker remembers before it starts afresh.
REMEMBERED = 200_000

#: Words added to a subject as a form, which are words of subjects as well (fixed values).
FORMS = {"history", "fiction", "bibliography", "travel", "literature", "works"}
#: Groups of letters that scanning takes for others (fixed values); single letters are within the distance anyway.
CONFUSIONS = (("m", "rn"), ("rn", "m"), ("d", "cl"), ("cl", "d"), ("w", "vv"), ("h", "li"), ("li", "h"), ("in", "m"))


def comparable(text: str) -> str:
    """Lower case, no accents, words of letters and digits with one blank between; & is and."""
    folded = unicodedata.normalize("NFKD", text.replace("&amp;", "&"))
    folded = "".join(c for c in folded if not unicodedata.combining(c)).casefold().replace("&", " and ")
    folded = re.sub(r"(?<=\w)['’](?=\w)", "", folded)
    return " ".join(re.findall(r"[^\W_]+", folded))


def allowed_distance(length: int) -> int:
    return 0 if length < 4 else 1 if length < 8 else 2


def singulars(term: str) -> set[str]:
    """Paths with the last word, or each plural word, in the singular."""
    def one(word: str) -> str:
        if word.endswith("ies") and len(word) > 4:
            return word[:-3] + "y"
        if re.search(r"(?:ch|sh|x|ss|o)es$", word):
            return word[:-2]
        return word[:-1] if word.endswith("s") and not word.endswith("ss") and len(word) > 3 else word

    words = term.split()
    return {" ".join([*words[:-1], one(words[-1])]), " ".join(one(w) for w in words)} - {term}


class Trie:
    """Paths of a canonical list; a path ends in all terms that are written so, each with a penalty."""

    def __init__(self, terms: list[tuple[int, str]], aliases: Iterable[tuple[str, str]] = ()) -> None:
        self.root: dict = {}
        self.memo: dict[str, list[tuple[int, int]]] = {}
        by_form: dict[str, list[int]] = {}
        for term_id, term in sorted(terms):
            if comparable(term):
                by_form.setdefault(comparable(term), []).append(term_id)
        words = {form: tuple(form.split()) for form in by_form}
        self.vocabulary = {w for term in words.values() for w in term} - FORMS
        self.paths: dict[str, list[tuple[int, int]]] = {}
        for form, ids in by_form.items():
            self.add(form, ids, 0)
        for alias, term in aliases:
            if comparable(term) in by_form and comparable(alias):
                self.add(comparable(alias), by_form[comparable(term)], 0)
        for form, ids in by_form.items():
            for path in singulars(form):
                self.add(path, ids, 0)
            for right, wrong in CONFUSIONS:
                for at in [m.start() for m in re.finditer(right, form)]:
                    self.add(form[:at] + wrong + form[at + len(right) :], ids, 1)
        # Terms by their number of words and how the first begins, for abbreviated names.
        self.short: dict[tuple[int, str], list[tuple[tuple[str, ...], list[int]]]] = {}
        written = {tuple(w for w in map(comparable, term.split()) if w): by_form[comparable(term)] for _, term in terms if comparable(term)}
        for term, ids in (written | {term: by_form[form] for form, term in words.items()}).items():
            for begin in {term[0][:3], term[0]}:
                self.short.setdefault((len(term), begin), []).append((term, ids))

    def add(self, path: str, ids: list[int], penalty: int) -> None:
        held = dict((t, p) for p, t in self.paths.get(path, []))
        for term in ids:
            held[term] = min(penalty, held.get(term, penalty))
        self.paths[path] = sorted((p, t) for t, p in held.items())
        node = self.root
        for letter in path:
            node = node.setdefault(letter, {})
        node[""] = (len(path), self.paths[path])

    def search(self, text: str) -> list[tuple[int, int]]:
        """All (distance, term) within the distance that the text's length allows, nearest first.

        The automaton's state is one bit vector per number of edits: bit j is set if the path so far can be made of the
        first j letters of the text with so many edits. A step costs a few operations on whole numbers.
        """
        if text in self.memo:
            return self.memo[text]
        limit, n = allowed_distance(len(text)), len(text)
        best: dict[int, int] = {t: p for p, t in self.paths.get(text, [])}
        if limit:
            whole, accept = (1 << n + 1) - 1, 1 << n
            places: dict[str, int] = {}
            for j, letter in enumerate(text):
                places[letter] = places.get(letter, 0) | 1 << j
            edits = range(1, limit + 1)
            start = [(1 << k + 1) - 1 & whole for k in range(limit + 1)]
            stack = [(self.root, 0, start, [0] * limit)]
            while stack:
                node, last, row, before = stack.pop()
                for letter, child in node.items():
                    if letter == "":
                        length, ends = child
                        most = min(limit, allowed_distance(length))
                        near = next((k for k in range(most + 1) if row[k] & accept), None)
                        if near is not None:
                            for penalty, term in ends:
                                if near + penalty <= limit and near + penalty < best.get(term, 9):
                                    best[term] = near + penalty
                        continue
                    at = places.get(letter, 0)
                    new = [(row[0] & at) << 1]
                    for k in edits:
                        # A match, a letter too many, another letter, a letter too few, two letters swapped.
                        fewer = row[k - 1]
                        new.append(((row[k] & at) << 1 | fewer | fewer << 1 | new[k - 1] << 1 | (before[k - 1] & at & last >> 1) << 2) & whole)
                    if new[limit]:
                        stack.append((child, at, new, row))
        if len(self.memo) >= REMEMBERED:
            self.memo.clear()
        self.memo[text] = sorted((d, t) for t, d in best.items())
        return self.memo[text]

    def abbreviated(self, words: list[str]) -> set[int]:
        """Terms whose words begin, one by one, with the given words (three letters at least, or the whole word)."""
        fits = lambda short, word: word == short or len(short) >= 3 and word.startswith(short)
        if len(words) < 2:
            return set()
        found = self.short.get((len(words), words[0][:3]), []) if len(words[0]) >= 3 else self.short.get((len(words), words[0]), [])
        return {i for term, ids in found if all(map(fits, words, term)) for i in ids}


_SHELF = re.compile(r"^(?:subject|topic|keyword)s?\s*:\s*", re.I)
_LEADING = re.compile(r"^(?:works? on|books? (?:about|on)|on|about|studies in|the)\s+", re.I)
_TRAILING = re.compile(r"\s+(?:books?|works)$", re.I)
_STRONG = re.compile(r"\s*[;|]\s*|\s+[+/]\s+|\s+[-–—]+\s+|\s*--+\s*|\s*—\s*")


def resolve(trie: Trie, entry: str) -> list[int]:
    """Terms an entry stands for, in the order they are named."""
    found: list[int] = []

    def near(text: str, within: int = 2) -> int | None:
        form = comparable(text)
        if form in trie.paths:
            return trie.paths[form][0][1]
        hits = trie.search(form) if form else []
        return hits[0][1] if hits and hits[0][0] <= within else None

    def name(piece: str, within: int = 2) -> int | None:
        piece = re.sub(r"\s*\([^)]*\)\s*", " ", _SHELF.sub("", piece)).strip()
        forms = [piece, _LEADING.sub("", piece), _TRAILING.sub("", piece), _TRAILING.sub("", _LEADING.sub("", piece))]
        for form in dict.fromkeys(forms):
            hit = near(form, within)
            if hit is not None:
                return hit
        if "." in piece:
            hits = trie.abbreviated([w for w in map(comparable, piece.split()) if w])
            if len(hits) == 1:
                return next(iter(hits))
        return None

    whole = near(entry) if "--" in entry else None
    if whole is not None:
        return [whole]
    for piece in _STRONG.split(entry.strip()):
        hit = name(piece)
        if hit is None and "," in piece:
            head, _, tail = piece.partition(",")
            hit = name(f"{tail} {head}")
            # "Fairs, science" turns a name around; only added forms and places leave the first part as it stands, and whole
            # listed terms are each named by themselves.
            sides = piece.split(",")
            listed = all(trie.paths.get(comparable(p), [(9, 0)])[0][0] == 0 for p in sides)
            turned = hit is not None or comparable(tail) in trie.vocabulary and not listed
            parts = [hit] if turned else [name(p, 1) for p in sides]
        else:
            parts = [hit]
        found += [p for p in parts if p is not None and p not in found]
    return found


def resolve_batches(batches: Iterator[pd.DataFrame], terms: list[tuple[int, str]], aliases: list[tuple[str, str]]) -> Iterator[pd.DataFrame]:
    trie = Trie(terms, aliases)
    for frame in batches:
        frame["term_ids"] = [resolve(trie, text) for text in frame["entry"]]
        yield frame


def entries_of(records: DataFrame, source: str, record_id: str, values: str) -> DataFrame:
    """source, record_id, entry_no, entry: one row per typed entry that is not null."""
    listed = records.select(F.lit(source).alias("source"), F.col(record_id).cast("string").alias("record_id"), F.posexplode(F.col(values)).alias("entry_no", "entry"))
    return listed.where("entry is not null")


def _bounded(table: DataFrame, first: str, second: str, what: str) -> list[tuple]:
    rows = table.where(F.col(first).isNotNull() & F.col(second).isNotNull()).select(first, second).limit(MOST_TERMS + 1).collect()
    if len(rows) > MOST_TERMS:
        raise ValueError(f"{what} of more than {MOST_TERMS} entries")
    return [tuple(r) for r in rows]


def map_entries(entries: DataFrame, terms: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """``entries`` with ``term_ids``: the listed terms each entry stands for, empty if it stands for none.

    ``aliases`` (alias, term) are other names of listed terms; without it those of ``thesaurus`` are used. Each distinct text
    is resolved once, and the result joins the entries; a text that many entries share is spread over tasks.
    """
    listed = _bounded(terms, "term_id", "term", "a canonical list")
    names = thesaurus.ALIASES if aliases is None else _bounded(aliases, "alias", "term", "a list of aliases")
    columns = entries.select("source", "record_id", "entry_no", "entry").where("entry is not null")
    texts = columns.select("entry").distinct()
    resolved = texts.mapInPandas(partial(resolve_batches, terms=listed, aliases=names), "entry string, term_ids array<bigint>")
    return skew.salted_join(resolved, columns, ["entry"]).select("source", "record_id", "entry_no", "entry", "term_ids")


def canonical_terms(entries: DataFrame, terms: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """source, record_id, entry_no, term_id: once per entry and term, however often the record was fetched."""
    return map_entries(entries, terms, aliases).select("source", "record_id", "entry_no", F.explode("term_ids").alias("term_id")).distinct()


def unmatched(entries: DataFrame, terms: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """entry, n: entries that stand for no listed term, and in how many records each occurs."""
    none = map_entries(entries, terms, aliases).where(F.size("term_ids") == 0)
    return none.select("entry", "source", "record_id").distinct().groupBy("entry").agg(F.count("*").alias("n"))
