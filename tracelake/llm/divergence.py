"""How far the sources of each language use its vocabulary differently.

Two passes over the texts. The first counts in how many documents each term is, exactly, and keeps the terms with enough of
them. The second finds the kept terms in the texts by one Aho-Corasick automaton for each language, over text in which all
that is no term is a blank, each term with a blank on either side. What it finds are sparse postings (language, source, term,
occurrences); shares, differences of pairs of sources and the terms that a source leans to all follow from these.
"""

from __future__ import annotations

import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow, ship
from tracelake.llm.common import cut, joined, pieces

#: A language keeps the terms of so many of its documents; of the terms that a source leans to so many ranks are returned.
LEAST_DOCUMENTS, TOP = 30, 50
#: What is added to each count, and the sum of all shares of a group.
ADDED, UNITS = 5, 1_000_000_000
#: The automata hold the most frequent kept terms: at most so many, of so many characters each and in total. The rest of the
#: kept terms is counted by a join, so these bounds decide about the way only.
AUTOMATON_TERMS, AUTOMATON_LENGTH, AUTOMATON_CHARS = 200_000, 64, 3_000_000
#: A task holds about so many counts before it hands them on.
HELD = 400_000
#: Differences are summed over about so many terms and this many sources (on either side) in one place.
TERMS_TOGETHER, SOURCES_TOGETHER = 2048, 128

# Letters A-Z become small, all other ASCII that is no letter becomes a blank.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[:128] = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)]


def _rows(piece: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """Each row's index and its text with a blank for all that is no term, and one at its end."""
    data, at = joined(piece.column("text"))
    flat = _LETTERS[data].tobytes()
    for i in range(piece.num_rows):
        yield i, flat[at[i] : at[i + 1]]


class _Counts:
    """Counts by group and term, handed on as a batch when there are HELD of them."""

    def __init__(self, names: list[str]) -> None:
        self.names, self.of, self.seen = names, defaultdict(Counter), 0

    def add(self, group: tuple, terms) -> None:
        mine = self.of[group]
        before = len(mine)
        mine.update(terms)
        self.seen += len(mine) - before

    def batches(self, always: bool = False) -> Iterator[pa.RecordBatch]:
        if self.seen >= HELD or always and self.seen:
            rows = [(*group, term, n) for group, counts in self.of.items() for term, n in counts.items()]
            columns = list(zip(*rows))
            kinds = [pa.string()] * (len(columns) - 1) + [pa.int64()]
            terms = [x.decode() if isinstance(x, bytes) else x for x in columns[-2]]
            self.of, self.seen = defaultdict(Counter), 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip([*columns[:-2], terms, columns[-1]], kinds)], self.names)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts(["lang", "term", "n"])
    for piece in pieces(batches):
        langs = piece.column("lang").to_pylist()
        for i, text in _rows(piece):
            counts.add((langs[i],), set(text.split()))
            yield from counts.batches()
    yield from counts.batches(True)


_built: dict[str, dict] = {}


def _automata(name: str, terms) -> dict:
    """By language, the automaton of its terms; built once in each Python worker."""
    if name not in _built:
        _built.clear()
        made = {}
        for lang, own in terms.value.items():
            made[lang] = automaton = ahocorasick.Automaton()
            for term in own:
                automaton.add_word(f" {term} ", term)
            automaton.make_automaton()
        _built[name] = made
    return _built[name]


def _occurrences(name: str, terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata, counts = _automata(name, terms), _Counts(["lang", "source", "term", "n"])
        for piece in pieces(batches):
            langs, sources = piece.column("lang").to_pylist(), piece.column("source").to_pylist()
            for i, text in _rows(piece):
                if langs[i] in automata:
                    found = automata[langs[i]].iter(" " + text.decode())
                    counts.add((langs[i], sources[i]), map(itemgetter(1), found))
                    yield from counts.batches()
        yield from counts.batches(True)

    return run


def _others(terms):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {lang: {t.encode() for t in own} for lang, own in terms.value.items()}
        counts = _Counts(["lang", "source", "term", "n"])
        for piece in pieces(batches):
            langs, sources = piece.column("lang").to_pylist(), piece.column("source").to_pylist()
            for i, text in _rows(piece):
                own = held.get(langs[i], ())
                counts.add((langs[i], sources[i]), [t for t in text.split() if t not in own])
                yield from counts.batches()
        yield from counts.batches(True)

    return run


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNITS * (count + ADDED) / (total + ADDED * terms)) in whole numbers; 0 where there are no terms."""
    exact = lambda c: c.cast("decimal(26,0)")
    top, bottom = exact(count + ADDED) * F.lit(UNITS).cast("decimal(10,0)"), exact(total + ADDED * terms)
    # Decimals are divided by `div`, which has no function of its own.
    return F.when(terms > 0, F.call_function("div", top, bottom) + 1).otherwise(F.lit(0)).cast("long")


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, n) of the terms that are in n documents of their language, `least` or more. docs: text, lang and source without nulls."""
    return map_arrow(docs.select("lang", "text"), _document_counts, "lang string, term string, n long").groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def postings(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, term, n): how often each kept term occurs in each group; groups without a term have no row for it."""
    spark = docs.sparkSession
    short = kept.where(F.length("term") <= AUTOMATON_LENGTH).orderBy(F.desc("n"), "lang", "term").limit(AUTOMATON_TERMS)
    held, chars, rows = defaultdict(list), 0, short.select("lang", "term").toArrow()  # bounded by AUTOMATON_TERMS and AUTOMATON_LENGTH
    for lang, term in zip(rows.column("lang").to_pylist(), rows.column("term").to_pylist()):
        chars += len(term) + 2
        if chars > AUTOMATON_CHARS:
            break
        held[lang].append(term)
    terms = spark.sparkContext.broadcast(dict(held))
    schema = "lang string, source string, term string, n long"
    found = map_arrow(docs.select("lang", "source", "text"), _occurrences(uuid.uuid4().hex, terms), schema)
    if kept.count() > sum(map(len, held.values())):
        rest = map_arrow(docs.select("lang", "source", "text"), _others(terms), schema)
        found = found.unionByName(rest.groupBy("lang", "source", "term").agg(F.sum("n").alias("n")).join(kept.select("lang", "term"), ["lang", "term"], "left_semi"))
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))


def _differences(together: int):
    """Of one block of terms and two of `together` sources: (lang, i, j, value, terms), the sum of the pair's differences over the block's terms."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        lang, _, left, right = (k.as_py() for k in key)
        place, share, term = (rows.column(c).to_numpy() for c in ("place", "share", "code"))
        level = np.asarray(rows.column("level"))
        places, first = np.unique(place[level], return_index=True)
        _, row = np.unique(term[~level], return_inverse=True)
        n = int(row.max()) + 1 if len(row) else 0
        # Sources without a term have the share of no occurrence.
        table = np.tile(share[level][first], (n, 1))
        table[row, np.searchsorted(places, place[~level])] = share[~level]
        side, out = places // together, []
        for i in np.flatnonzero(side == left):
            j = np.flatnonzero((side == right) & (places > places[i]))
            out.append((np.full(len(j), places[i]), places[j], np.abs(table[:, j] - table[:, i : i + 1]).sum(axis=0)))
        i, j, value = (np.concatenate(x) for x in zip(*out))
        return pa.table({"lang": pa.array([lang] * len(i), pa.string()), "i": i, "j": j, "value": value, "terms": np.full(len(i), n)})

    return run


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source) of docs (text, lang, source; others count for nothing).

    A null text, lang or source is empty. Shares are those of _share: of a group p, of its language q. Part `pair` has every
    other source of the language as item, and as value the sum of |p - p of the other| over all kept terms, 0 if there are
    none. Part `term` has the terms that the group has and uses more than the language (p > q), by p - q, up to rank `top`.
    Ranks begin at 1, by value descending, then by item. Repeated rows are documents of their own; an empty table gives no
    rows. A language of one source has no pairs.

    The vocabulary that is broadcast is bounded (AUTOMATON_TERMS and the like); other kept terms are joined by shuffle. For
    pairs, blocks of terms and of sources meet as one table of numbers, so nothing is emitted for each pair and term.
    """
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(empty("lang"), empty("source"), empty("text"))
    kept = cut(kept_terms(docs, least))
    found = cut(postings(docs, kept))
    vocabulary = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = docs.select("lang", "source").distinct().join(vocabulary, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0)))
    groups = groups.join(found.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").withColumn("total", F.coalesce("total", F.lit(0)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = cut(groups.withColumns({"place": place.cast("long"), "level": _share(F.lit(0), F.col("total"), F.col("v")), "places": F.count("*").over(Window.partitionBy("lang"))}))
    shares = found.join(groups, ["lang", "source"]).select("lang", "source", "term", "n", "v", "places", "place", _share(F.col("n"), F.col("total"), F.col("v")).alias("share"))
    return _pairs(shares, groups).unionByName(_leanings(shares, found, top))


def _pairs(shares: DataFrame, groups: DataFrame) -> DataFrame:
    blocks = F.ceil(F.greatest(F.col("v"), F.lit(1)) / TERMS_TOGETHER)
    own = F.floor(F.col("place") / SOURCES_TOGETHER)
    sides = F.sequence(F.lit(0).cast("long"), F.floor((F.col("places") - 1) / SOURCES_TOGETHER))
    met = lambda rows, block, level, code, share: rows.select(
        "lang", block.alias("block"), own.alias("own"), F.explode(sides).alias("other"), "place", F.lit(level).alias("level"), code.alias("code"), share.alias("share")
    )
    given = met(shares, F.pmod(F.xxhash64("term"), blocks), False, F.xxhash64("term"), F.col("share"))
    # The share of no occurrence, once for each block of terms, which stands for the terms that a source lacks.
    every = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    level = met(every, F.col("block"), True, F.lit(0).cast("long"), F.col("level"))
    rows = given.unionByName(level).withColumns({"left": F.least("own", "other"), "right": F.greatest("own", "other")})
    ship(shares.sparkSession)
    parts = rows.groupBy("lang", "block", "left", "right").applyInArrow(_differences(SOURCES_TOGETHER), "lang string, i long, j long, value long, terms long")
    sums = parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    end = lambda x: groups.select("lang", F.col("place").alias(x), F.col("source").alias(f"source_{x}"), F.col("level").alias(f"level_{x}"), *(["v"] if x == "i" else []))
    both = sums.join(end("i"), ["lang", "i"]).join(end("j"), ["lang", "j"])
    # Terms that neither block of sources has.
    both = both.withColumn("value", F.col("value") + (F.col("v") - F.col("terms")) * F.abs(F.col("level_i") - F.col("level_j")))
    ways = [both.select("lang", F.col(f"source_{a}").alias("source"), F.col(f"source_{b}").alias("item"), "value") for a, b in ("ij", "ji")]
    return _ranked(ways[0].unionByName(ways[1]), "pair")


def _leanings(shares: DataFrame, found: DataFrame, top: int) -> DataFrame:
    totals = found.groupBy("lang").agg(F.sum("n").alias("all"))
    language = found.groupBy("lang", "term").agg(F.sum("n").alias("m")).join(totals, "lang")
    both = shares.join(language, ["lang", "term"]).withColumn("value", F.col("share") - _share(F.col("m"), F.col("all"), F.col("v")))
    return _ranked(both.where("value > 0").select("lang", "source", F.col("term").alias("item"), "value"), "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return rows.withColumn("rank", rank).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
