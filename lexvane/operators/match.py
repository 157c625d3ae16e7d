"""Which texts contain any term of a dictionary.

A term matches as a substring, also inside words; ``whole_word`` asks for
blanks (or the ends of the text) around it. Three plans give the same answer:

``scan``
    Existence test of every term on every text against a broadcast dictionary.
    No shuffle, one pass, works on streams. Terms of several words are met by
    the words inside them first and compared only with texts that have these;
    shorter terms are compared with every text, so it is for small
    dictionaries only.
``indexed``
    Every term is filed under an *anchor*, a piece of one of its words. All
    dictionaries asked for share one broadcast index. Texts are split once to
    count their words: those that occur often look up all kinds of anchors once
    for all texts. Then every text is split again; a known word asks for what it
    was found to need, others look up their anchors where they stand. A phrase
    is asked for by its anchor and a piece of the word beside it, and only the
    few candidates are compared. Flags are gathered by row, so only flags and
    numbers leave the stage.
``shuffled``
    For dictionaries beyond the broadcast bound. Texts are split once, and a
    table of the words and how often they occur (its size is that of the
    vocabulary) says how often each possible anchor occurs. A term of which some
    piece occurs nowhere is left out; any other is filed under its anchor that
    the texts hold least often. Only words with an anchor become windows, and a
    word goes to as many tasks as its own measured number of occurrences asks
    for.

``auto`` measures the dictionary first and picks one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lexvane.functions.text import NON_WORD, clean_text, fill_text
from lexvane.operators.dictionary import minimal_terms, usable_terms
from lexvane.storage import written

SCAN_TERMS = 128
BROADCAST_TERMS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
ANCHOR_LENGTH = 4
STRETCH = 12
# Words on either side that go along with a word; terms reaching further are met by joins.
REACH = 8
# Words that are split off a text together, besides those they reach.
WORDS_ALONG = 64
# Words met with the index once for all texts: how many at most, how often they occur at least, how long they are at most.
KNOWN_WORDS = 400_000
KNOWN_OFTEN = 4
KNOWN_LENGTH = 64
# Words with a term, for each dictionary, that decide a text before it is taken apart.
TELLING_WORDS = 256
# What the word in front of every text asks, and a word that holds a term: no hash of an anchor ends so.
KEEP, HIT = 0, 15
# Rows that the terms filed for the scan plan are dealt to.
SCAN_GROUPS = 16
# Occurrences of a word that one task takes in the shuffled plan.
TASK_ROWS = 1_000_000

PLANS = ("auto", "scan", "indexed", "shuffled")


def _size(terms: DataFrame) -> tuple[int, int]:
    row = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    return row[0], row[1]


def _plan_for(count: int, size: int) -> str:
    if count <= SCAN_TERMS and size <= BROADCAST_BYTES:
        return "scan"
    return "indexed" if count <= BROADCAST_TERMS and size <= BROADCAST_BYTES else "shuffled"


def choose_plan(terms: DataFrame) -> str:
    """Plan for a dictionary, by its measured size."""
    return _plan_for(*_size(terms))


@dataclass(frozen=True)
class TermSet:
    """A dictionary ``terms(term)`` to look for in ``text_col``, and the flag it gives.

    ``clean``: the text is matched as its lower-case words joined by blanks
    (it may have that form already); else as it is.
    """

    flag: str
    terms: DataFrame
    text_col: str
    whole_word: bool = False
    clean: bool = False
    plan: str = "auto"

    def __post_init__(self) -> None:
        if self.plan not in PLANS:
            raise ValueError(f"plan must be one of {PLANS}")

    def text(self) -> Column:
        return clean_text(F.col(self.text_col)) if self.clean else fill_text(F.col(self.text_col))

    def words(self) -> Column:
        """The words of the text, pieces between other characters; empty ones only for raw texts."""
        if not self.clean:
            return F.split(fill_text(F.col(self.text_col)), NON_WORD, -1)
        return F.array_remove(F.split(F.lower(fill_text(F.col(self.text_col))), NON_WORD, -1), "")

    def gaps(self) -> Column:
        """What is before the first word of a raw text, between its words and after the last; none if clean."""
        if self.clean:
            return F.array().cast("array<string>")
        end = F.array(F.lit(" " if self.whole_word else ""))
        return F.concat(end, F.regexp_extract_all(fill_text(F.col(self.text_col)), F.lit(NON_WORD), F.lit(0)), end)


def _holds(text: Column, term: Column, whole_word: bool) -> Column:
    if not whole_word:
        return F.contains(text, term)
    blank = F.lit(" ")
    return F.contains(F.concat(blank, text, blank), F.concat(blank, term, blank))


def _candidates(terms: DataFrame, whole_word: bool) -> DataFrame:
    """``term, one_word, anchor, before, after, at, size, weak``: all anchors a term could have.

    The words of a term are the pieces between its other characters. A piece
    bounded on both sides is a whole word in every text holding the term; its
    anchor is the word itself, marked by ``=``. The first piece of several ends
    a word of the text and the last one begins one; their anchors are up to
    ANCHOR_LENGTH characters, marked by ``<`` and ``>``. A lone piece may be
    anywhere in a word; its anchors are its runs of ANCHOR_LENGTH characters,
    without a mark. A term without word characters has one row, without an
    anchor. ``before`` and ``after`` are the pieces next to the anchored one,
    which is number ``at`` of ``size``.
    """
    p, k = F.col("p"), F.lit(ANCHOR_LENGTH)
    last, nothing = F.size(p) - 1, F.lit("")

    def offer(anchor: Column, before: Column, after: Column, at: Column, weak: Column, n: Column) -> Column:
        parts = {"anchor": anchor, "before": before, "after": after, "at": at.cast("int"), "weak": weak, "n": n}
        return F.struct(*(c.alias(name) for name, c in parts.items()))

    def piece(w: Column, i: Column) -> Column:
        inside = F.lit(True) if whole_word else (i > 0) & (i < last)
        anchor = (
            F.when(w == "", None)
            .when(inside, F.concat(F.lit("="), w))
            .when(i == 0, F.concat(F.lit("<"), F.right(w, k)))
            .otherwise(F.concat(F.lit(">"), F.left(w, k)))
        )
        near = (F.coalesce(F.get(p, i + d), nothing) for d in (-1, 1))
        return offer(anchor, *near, i, ~inside & (F.length(w) < ANCHOR_LENGTH), F.length(w))

    def run(i: Column) -> Column:
        part = F.substring(p[0], i, k)
        n = F.length(part)
        return offer(F.when(part != "", part), nothing, nothing, F.lit(0), n < ANCHOR_LENGTH, n)

    pieces = F.transform(p, piece)
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(p[0]) - (ANCHOR_LENGTH - 1), F.lit(1))), run)
    one_word = F.size(p) == 1
    offered = terms.select("term", F.split("term", NON_WORD, -1).alias("p")).withColumn(
        "c", pieces if whole_word else F.when(one_word, runs).otherwise(pieces)
    )
    rows = offered.select("term", one_word.alias("one_word"), F.size("p").alias("size"), F.inline("c"))
    bare = F.regexp_replace("term", NON_WORD, "") == ""
    return rows.filter(F.col("anchor").isNotNull() | bare)


def _best(offered: DataFrame, cost: str) -> DataFrame:
    """The cheapest anchor of every term; ``cost`` is a column."""
    order = F.struct("weak", cost, -F.col("n"), "anchor", "at")
    best = F.min_by(F.struct("one_word", "anchor", "before", "after", "at", "size", "weak"), order)
    return offered.groupBy("term").agg(best.alias("b")).select("term", "b.*")


def _sided(filed: DataFrame) -> DataFrame:
    """Add ``side``: what a word beside the anchored one has, for a second key.

    It is how the word before ends (``<``) or how the word after begins (``>``),
    in up to ANCHOR_LENGTH characters. The side that the fewest terms of the
    anchor share is taken, a longer one counting less; terms without words
    beside their anchor have an empty one. So an anchor common in texts, such as
    a word between others, does not bring all of its terms to each of its places.
    """
    k = F.lit(ANCHOR_LENGTH)
    offers = F.array(F.concat(F.lit("<"), F.right("before", k)), F.concat(F.lit(">"), F.left("after", k)))
    offers = F.filter(offers, lambda side: F.length(side) > 1)
    sides = F.when(F.size(offers) > 0, offers).otherwise(F.array(F.lit("")))
    offered = filed.withColumn("side", F.explode(sides))
    best = F.min_by(F.struct(*offered.columns), F.struct("_cost", "side"))
    shared = F.count("anchor").over(Window.partitionBy("anchor", "side"))
    offered = offered.withColumn("_cost", shared * F.pow(F.lit(8), ANCHOR_LENGTH + 1 - F.length("side")))
    return offered.groupBy(F.col("term").alias("_term")).agg(best.alias("b")).select("b.*")


def anchored_terms(terms: DataFrame, whole_word: bool = False) -> DataFrame:
    """Every term once, ``(term, one_word, anchor, before, after, at, size, weak, side)``.

    Of the anchors a term could have, the one shared by the fewest terms is
    taken, a short one counting more, so that words common to many terms do not
    gather them all.
    """
    shared = F.count("anchor").over(Window.partitionBy("anchor"))
    rarity = F.pow(F.lit(8), ANCHOR_LENGTH - F.least(F.col("n"), F.lit(ANCHOR_LENGTH)))
    return _sided(_best(_candidates(terms, whole_word).withColumn("shared", shared * rarity), "shared"))


# -- the shared index --------------------------------------------------------------

# What a kind of anchor is: its mark and its number of characters (0: whole words).
_KINDS = [("=", 0), *((m, n) for m in ("<", ">", "") for n in range(1, ANCHOR_LENGTH + 1))]


@dataclass(frozen=True)
class _Index:
    """Filed terms of one set, written; what there is of each kind; terms and their bytes.

    ``reach`` is how many words phrases go to either side of their anchor, up
    to REACH; ``far`` is the number of terms that go further.
    """

    rows: DataFrame
    kinds: dict[tuple[str, int], int]
    count: int
    size: int
    bare: tuple[int, int]
    reach: int = 0
    far: int = 0


def _reach() -> Column:
    """How many words a filed term goes to either side of its anchored one."""
    return F.when(F.col("anchor").isNull(), 0).otherwise(F.greatest(F.col("at"), F.col("size") - 1 - F.col("at")))


def _measured(filed: DataFrame, name: str) -> _Index:
    """Write the index; its measures are gathered on the way."""
    mark = F.when(F.left("anchor", F.lit(1)).isin("=", "<", ">"), F.left("anchor", F.lit(1))).otherwise("")
    chars = F.when(mark == "=", 0).otherwise(F.length("anchor") - F.length(mark))
    measures, seen = {}, Observation(f"index {name}")
    for i, (m, n) in enumerate(_KINDS):
        measures[f"k{i}"] = F.count_if((mark == m) & (chars == n))
    bare = F.col("anchor").isNull()
    measures |= {"n": F.count(F.lit(1)), "b": F.sum(F.octet_length("term"))}
    near = _reach() <= REACH
    measures |= {"reach": F.max(F.when(near, _reach())), "far": F.count_if(~near)}
    measures |= {"bare": F.count_if(bare), "bare_b": F.sum(F.when(bare, F.octet_length("term")))}
    rows = written(filed.observe(seen, *(c.alias(k) for k, c in measures.items())), "index")
    got = {k: v or 0 for k, v in seen.get.items()}
    kinds = {kind: got[f"k{i}"] for i, kind in enumerate(_KINDS) if got[f"k{i}"]}
    return _Index(rows, kinds, got["n"], got["b"], (got["bare"], got["bare_b"]), got["reach"], got["far"])


def _keys(kinds: Sequence[tuple[str, int]]) -> Column:
    """Array of the marked anchors of these kinds that ``_word`` can answer to."""
    word, keys = F.col("_word"), []
    for mark, n in kinds:
        if mark == "=":
            keys.append(F.concat(F.lit(mark), word))
        elif mark:
            piece = F.right(word, F.lit(n)) if mark == "<" else F.left(word, F.lit(n))
            keys.append(F.when(F.length(word) >= n, F.concat(F.lit(mark), piece)))
    return F.array(*keys)


def _with_keys(words: DataFrame, kinds: Sequence[tuple[str, int]], known: Column | None = None) -> DataFrame:
    """Add ``_key``: every anchor of these kinds that a word can answer to, one a row.

    For anchors anywhere in a word, words are cut into overlapping stretches
    first (one for most words), and a stretch into its places. Without lambdas
    all of this runs inside generated code. ``known`` is an array of keys to
    take instead, where it is not null.
    """
    marked = [k for k in kinds if k[0]]
    sizes = [n for m, n in kinds if not m]
    if known is not None:
        words = words.withColumn("_known", known)
    there = F.lit(False) if known is None else F.col("_known").isNotNull()

    def one_a_row(keyed: DataFrame, keys: Column) -> DataFrame:
        keys = keys if known is None else F.coalesce("_known", keys)
        return keyed.withColumn("_key", F.explode(keys)).drop("_start", "_stretch", "_place", "_known").filter(F.col("_key").isNotNull())

    if not sizes:
        return one_a_row(words, _keys(marked))
    once = F.array(F.lit(1))
    starts = F.sequence(F.lit(1), F.greatest(F.length("_word"), F.lit(1)), F.lit(STRETCH))
    cut = words.withColumn("_start", F.explode(F.when(there, once).otherwise(starts)))
    cut = cut.withColumn("_stretch", F.substring(F.col("_word"), F.col("_start"), F.lit(STRETCH + ANCHOR_LENGTH - 1)))
    places = F.sequence(F.lit(1), F.greatest(F.least(F.length("_stretch"), F.lit(STRETCH)), F.lit(1)))
    cut = cut.withColumn("_place", F.explode(F.when(there, once).otherwise(places)))
    # Runs cut short at the word's end are anchors of a shorter kind, or of none.
    runs = [F.substring(F.col("_stretch"), F.col("_place"), F.lit(n)) for n in sizes]
    keys = F.array(*(F.when(F.length(r) == n, r) for r, n in zip(runs, sizes)))
    if marked:
        keys = F.when((F.col("_start") == 1) & (F.col("_place") == 1), F.concat(keys, _keys(marked))).otherwise(keys)
    return one_a_row(cut, keys)


def _window_hit(one: TermSet, reach: int) -> Column:
    """Whether the joined index row's term is there, seen from ``_word`` and the words and gaps beside it."""
    term = F.col("term")
    before, after = (F.coalesce(_beside("_w", reach, d), F.lit("")) for d in (-1, 1))
    near = F.endswith(before, F.col("before")) & F.startswith(after, F.col("after"))
    if one.clean:  # words and single blanks are all there is
        first = F.col("_p") + (reach + 2) - F.col("at")
        window = F.array_join(F.slice(F.col("_w"), first, F.col("size")), " ")
        single = _holds(F.col("_word"), term, one.whole_word)
    else:
        around = [c for d in range(-reach, reach + 1) for c in (_beside("_w", reach, d), _beside("_g", reach, d))]
        every = F.array(_beside("_g", reach, -reach - 1), *around)
        window = F.array_join(F.slice(every, 2 * (reach - F.col("at")) + 1, 2 * F.col("size") + 1), "")
        single = F.contains("_word", term)
    if one.clean:
        held = _holds(window, term, one.whole_word)
    else:  # the gaps are part of the window, also the blanks around whole words
        held = F.contains(window, F.concat(F.lit(" "), term, F.lit(" ")) if one.whole_word else term)
    phrase = F.when(near, held)
    return F.coalesce(F.when(_lone(one), single).otherwise(phrase), F.lit(False))


def _lone(one: TermSet) -> Column:
    """Whether one word tells by itself if the filed term is there."""
    return F.col("one_word") & F.lit(one.clean or not one.whole_word)


def _beside(kind: str, reach: int, d: int) -> Column:
    """The word (``_w``) or the gap after it (``_g``) that is ``d`` words on."""
    return F.get(F.col(kind), F.col("_p") + (reach + 1 + d))


def _shifted(items: Column, d: int) -> Column:
    """The array with each item ``d`` places earlier (later, if negative), not longer than before."""
    if d >= 0:
        return F.slice(items, d + 1, F.size(items)) if d else items
    return F.slice(F.concat(F.array_repeat(F.lit(None).cast("string"), -d), items), F.lit(1), F.size(items))


def _weak(mark: str, n: int) -> bool:
    return mark != "=" and n < ANCHOR_LENGTH


def _scanned(rows: DataFrame, one: TermSet, index: _Index, out: str) -> tuple[DataFrame, _Index]:
    """Add a flag of the terms that are better compared one by one; the index without them.

    These are terms without word characters, and terms whose anchors are short
    (these occur in most texts and file too much) while there are few of them.
    """
    short = {k: n for k, n in index.kinds.items() if _weak(*k)}
    few = 0 < sum(short.values()) <= SCAN_TERMS
    parts: list[DataFrame] = []
    if few:
        parts.append(index.rows.filter("anchor is not null and weak"))
    n, size = index.bare
    groups = max(-(-n // BROADCAST_TERMS), -(-size // BROADCAST_BYTES))
    for g in range(groups):  # one pass for each group of terms that may be sent along
        parts.append(index.rows.filter(F.col("anchor").isNull() & (F.pmod(F.xxhash64("term"), F.lit(groups)) == g)))
    flags = []
    rows = rows.withColumn("_scan_text", one.text()) if parts else rows
    for i, part in enumerate(parts):
        flags.append(f"{out}_{i}")
        rows = _tested_in_place(rows, part, "_scan_text", flags[-1], one.whole_word)
    flag = reduce(lambda a, b: F.greatest(a, b), map(F.col, flags)) if flags else F.lit(0)
    rows = rows.withColumn(out, flag).drop("_scan_text", *flags)
    kept = {k: v for k, v in index.kinds.items() if not (few and _weak(*k))}
    left = index.rows.filter(F.col("anchor").isNotNull() & (_reach() <= REACH) & ~(F.lit(few) & F.col("weak")))
    return rows, _Index(left, kept, index.count, index.size, (0, 0), index.reach)


def _text_words(sets: Sequence[TermSet]) -> Column:
    """Rows of the number of a set and the words of a text as the set sees them.

    The outer form spares a test of the array that would split the text twice.
    """
    return F.inline_outer(F.array(*(F.struct(F.lit(i).alias("_set"), s.words().alias("_w")) for i, s in enumerate(sets))))


def _all_rows(sets: list[TermSet], indexes: list[_Index]) -> DataFrame:
    """The filed terms of all sets, with the number ``_of`` of the set and what to ask for them.

    ``_ask`` is a hash of set and anchor that tells in its last four bits how
    many characters of the word after (5 and more) or before (5 and less) are
    the term's side. Equal hashes do no harm: what is met is compared.
    """
    chars = F.length("side") - 1
    beside = F.when(F.col("side") == "", 0).when(F.startswith("side", F.lit("<")), -chars).otherwise(chars)
    ask = F.xxhash64("_of", "anchor").bitwiseAND(F.lit(-16)).bitwiseOR((beside + 5).cast("bigint"))
    parts = [index.rows.withColumns({"_of": F.lit(i), "_lone": _lone(s)}) for i, (s, index) in enumerate(zip(sets, indexes))]
    return reduce(DataFrame.unionByName, parts).withColumn("_ask", ask)


def _known_words(docs: DataFrame, sets: list[TermSet], filed: DataFrame, kinds: Sequence[tuple[str, int]]) -> DataFrame:
    """``(_of, _known_word, _asks, _n)``: what the words that texts hold most often look up.

    All words of all texts are counted; those that occur often, at most
    KNOWN_WORDS, meet the filed terms once here. ``_asks`` is what such a word
    has to ask for phrases, or just HIT if it holds a lone term. Which words are
    known changes no answer: others look up all their anchors where they stand.
    """
    words = docs.select(_text_words(sets)).select("_set", F.explode("_w").alias("_word"))
    words = words.filter((F.col("_word") != "") & (F.length("_word") <= KNOWN_LENGTH))
    counted = words.groupBy("_set", "_word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= KNOWN_OFTEN)
    counted = written(counted.withColumn("often", F.floor(4 * F.log2("n")).cast("int")), "vocabulary")
    sizes = dict(counted.groupBy("often").agg(F.count(F.lit(1))).collect())  # at most 256 rows
    least, room = 0, KNOWN_WORDS
    for often in sorted(sizes, reverse=True):
        room -= sizes[often]
        if room < 0:
            least = often + 1
            break
    words = counted.filter(F.col("often") >= least).select("_set", "_word", "n")
    met = _with_keys(words, kinds).join(F.broadcast(filed), (F.col("_key") == F.col("anchor")) & (F.col("_set") == F.col("_of")))
    holds = reduce(lambda x, y: x | y, ((F.col("_set") == i) & _holds(F.col("_word"), F.col("term"), s.whole_word) for i, s in enumerate(sets)))
    hit, asks = F.max(F.col("_lone") & holds), F.collect_set(F.when(~F.col("_lone"), F.col("_ask")))
    met = met.groupBy("_set", "_word").agg(F.when(hit, F.array(F.lit(HIT).cast("bigint"))).otherwise(asks).alias("_asks"))
    known = words.join(met, ["_set", "_word"], "left")
    asks = F.coalesce("_asks", F.array().cast("array<bigint>"))
    known = known.select(F.col("_set").alias("_of"), F.col("_word").alias("_known_word"), asks.alias("_asks"), F.col("n").alias("_n"))
    return written(known, "known")


def _telling_words(known: DataFrame, count: int) -> list[list[str]]:
    """For each set, the TELLING_WORDS known words with a lone term that occur most often."""
    telling = known.filter(F.array_contains("_asks", F.lit(HIT).cast("bigint")))
    lists = []
    for i in range(count):
        rows = telling.filter(F.col("_of") == i).orderBy(F.desc("_n"), "_known_word").limit(TELLING_WORDS).collect()
        lists.append([r["_known_word"] for r in rows])
    return lists


def _any_of(words: Column, wanted: list[str]) -> Column:
    return F.exists(words, lambda word: word.isin(wanted))


def _looked_up(
    rows: DataFrame, sets: list[TermSet], indexes: list[_Index], keep: list[str], carry: dict[str, Column], docs: DataFrame | None
) -> DataFrame:
    """All sets' flags of every row, in one pass over the texts.

    ``rows`` has a key ``_row`` and a column ``_scan{i}`` for each set. ``carry``
    is computed before texts are split. Words come from pieces of WORDS_ALONG
    words and the few beside them that the phrases reach, never from a whole
    text: a text of many words would be copied once for each of them. An empty
    word in front of every text finds a mark in the index, so that rows without
    a hit are kept. ``docs``, if given, are read once before, to know what the
    words that occur often look up; a text with one of the words that tell most
    often is decided at the first of these, and none of its words go on. Joins
    are by 64-bit hashes, and what they bring together is compared as it is.
    """
    reach = max(index.reach for index in indexes)
    numbers = ["_row", *keep, *(f"_scan{i}" for i in range(len(sets))), *carry]
    kinds = list(dict.fromkeys(k for index in indexes for k in index.kinds))
    filed = _all_rows(sets, indexes)
    often = None if docs is None else _known_words(docs, sets, filed, kinds)
    texts = list(dict.fromkeys(s.text_col for s in sets))
    given = [F.col(c).alias(f"_text{i}") for i, c in enumerate(texts)] + [c.alias(k) for k, c in carry.items()]
    lists = rows.select(*(c for c in numbers if c not in carry), *given, _text_words(sets))
    told = F.lit(False)
    for i, words in enumerate([] if often is None else _telling_words(often, len(sets))):
        if words:
            told = told | ((F.col("_set") == i) & _any_of(F.col("_w"), words))
    lists = lists.withColumn("_told", told)
    gaps = nothing = F.array().cast("array<string>")
    for i, s in enumerate(sets):
        if not s.clean:
            own = replace(s, text_col=f"_text{texts.index(s.text_col)}").gaps()
            gaps = F.when((F.col("_set") == i) & ~F.col("_told"), own).otherwise(gaps)
    scans = [F.greatest(F.col(f"_scan{i}"), (F.col("_told") & (F.col("_set") == i)).cast("int")).alias(f"_scan{i}") for i in range(len(sets))]
    lists = lists.select(
        *("_row", *keep, *scans, *carry, "_set"), F.when(F.col("_told"), nothing).otherwise(F.col("_w")).alias("_w"), gaps.alias("_g")
    )
    outside = F.array_repeat(F.lit(None).cast("string"), reach + 1)
    lists = lists.select(
        *numbers,
        "_set",
        (F.size("_w") + 1).alias("_n"),
        F.concat(outside, F.array(F.lit("")), F.col("_w"), outside).alias("_w"),
        F.concat(outside, F.col("_g"), outside).alias("_g"),
    )

    def piece(start: Column) -> Column:
        along = F.lit(WORDS_ALONG + 2 * (reach + 1))
        parts = {"w": F.slice("_w", start + 1, along), "g": F.slice("_g", start + 1, along)}
        return F.struct(*(c.alias(k) for k, c in parts.items()), F.least(F.lit(WORDS_ALONG), F.col("_n") - start).alias("n"))

    pieces = F.transform(F.sequence(F.lit(0), F.col("_n") - 1, F.lit(WORDS_ALONG)), piece)
    split = lists.select(*numbers, "_set", F.posexplode(pieces).alias("_p", "_z"))
    split = split.select(*numbers, "_set", F.col("_p").alias("_piece"), F.col("_z.w").alias("_w"), F.col("_z.g").alias("_g"), F.col("_z.n").alias("_n"))
    words = split.withColumn("_p", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).withColumn("_word", _beside("_w", reach, 0))
    asks = F.when((F.col("_piece") == 0) & (F.col("_p") == 0), F.array(F.lit(KEEP).cast("bigint")))
    if often is not None:
        often = often.drop("_n").withColumn("_known_hash", F.xxhash64("_of", "_known_word"))
        words = words.join(F.broadcast(often), F.xxhash64("_set", "_word") == F.col("_known_hash"), "left")
        same = (F.col("_set") == F.col("_of")) & (F.col("_word") == F.col("_known_word"))
        asks = F.coalesce(asks, F.when(same, F.col("_asks")))
    words = words.select(*numbers, "_set", "_w", "_g", "_p", "_word", asks.alias("_asks")).filter(F.col("_asks").isNull() | (F.size("_asks") > 0))
    anchors = filed.groupBy(F.xxhash64("_of", "anchor").alias("_anchor")).agg(F.collect_set("_ask").alias("_there"))
    keyed = _with_keys(words, kinds, F.when(F.col("_asks").isNotNull(), F.array(F.lit(""))))
    keyed = keyed.withColumn("_key", F.when(F.col("_asks").isNull(), F.xxhash64("_set", "_key")))
    keyed = keyed.join(F.broadcast(anchors), F.col("_key") == F.col("_anchor"), "left")
    asking = keyed.withColumn("_ask", F.explode(F.coalesce("_asks", "_there"))).drop("_key", "_anchor", "_there", "_asks")
    chars = F.col("_ask").bitwiseAND(F.lit(15)).cast("int") - 5
    marked = F.col("_ask").isin(KEEP, HIT)
    after, before = F.left(_beside("_w", reach, 1), chars), F.right(_beside("_w", reach, -1), -chars)
    there = F.when(marked | (chars == 0), "").when(chars > 0, after).otherwise(before)
    marks = rows.sparkSession.range(1).select(F.explode(F.array(*(F.lit(m).cast("bigint") for m in (KEEP, HIT)))).alias("_ask"), F.lit("").alias("side"))
    shape = ("term", "one_word", "before", "after", "at", "size", "_of")
    filed = filed.withColumn("side", F.substr("side", F.lit(2))).select("_ask", "side", *shape).unionByName(marks, allowMissingColumns=True)
    filed = filed.select(F.xxhash64("_ask", "side").alias("_filed"), *shape)
    met = asking.join(F.broadcast(filed), F.xxhash64("_ask", there) == F.col("_filed"))
    found = reduce(lambda x, y: x | y, ((F.col("_set") == i) & (F.col("_of") == i) & _window_hit(s, reach) for i, s in enumerate(sets)))
    met = met.filter(F.when(marked, F.col("term").isNull()).otherwise(F.col("term").isNotNull() & found))
    hits = []
    for i, s in enumerate(sets):
        hit = ((F.col("_set") == i) & (F.col("_ask") != KEEP)).cast("int")
        hits.append(F.greatest(F.max(hit), F.max(f"_scan{i}")).alias(s.flag))
    kept = [F.first(c).alias(c) for c in [*keep, *carry]]
    return met.groupBy("_row").agg(*kept, *hits).drop("_row")


# -- dictionaries too large to send along ----------------------------------------------


def _salted(words: DataFrame) -> DataFrame:
    """Add ``_salt``: the numbers of the tasks that a word with ``n`` occurrences is dealt to."""
    tasks = F.ceil(F.col("n") / F.lit(TASK_ROWS)).cast("int")
    return words.withColumn("_salt", F.explode(F.sequence(F.lit(0), tasks - 1)))


def _dealt(occurrences: DataFrame, words: DataFrame) -> DataFrame:
    """Occurrences of words that are looked for, each with one of its word's salts.

    Few words are frequent enough to have more than one; those are sent along.
    """
    heavy = words.filter(F.col("n") > TASK_ROWS).select(F.col("_word").alias("_heavy"), F.ceil(F.col("n") / F.lit(TASK_ROWS)).alias("_tasks"))
    heavy = heavy.distinct()
    sent = F.broadcast(heavy) if heavy.count() <= BROADCAST_TERMS else heavy
    placed = occurrences.join(sent, F.col("_word") == F.col("_heavy"), "left")
    salt = F.coalesce(F.pmod(F.xxhash64("_row"), F.col("_tasks")), F.lit(0)).cast("int")
    return placed.withColumn("_salt", salt).drop("_heavy", "_tasks")


def _shuffled_rows(rows: DataFrame, one: TermSet, terms: DataFrame) -> DataFrame:
    """Distinct ``_row`` of the texts with a term, without sending the dictionary along."""
    given = [] if one.clean else [one.text().alias("_text")]
    split = written(rows.select("_row", one.words().alias("_w"), *given), "split")
    words = split.select("_row", F.explode(F.array_distinct("_w")).alias("_word")).filter(F.col("_word") != "")
    vocabulary = written(words.groupBy("_word").agg(F.count(F.lit(1)).alias("n")), "vocabulary")
    offered = _measured(_candidates(terms, one.whole_word), "candidates")
    parts = []
    text = F.array_join("_w", " ") if one.clean else F.col("_text")
    if offered.bare[0]:
        bare, _ = _scanned(split.withColumn(one.text_col, text), one, _Index(offered.rows.filter("anchor is null"), {}, 0, 0, offered.bare), "_hit")
        parts.append(bare.filter("_hit > 0").select("_row"))
    if offered.kinds:
        anchors = offered.rows.filter("anchor is not null")
        met = _with_keys(vocabulary, list(offered.kinds)).distinct()
        met = written(met.join(anchors.select("anchor").distinct(), F.col("_key") == F.col("anchor"), "left_semi"), "answers")
        # How often the texts hold each anchor; terms that need one they do not hold are out.
        occurs = met.groupBy(F.col("_key").alias("held")).agg(F.sum("n").alias("occurs"))
        priced = anchors.join(occurs, F.col("anchor") == F.col("held"), "left")
        absent = priced.filter("occurs is null").select("term").distinct()
        filed = _best(priced.join(absent, "term", "left_anti"), "occurs")
        found = written(met.join(filed, F.col("_key") == F.col("anchor")).drop("_key", "anchor"), "found")
        single = F.col("one_word") & F.lit(one.clean or not one.whole_word)
        alone = found.filter(single & _holds(F.col("_word"), F.col("term"), one.whole_word)).select("_word", "n").distinct()
        dealt = _dealt(words, alone)
        parts.append(dealt.join(_salted(alone), ["_word", "_salt"], "left_semi").select("_row"))
        phrases = found.filter(~single).drop("n", "one_word")
        wanted = found.filter(~single).select("_word", "n").distinct()
        # A word takes its neighbours along, not its text; words without an anchor are left out.
        near = {"_word": 0, "_prev": -1, "_next": 1}
        places = split.select("_row", F.inline(F.arrays_zip(*(_shifted(F.col("_w"), d).alias(k) for k, d in near.items()))))
        windows = places.fillna("", ["_prev", "_next"]).join(wanted.select("_word"), "_word", "left_semi")
        asked = phrases.join(_salted(wanted), "_word")
        close = _dealt(windows, wanted).join(asked, ["_word", "_salt"])
        close = close.filter(F.endswith("_prev", F.col("before")) & F.startswith("_next", F.col("after")))
        candidates = close.select(F.col("_row").alias("_of"), "term").distinct()
        holds = _holds(text, F.col("term"), one.whole_word)
        parts.append(split.join(candidates, (F.col("_row") == F.col("_of")) & holds, "left_semi").select("_row"))
    return reduce(DataFrame.union, parts).distinct() if parts else split.select("_row").filter(F.lit(False))


# -- flags -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Filed:
    """A dictionary measured, filed under its anchors and written, with the plan to use."""

    plan: str
    index: _Index


def file_sets(sets: Sequence[TermSet]) -> list[Filed]:
    """The sets' dictionaries made ready; good for any number of ``flag_sets`` calls."""
    filed = []
    for one in sets:
        terms = usable_terms(one.terms) if one.clean else one.terms.select("term").filter("term <> ''").distinct()
        if one.clean:  # others never occur in such texts
            terms = terms.filter(F.col("term") == clean_text(F.col("term")))
        index = _measured(anchored_terms(terms, one.whole_word), one.flag)
        filed.append(Filed(_plan_for(index.count, index.size) if one.plan == "auto" else one.plan, index))
    return filed


def flag_sets(
    docs: DataFrame,
    sets: Sequence[TermSet],
    keep: Sequence[str] = (),
    carry: dict[str, Column] | None = None,
    filed: Sequence[Filed] | None = None,
) -> DataFrame:
    """``keep`` and ``carry`` of every row of ``docs``, and a 0/1 flag for each set.

    Every row is judged by itself, also where ids are null or repeat. ``keep``
    are columns of ``docs``, ``carry`` further numbers computed once from each
    row. Sets with an index are looked up together, in one pass over the texts.
    ``filed`` are the sets as ``file_sets`` made them ready, else that is done here.
    """
    carry = carry or {}
    count_words = filed is None
    filed = file_sets(sets) if filed is None else filed
    plans, indexes = [f.plan for f in filed], [f.index for f in filed]
    if not sets or all(p == "scan" for p in plans):
        rows = docs.select(*keep, *dict.fromkeys(s.text_col for s in sets if s.text_col not in keep), *(c.alias(k) for k, c in carry.items()))
        for one, index in zip(sets, indexes):
            rows = rows.withColumn("_scan_text", one.text())
            rows = flag_in_place(rows, index.rows, "_scan_text", one.flag, one.whole_word).drop("_scan_text")
        return rows.select(*keep, *carry, *(s.flag for s in sets))
    large = [i for i, p in enumerate(plans) if p == "shuffled"]
    # Terms of the index that are longer than what goes along with a word are met by joins.
    far = [i for i, p in enumerate(plans) if p == "indexed" and indexes[i].far]
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    if large or far:  # the texts are joined with what is found in them: row numbers have to stay
        texts = dict.fromkeys(s.text_col for s in sets if s.text_col not in keep)
        rows = written(rows.select("_row", *keep, *texts, *(c.alias(k) for k, c in carry.items())), "rows")
        keep, carry = [*keep, *carry], {}
        for i in sorted([*large, *far]):
            terms = indexes[i].rows.filter(_reach() > REACH) if i in far else indexes[i].rows
            hits = _shuffled_rows(rows, sets[i], terms.select("term"))
            hits = hits.select(F.col("_row").alias("_of"), F.lit(1).alias("_hit"))
            flag = F.coalesce(F.col("_hit"), F.lit(0)).alias(f"_far{i}" if i in far else sets[i].flag)
            rows = rows.join(hits, F.col("_row") == F.col("_of"), "left").select(*rows.columns, flag)
    known = [sets[i].flag for i in large]
    small = [i for i in range(len(sets)) if i not in large]
    order = [*keep, *carry, *(s.flag for s in sets)]
    if not small:
        return rows.select(*order)
    asked, left = [], []
    for i in small:
        rows, index = _scanned(rows, sets[i], indexes[i], "_scan")
        if i in far:
            rows = rows.withColumn("_scan", F.greatest("_scan", f"_far{i}")).drop(f"_far{i}")
        name = f"_scan{len(asked)}" if index.kinds else sets[i].flag
        rows = rows.withColumnRenamed("_scan", name)
        if index.kinds:
            asked.append(sets[i])
            left.append(index)
        else:
            known.append(name)
    if not asked:
        return rows.withColumns(carry).select(*order)
    return _looked_up(rows, asked, left, [*keep, *known], carry, docs if count_words else None).select(*order)


def matching_ids(
    docs: DataFrame,
    terms: DataFrame,
    id_col: str,
    text_col: str,
    plan: str = "auto",
    whole_word: bool = False,
    clean: bool = False,
) -> DataFrame:
    """Distinct ids of the texts that contain any of ``terms(term)``.

    The text is matched as it is; ``clean`` matches it in its cleaned form.
    """
    flagged = flag_sets(docs, [TermSet("_flag", terms, text_col, whole_word, clean, plan)], [id_col])
    return flagged.filter("_flag = 1").select(id_col).distinct()


def flag_matches(
    docs: DataFrame,
    terms: DataFrame,
    id_col: str,
    text_col: str,
    flag: str = "malware_flag",
    plan: str = "auto",
    whole_word: bool = False,
    clean: bool = False,
) -> DataFrame:
    """Add a 0/1 column telling which texts contain any term; ``id_col`` may be null or repeat.

    Give ``docs`` without columns that need not travel with the flags.
    """
    keep = [c for c in docs.columns if c != flag]
    return flag_sets(docs, [TermSet(flag, terms, text_col, whole_word, clean, plan)], keep)


def _scan_groups(terms: DataFrame, whole_word: bool) -> DataFrame:
    """``(_keys, _filed)``: hashes of words inside terms, and the terms of each, many in a row.

    Pieces of a term with others on both sides are whole words of every text
    that holds the term, next to each other there too. The key is the hash of
    two of them in a row, the longest, or of the only one; a term without any
    is a row of its own, without a key.
    """
    given = F.concat(F.lit(" "), "term", F.lit(" ")) if whole_word else F.col("term")
    rows = terms.select("term", F.split(given, NON_WORD, -1).alias("p"))
    rows = rows.select("term", F.slice("p", F.lit(2), F.greatest(F.size("p") - 2, F.lit(0))).alias("p"))
    offered = _in_a_row(F.col("p"), lambda a, b: F.struct((F.length(a) + F.length(b)).alias("n"), F.xxhash64(a, b).alias("key")))
    key = F.when(F.size("p") > 1, F.array_max(offered)["key"]).when(F.size("p") == 1, F.xxhash64(F.get("p", F.lit(0))))
    rows = rows.select("term", key.alias("key"))
    alone = F.when(F.col("key").isNull(), F.col("term")).alias("alone")
    keyed = rows.groupBy("key", alone).agg(F.collect_set("term").alias("terms"))
    filed = keyed.groupBy(F.pmod("key", F.lit(SCAN_GROUPS)).alias("group"), "alone").agg(F.collect_list(F.struct("key", "terms")).alias("f"))
    return filed.select(F.filter("f.key", F.isnotnull).alias("_keys"), F.col("f.terms").alias("_filed"))


def _in_a_row(words: Column, of: Callable[[Column, Column], Column]) -> Column:
    """What ``of`` gives for every two words in a row."""
    firsts = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    return F.zip_with(firsts, F.slice(words, F.lit(2), F.size(words)), of)


def flag_in_place(
    docs: DataFrame,
    terms: DataFrame,
    text_col: str,
    flag: str = "malware_flag",
    whole_word: bool = False,
) -> DataFrame:
    """The scan plan as a 0/1 column: an existence join that keeps rows where they are.

    The dictionary is filed and written once and sent to all tasks; callers
    that cannot bound it measure it first (``flag_sets`` does).
    """
    filed = written(_scan_groups(terms, whole_word), "scan")
    text = fill_text(F.col(text_col))
    if filed.filter(F.size("_keys") > 0).isEmpty():
        words = docs.withColumn("_scan_keys", F.array().cast("array<bigint>"))
    else:
        words = docs.withColumn("_scan_words", F.split(text, NON_WORD, -1))
        hashes = F.concat(F.transform("_scan_words", lambda a: F.xxhash64(a)), _in_a_row(F.col("_scan_words"), lambda a, b: F.xxhash64(a, b)))
        words = words.withColumn("_scan_keys", hashes).drop("_scan_words")
    text, asked = text.outer(), F.col("_keys")
    met = F.array_intersect(F.col("_scan_keys").outer(), asked)

    def held(key: Column) -> Column:
        """Whether the text holds a term of this key."""
        filed_there = F.get("_filed", (F.array_position(asked, key) - 1).cast("int"))
        return F.exists(filed_there, lambda term: _holds(text, term, whole_word))

    lone = _holds(text, F.get(F.get("_filed", F.lit(0)), F.lit(0)), whole_word)
    hit = F.when(F.size(asked) == 0, lone).when(F.size(met) > 0, F.exists(met, held))
    hit = F.broadcast(filed).filter(hit).exists()
    return words.withColumn(flag, F.coalesce(hit.cast("int"), F.lit(0))).drop("_scan_keys")


def _tested_in_place(docs: DataFrame, terms: DataFrame, text_col: str, flag: str, whole_word: bool) -> DataFrame:
    """The same for the few terms that no word inside them tells, compared one by one."""
    small = F.broadcast(terms.select(F.col("term").alias("_term")))
    text = fill_text(F.col(text_col)).outer()
    hit = small.filter(_holds(text, F.col("_term"), whole_word)).exists()
    return docs.withColumn(flag, F.coalesce(hit.cast("int"), F.lit(0)))


def dictionary_flag(
    docs: DataFrame,
    terms: DataFrame,
    id_col: str,
    text_col: str,
    flag: str = "malware_flag",
    plan: str = "auto",
    whole_word: bool = False,
) -> DataFrame:
    """Flag texts by their cleaned form (raw or cleaned text may be given)."""
    return flag_matches(docs, terms, id_col, text_col, flag, plan, whole_word, True)


def gazetteer_flag(
    docs: DataFrame,
    entities: DataFrame,
    types: tuple[str, ...],
    id_col: str,
    text_col: str,
    flag: str = "has_info_entities",
    plan: str = "auto",
) -> DataFrame:
    """Flag raw texts naming an entity of the wanted types; case matters.

    Names holding another name cannot change a flag and are left out.
    """
    return flag_matches(docs, gazetteer_names(entities, types), id_col, text_col, flag, plan)


def gazetteer_names(entities: DataFrame, types: tuple[str, ...]) -> DataFrame:
    """Names ``(term)`` of the wanted types that hold no other one, written once."""
    named = entities.filter(F.col("type").isin(*types)).select(F.col("name").alias("term"))
    return written(minimal_terms(named, on_clean_text=False), "names")
