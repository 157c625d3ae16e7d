"""Toxicity of documents from a learned lexicon that forgives misspellings.

Words and word beginnings that mark labelled texts as toxic make a lexicon. It
is kept as a trie, and a Levenshtein automaton of each unknown word is run
against it, so misspelled terms are found as well. The words around a find tell
whether it is quoted or meant; a logistic model turns finds into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.storage import written

SAMPLE = 20_000  # labelled rows that are learned from, at most
FOLDS = 5  # rows whose checksum leaves no remainder are held out
EVIDENCE = 30.0  # log-likelihood ratio (times 2) a term needs
STEMS = (4, 5, 6)  # lengths of word beginnings that can be terms
FUZZY_FROM = 5  # shorter terms are taken literally
CONTEXT = 8  # words on either side that can mark a quotation
QUOTED_WEIGHT = 0.3  # of a find inside a quotation
MISSPELLED_WEIGHT = 0.5  # of a misspelled term
FAMILY = 1.5  # times the texts of its most frequent word a stem must have
CACHE = 60_000  # words a worker remembers in each of two generations

# Words and marks that report what somebody else said.
REPORTING = frozenset(
    "said says quote quoted quotes called wrote writes according term word "
    "sagte schrieb zitat zitierte nannte laut wort dit écrit cité selon appelé mot "
    "dijo escribió cita citó según llamó palabra".split()
)
MARKS = "\"“”„«»‹›"

_TOKEN = re.compile(r"[^\W_]+")


class Lexicon(NamedTuple):
    """Terms and stems with their weights (log odds).

    ``innocent`` are words near a term that texts which are not toxic use.
    """

    terms: dict[str, float]
    stems: dict[str, float]
    innocent: frozenset[str] = frozenset()


def words_of(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


# -- the trie and the automaton ------------------------------------------------


def build_trie(terms: dict[str, float]) -> dict:
    """Nested dicts by character; a term ends where the key ``""`` holds it."""
    root: dict = {}
    for term in terms:
        node = root
        for c in term:
            node = node.setdefault(c, {})
        node[""] = term
    return root


def near_terms(trie: dict, word: str, edits: int) -> list[tuple[int, str]]:
    """``(distance, term)`` of all terms within ``edits`` of the word.

    The states of the word's Levenshtein automaton are rows of distances to its
    beginnings; walking the trie advances the row by a character, and a branch
    ends where no state is within ``edits``.
    """
    found = []
    stack = [(trie, list(range(len(word) + 1)))]
    while stack:
        node, row = stack.pop()
        if "" in node and row[-1] <= edits:
            found.append((row[-1], node[""]))
        for c, child in node.items():
            if not c:
                continue
            new = [row[0] + 1]
            for i, w in enumerate(word):
                new.append(min(new[i] + 1, row[i + 1] + 1, row[i] + (w != c)))
            if min(new) <= edits:
                stack.append((child, new))
    return sorted(found)


def _shortened(word: str) -> list[str]:
    """The word without one of its characters, each in turn."""
    return [word[:i] + word[i + 1 :] for i in range(len(word))]


class Finder:
    """Looks words up: how strong a term they are, and whether misspelled."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        # Words of a stem's family are found by the stem, other terms by their spelling.
        self.fuzzy = {
            t: w
            for t, w in lexicon.terms.items()
            if len(t) >= FUZZY_FROM and not any(t[:n] in lexicon.stems for n in STEMS)
        }
        self.trie = build_trie(self.fuzzy)
        # Words one edit from a term equal one of its forms, or do so without one
        # of their characters; the automaton runs on no others. One edit also leaves
        # one half of a term whole, and its length nearly so, which is looked at first.
        self.forms = set(self.fuzzy).union(*(_shortened(t) for t in self.fuzzy))
        heads: dict[int, dict[str, set[int]]] = {}
        tails: dict[int, dict[str, set[int]]] = {}
        for t in self.fuzzy:
            sizes = (len(t) - 1, len(t), len(t) + 1)
            for halves, half in ((heads, t[: len(t) // 2]), (tails, t[len(t) // 2 :])):
                halves.setdefault(len(half), {}).setdefault(half, set()).update(sizes)
        self.heads, self.tails = list(heads.items()), list(tails.items())
        self.longest = max(map(len, self.fuzzy), default=-2) + 1
        self.stem_starts = {stem[: STEMS[0]] for stem in lexicon.stems}
        self.known: dict[str, tuple[float, float]] = {}
        self.older: dict[str, tuple[float, float]] = {}

    def word(self, word: str) -> tuple[float, float]:
        """Weights of a word as a term and as a misspelled one (0 if neither)."""
        weight = self.lexicon.terms.get(word, 0.0)
        if word[: STEMS[0]] in self.stem_starts:
            found = [self.lexicon.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n]
            weight = max(weight, *found, 0.0)
        if weight or not FUZZY_FROM - 1 <= len(word) <= self.longest or word in self.lexicon.innocent:
            return weight, 0.0
        near = self.near(word)
        return 0.0, max(self.fuzzy[t] for _, t in near) if near else 0.0

    def near(self, word: str) -> list[tuple[int, str]]:
        """The terms one edit away."""
        size = len(word)
        for n, heads in self.heads:
            if size in heads.get(word[:n], ()):
                break
        else:
            for n, tails in self.tails:
                if size in tails.get(word[-n:], ()):
                    break
            else:
                return []
        if word in self.forms or not self.forms.isdisjoint(_shortened(word)):
            return near_terms(self.trie, word, 1)
        return []

    def chunk(self, chunk: str) -> tuple[float, float]:
        """The strongest word of a text without white space."""
        found = self.older.get(chunk)
        if found is None and chunk.isalnum():
            found = self.word(chunk)
        elif found is None:
            looked = [self.word(w) for w in _TOKEN.findall(chunk)] or [(0.0, 0.0)]
            found = looked[0] if len(looked) == 1 else (max(a for a, _ in looked), max(b for _, b in looked))
        if len(self.known) >= CACHE:
            self.known, self.older = {}, self.known
        if len(chunk) <= 100:
            self.known[chunk] = found
        return found

    def features(self, text: str) -> list[float]:
        """Evidence of terms, whole and for each hundred words."""
        chunks = text.lower().split()
        known, chunk = self.known.get, self.chunk
        none = (0.0, 0.0)
        hits = [(i, f) for i, c in enumerate(chunks) if (f := known(c) or chunk(c)) != none]
        sure = near = 0.0
        for i, (a, b) in hits:
            weight = QUOTED_WEIGHT if self.quoted(chunks, i) else 1.0
            sure += weight * a
            near += weight * b
        evidence = sure + MISSPELLED_WEIGHT * near
        return [math.log1p(evidence), math.log1p(100 * evidence / len(chunks)) if chunks else 0.0]

    def quoted(self, chunks: list[str], i: int) -> bool:
        """Between quotation marks, or near a word that reports speech."""
        before, after = chunks[max(0, i - CONTEXT) : i], chunks[i + 1 : i + 1 + CONTEXT]
        if any(c.strip(".,:;!?") in REPORTING for c in before + after):
            return True
        here = chunks[i]
        opened = here[:1] in MARKS or any(c[:1] in MARKS for c in before)
        closed = here.rstrip(".,:;!?")[-1:] in MARKS or any(c.rstrip(".,:;!?")[-1:] in MARKS for c in after)
        return bool(opened and closed)


# -- learning --------------------------------------------------------------------


def held_out() -> Column:
    """Rows that are never learned from; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``limit`` labelled rows, chosen by a hash of their id.

    The chosen ids are a bounded table and so are sent to the documents, which
    are not shuffled.
    """
    rows = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "toxicity-sample")


def _terms_of(words: set[str]) -> Iterator[tuple[int, str]]:
    for word in words:
        if len(word) > 2:
            yield 0, word
    for size in STEMS:
        for stem in {w[:size] for w in words if len(w) > size}:
            yield size, stem


def learn_lexicon(sample: DataFrame, evidence: float = EVIDENCE) -> Lexicon:
    """Terms and stems that tell toxic texts from others.

    Counts texts that hold a term, toxic or not, and keeps those whose
    log-likelihood ratio against the share of toxic texts is large and whose
    texts are mostly toxic. Counts are merged in the workers before a shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, every = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            keys = list(every)
            arrays = [
                pa.array([k for k, _ in keys], pa.int32()),
                pa.array([t for _, t in keys], pa.string()),
                pa.array([toxic[k] for k in keys], pa.int64()),
                pa.array([every[k] for k in keys], pa.int64()),
            ]
            toxic.clear()
            every.clear()
            return pa.RecordBatch.from_arrays(arrays, ["kind", "term", "toxic", "n"])

        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = list(_terms_of(set(words_of(text or ""))))
                every.update(found)
                if label:
                    toxic.update(found)
                if len(every) > 500_000:
                    yield flush()
        yield flush()

    base = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not base["toxic"] or base["toxic"] == base["n"]:
        return Lexicon({}, {})
    share = base["toxic"] / base["n"]
    counts = sample.select("text", "toxic").mapInArrow(run, "kind int, term string, toxic long, n long")
    counts = counts.groupBy("kind", "term").agg(F.sum("toxic").alias("a"), F.sum("n").alias("n"))
    a, n = F.col("a").cast("double"), F.col("n").cast("double")

    def part(x: Column, expected: Column) -> Column:
        return F.when(x > 0, x * F.log(x / expected)).otherwise(0.0)

    ratio = 2 * (part(a, n * share) + part(n - a, n * (1 - share)))
    odds = F.log(((a + 0.5) / (base["toxic"] + 1)) / ((n - a + 0.5) / (base["n"] - base["toxic"] + 1)))
    # What is kept is bounded by the sample: a term needs several of its texts.
    counts = written(counts.select("kind", "term", "a", "n", ratio.alias("ratio"), odds.alias("weight")), "terms")
    rows = counts.filter((F.col("ratio") >= evidence) & (F.col("a") / F.col("n") >= 0.8)).collect()
    terms = {r["term"]: r for r in rows if r["kind"] == 0}
    most = Counter()
    for term, r in terms.items():
        for size in STEMS:
            most[term[:size]] = max(most[term[:size]], r["a"])
    stems = {r["term"]: r["weight"] for r in rows if r["kind"] > 0 and r["a"] >= FAMILY * most[r["term"]]}
    lexicon = Lexicon({t: r["weight"] for t, r in terms.items()}, stems)
    return lexicon._replace(innocent=_innocent(counts, lexicon))


def _innocent(counts: DataFrame, lexicon: Lexicon) -> frozenset[str]:
    """Words one edit from a term that a text which is not toxic holds."""
    sent = counts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sent.value)
        for batch in batches:
            near = [w for w in batch.column(0).to_pylist() if w not in lexicon.terms and finder.near(w)]
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.string())], ["term"])

    sizes = [len(t) for t in lexicon.terms] or [0]
    words = counts.filter((F.col("kind") == 0) & (F.col("n") > F.col("a")))
    words = words.filter(F.length("term").between(FUZZY_FROM - 1, max(sizes) + 1)).select("term")
    # Bounded by the lexicon: a term has some hundred spellings one edit away.
    return frozenset(r["term"] for r in words.mapInArrow(run, "term string").collect())


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Weights of a penalized logistic model, the constant last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    weights = np.zeros(x.shape[1])
    ridge = np.diag([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - ridge @ weights
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _featured(rows: DataFrame, lexicon: Lexicon, more: str) -> DataFrame:
    """Column ``more`` of the rows and the features of their texts."""
    sent = rows.sparkSession.sparkContext.broadcast(lexicon)
    kind = rows.schema[more].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [finder.features(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.float64()))], [more, "x"]
                )

    return rows.select(more, "text").mapInArrow(run, f"{more} {kind}, x array<double>")


class Model(NamedTuple):
    lexicon: Lexicon
    weights: list[float]


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE) -> Model:
    """Learn from the labelled rows that are not held out."""
    sample = training_sample(docs, labels, limit)
    lexicon = learn_lexicon(sample)
    rows = _featured(sample, lexicon, "toxic").collect()  # at most ``limit`` short rows
    if not rows:
        return Model(lexicon, [0.0, 0.0, -30.0])
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    return Model(lexicon, fit_logistic(x, y).tolist())


def _chance(x: Column, weights: list[float]) -> Column:
    *slopes, constant = weights
    logit = F.lit(constant)
    for i, w in enumerate(slopes):
        logit = logit + w * F.get(x, F.lit(i))
    return 1 / (1 + F.exp(-logit))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    Only the text is looked at. Null and empty texts have no finds and get the
    score of such texts; repeated rows stay; further columns are left out; with
    no labelled rows nothing is toxic. Nothing is shuffled.
    """
    chance = _chance(F.col("x"), model.weights)
    return _featured(docs, model.lexicon, "doc_id").select(
        "doc_id", held_out().alias("held_out"), chance.alias("score"), (chance >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose texts ``score`` would not predict as toxic, all columns as they are.

    Each row is judged by its text alone, so null ids and repeated rows are
    judged like others; null and empty texts have no finds. Whole batches pass
    through and are filtered; texts are unpacked a few hundred at a time.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model.lexicon)
    *slopes, constant = model.weights
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                logits = []
                for text in part.column(place).to_pylist():
                    logit = constant
                    for w, x in zip(slopes, finder.features(text or "")):
                        logit = logit + w * x
                    logits.append(logit)
                yield part.filter(pa.array(np.array(logits) < 0))

    return docs.mapInArrow(run, docs.schema)
