"""MinHash near-dedup with dart signatures of weighted shingle sets.

A document is the set of its five-word shingles, each as heavy as it is
frequent. Darts with fixed places rain on every element's region: each has a
height (its rank) and a coordinate of the signature. A document keeps, for each
coordinate, the earliest dart that falls inside its regions. Two documents keep
the same dart with a probability of their weighted Jaccard similarity. Bands of
coordinates lead to candidates, and candidates are compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexvane.llm import sequences as seq
from lexvane.llm.components import components
from lexvane.storage import written

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 24, 5  # at similarity 0.8 a pair is missed with probability 7e-5
# Buckets of more members than PAIRED are compared in blocks of about BLOCK shingles;
# a member counts as LIGHTEST shingles at least, which bounds the members of a block.
PAIRED, BLOCK, LIGHTEST = 8, 1 << 18, 256
# Rows of a matrix compared at once, and elements multiplied at once: a task holds little beside the counts.
TILE, WIDTH = 128, 512
CHUNK = 1 << 19  # bytes of text worked on at once
_GAP = 0xA24BAED4963EE407
_COORDINATE = np.uint64(0x9FB21C651E98DF25)


def elements(some: seq.Symbols, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle hash and weight, sorted by text and hash.

    A text of fewer than ``n`` words (but at least one) is a single shingle.
    """
    sums, bounds = seq.prefix(some.values), some.bounds
    sizes = np.diff(bounds)
    counts = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(np.int64))
    text = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[text]
    runs = seq.run_hash(sums, place, np.minimum(n, sizes[text]))
    order = np.lexsort((runs, text))
    text, runs = text[order], runs[order]
    first = np.flatnonzero(np.r_[True, (runs[1:] != runs[:-1]) | (text[1:] != text[:-1])][: len(runs)])
    return text[first], runs[first], np.diff(np.r_[first, len(runs)]).astype(np.float64)


def dart_signatures(text: np.ndarray, element: np.ndarray, weight: np.ndarray, texts: int, k: int) -> np.ndarray:
    """The earliest dart of each coordinate, one row for each text.

    The region of an element is cut into unit regions up to its weight; in each
    of them darts fall at ranks with exponential gaps, and at a width that says
    whether a last, partial unit still holds them. Everything about a dart comes
    from hashes of its element, unit and number, so documents meet the same
    darts. Ranks are looked at up to a bound at which about ``k ln k + 2k``
    darts have fallen; texts with an empty coordinate go on with twice the
    bound. Texts without elements have a signature of zeros.
    """
    signature = np.zeros((texts, k), np.uint64)
    total = np.bincount(text, weights=weight, minlength=texts)
    bound = np.divide(k * np.log(k) + 2 * k, total, out=np.zeros(texts), where=total > 0)
    units = np.ceil(weight).astype(np.int64)
    unit_of = np.repeat(np.arange(len(text)), units)
    number = (np.arange(len(unit_of)) - np.repeat(np.cumsum(units) - units, units)).astype(np.uint64)
    room = weight[unit_of] - number.astype(np.float64)
    seed = seq.mix(element[unit_of] + number * np.uint64(0xD6E8FEB86659FD93))
    owner = text[unit_of]
    while len(owner):
        ranks, darts, owners = [], [], []
        active, rank, throw = np.arange(len(owner)), np.zeros(len(owner)), 0
        while len(active):
            dart = seq.mix(seed[active] + np.uint64(throw * _GAP % 2**64))
            chance = ((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            rank = rank - np.log(chance)
            inside = rank < bound[owner[active]]
            active, rank, dart = active[inside], rank[inside], dart[inside]
            partial = room[active] < 1
            held = np.ones(len(active), bool)
            if partial.any():
                width = (seq.mix(dart[partial]) >> np.uint64(11)).astype(np.float64) * 2.0**-53
                held[partial] = width < room[active][partial]
            ranks.append(rank[held])
            darts.append(dart[held])
            owners.append(owner[active[held]])
            throw += 1
        rank, dart, who = np.concatenate(ranks), np.concatenate(darts), np.concatenate(owners)
        coordinate = (seq.mix(dart ^ _COORDINATE) % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")  # the earliest is written last
        fresh = np.zeros((texts, k), np.uint64)
        fresh[who[order], coordinate[order]] = dart[order] | np.uint64(1)
        done = np.unique(owner)
        signature[done] = fresh[done]
        empty = np.zeros(texts, bool)
        empty[done] = (fresh[done] == 0).any(axis=1)
        bound = np.where(empty, 2 * bound, bound)
        again = empty[owner]
        owner, seed, room = owner[again], seed[again], room[again]
    return signature


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One number for each band of a signature."""
    texts, k = signature.shape
    parts = signature.reshape(texts, bands, k // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (texts, bands)).copy()
    for i in range(k // bands):
        key = seq.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return key


def _signed_rows(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``row_key, doc_id, digest, bands``: digests of word sequences, bands of signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in seq.parts(batches):
            texts = seq.texts_of(batch.column(1))
            for a, b in seq.text_chunks(texts, CHUNK):
                some = seq.word_symbols(texts[a:b])
                text, element, weight = elements(some, n)
                keys = band_keys(dart_signatures(text, element, weight, b - a, bands * rows), bands)
                ends = zip(some.bounds[:-1].tolist(), some.bounds[1:].tolist())
                digests = [
                    hashlib.blake2b(some.values[x:y].tobytes(), digest_size=16).digest() if y > x else None for x, y in ends
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(digests, pa.binary()),
                        seq.lists(keys.ravel(), np.full(b - a, bands), pa.int64()),
                    ],
                    ["id", "digest", "bands"],
                )

    return docs.select("id", "text").mapInArrow(run, "id long, digest binary, bands array<long>")


def _shingle_rows(docs: DataFrame, n: int) -> DataFrame:
    """``id, shingles``: hashes of the weighted set, a frequent shingle once for each time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in seq.parts(batches):
            texts = seq.texts_of(batch.column(1))
            for a, b in seq.text_chunks(texts, CHUNK):
                text, element, weight = elements(seq.word_symbols(texts[a:b]), n)
                times = weight.astype(np.int64)
                copy = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                hashes = seq.mix(np.repeat(element, times) + copy.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                counts = np.bincount(text, weights=weight, minlength=b - a).astype(np.int64)
                ids = batch.column(0).slice(a, b - a)
                yield pa.RecordBatch.from_arrays([ids, seq.lists(hashes, counts, pa.int64())], ["id", "shingles"])

    return docs.select("id", "text").mapInArrow(run, "id long, shingles array<long>")


def _verified(pairs: DataFrame, shingles: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` (and what is beside them) of at least this weighted Jaccard similarity."""
    left = shingles.select(F.col("id").alias("a2"), F.col("shingles").alias("sa"))
    right = shingles.select(F.col("id").alias("b2"), F.col("shingles").alias("sb"))
    both = pairs.join(left, F.col("a") == F.col("a2")).join(right, F.col("b") == F.col("b2"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.filter(shared >= least * (F.size("sa") + F.size("sb") - shared)).select(*pairs.columns)


def near_duplicates(
    docs: DataFrame, n: int = SHINGLE, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, class_id, kept`` of every document.

    Documents joined by links of similarity ``least`` or more are a class; its
    id is the smallest ``doc_id``, whose document is kept. Documents without
    words (null, empty) have no shingles and are classes of their own, as are
    documents without an id. Texts under ``n`` words are linked to equal ones.
    Rows sharing a ``doc_id`` are one document with several texts and share
    their class. Further columns are left out; an empty table stays empty.

    Equal word sequences become one before anything is compared, so a group of
    copies costs one row. Within a bucket of a band, members are compared with
    one hub at a time: first the smallest id, then the member with most links,
    which ties a group of near copies together without all its pairs. Only
    members of buckets that then still hold different classes are compared with
    each other, block by block where there are many, so no link between classes
    found in a bucket is left out.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("id"), "text").filter("id is not null")
    signed = written(_signed_rows(ids, n, bands, rows), "signatures")
    worded = signed.filter("digest is not null")
    digests = worded.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("last"))
    shared = written(digests.filter("rep < last").select(F.col("digest").alias("d2"), "rep"), "copies")
    named = worded.join(shared, F.col("digest") == F.col("d2"), "left")
    copies = named.filter("rep < id").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    single = written(named.filter("rep is null or rep = id").select("id", "bands"), "single")

    cells = single.select("id", F.explode("bands").alias("cell")).distinct()
    full = cells.groupBy("cell").agg(F.min("id").alias("hub"), F.max("id").alias("last")).filter("hub < last")
    full = written(full.select("cell", "hub"), "buckets")
    member = written(cells.join(full, "cell"), "members")
    needed = member.select(F.col("id").alias("needed")).distinct()
    shingles = written(_shingle_rows(ids.join(needed, F.col("id") == F.col("needed"), "left_semi"), n), "shingles")

    # One hub a member to begin with, the smallest: the rounds see to all that it leaves open.
    pairs = member.filter("id != hub").groupBy(F.col("id").alias("a")).agg(F.min("hub").alias("b"))
    links = written(_verified(pairs, shingles, least), "near")
    classes = components(_joined(member, shingles, links, least).unionByName(copies))
    out = docs.select("doc_id").join(classes, F.col("doc_id") == F.col("node"), "left")
    own = F.coalesce("component", F.col("doc_id").cast("long"))
    kept = F.coalesce(own == F.col("doc_id"), F.lit(True))
    return out.select("doc_id", own.alias("class_id"), kept.alias("kept"))


def _joined(member: DataFrame, shingles: DataFrame, links: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` whose components are the classes, beginning with those to the first hubs.

    Classes are contracted: a round compares members of buckets that hold
    several classes with a hub of another class, and only the pairs of classes
    it links go into the next components.
    """
    first = components(links)
    every = first.select(F.col("node").alias("a"), F.col("component").alias("b"))
    degree = every.groupBy(F.col("b").alias("end")).agg(F.count(F.lit(1)).alias("degree"))
    named = member.select("id", "cell").join(first, F.col("id") == F.col("node"), "left")
    named = named.join(degree, F.col("id") == F.col("end"), "left")
    named = named.select("id", "cell", F.coalesce("component", "id").alias("class"), F.coalesce("degree", F.lit(0)).alias("degree"))
    open_ = _open_buckets(named)
    while not open_.isEmpty():
        best = open_.groupBy("cell").agg(F.min(F.struct(-F.col("degree"), "id", "class")).alias("hub"))
        best = best.select(F.col("cell").alias("hub_cell"), F.col("hub.id").alias("hub"), F.col("hub.class").alias("hub_class"))
        tried = open_.join(best, (F.col("cell") == F.col("hub_cell")) & (F.col("class") != F.col("hub_class")))
        tried = tried.select(F.col("id").alias("a"), F.col("hub").alias("b"), "class", "hub_class").distinct()
        more = written(_verified(tried, shingles, least), "near")
        if more.isEmpty():
            return every.unionByName(written(_rest(open_, shingles, least), "near"))
        pairs = more.select(F.col("class").alias("a"), F.col("hub_class").alias("b")).distinct()
        merged = components(pairs)
        every = every.unionByName(pairs)
        again = open_.join(merged, F.col("class") == F.col("node"), "left")
        open_ = _open_buckets(again.select("id", "cell", F.coalesce("component", "class").alias("class"), "degree"))
    return every


def _open_buckets(named: DataFrame) -> DataFrame:
    """``id, cell, class, degree`` of the members of buckets that hold several classes."""
    named = written(named, "classed")
    several = named.groupBy("cell").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).filter("lo < hi")
    return written(named.join(several.select("cell"), "cell", "left_semi"), "open")


def _rest(open_: DataFrame, shingles: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` that join all classes with a link between members of one bucket.

    Small buckets are compared pair by pair. A large one would make pairs with
    the square of its members, so its members are dealt into blocks, and two
    blocks at a time are compared inside a task, which gives no more links than
    it has classes. The members of a bucket's largest class need no comparison
    with one another and have blocks of their own.
    """
    members = open_.groupBy("cell").agg(F.count(F.lit(1)).alias("members"))
    many = members.filter(F.col("members") > PAIRED).select(F.col("cell").alias("many"))
    few = open_.join(many, F.col("cell") == F.col("many"), "left_anti")
    large = open_.join(many, F.col("cell") == F.col("many"), "left_semi")
    return _verified(_across(few), shingles, least).unionByName(_linked_blocks(large, shingles, least))


def _linked_blocks(large: DataFrame, shingles: DataFrame, least: float) -> DataFrame:
    """Links ``(a, b)`` between classes, found by comparing blocks of members."""
    sizes = shingles.select(F.col("id").alias("sized"), F.greatest(F.size("shingles"), F.lit(LIGHTEST)).alias("size"))
    member = large.join(sizes, F.col("id") == F.col("sized")).select("id", "cell", "class", "size")
    by_class = member.groupBy("cell", "class").agg(F.sum("size").alias("size"))
    cells = by_class.groupBy(F.col("cell").alias("of")).agg(
        F.max(F.struct("size", "class")).alias("core"), F.sum("size").alias("all")
    )
    blocks = [F.ceil(s / F.lit(BLOCK)).cast("int") for s in (F.col("core.size"), F.col("all") - F.col("core.size"))]
    cells = cells.select("of", F.col("core.class").alias("core"), blocks[0].alias("cores"), blocks[1].alias("rests"))
    dealt = member.join(cells, F.col("cell") == F.col("of")).withColumn("is_core", F.col("class") == F.col("core"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("is_core"), F.col("cores")).otherwise(F.col("rests"))).cast("int")
    dealt = dealt.withColumn("block", own)
    # Every block of other classes meets each of the core and each of the others; (i, -1 - j): block j of the core.
    rests, cores = (F.sequence(F.lit(0), F.col(c) - 1) for c in ("rests", "cores"))
    others = F.filter(rests, lambda x: x != F.col("block"))
    met = [
        F.transform(others, lambda x: F.struct(F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j"))),
        F.transform(cores, lambda x: F.struct(F.col("block").alias("i"), (-1 - x).alias("j"))),
    ]
    with_rests = F.transform(rests, lambda x: F.struct(x.alias("i"), (-1 - F.col("block")).alias("j")))
    tasks = F.when(F.col("is_core"), with_rests).otherwise(F.concat(*met))
    dealt = dealt.select("id", "class", "cell", F.inline(tasks))
    filled = dealt.join(shingles.withColumnRenamed("id", "id2"), F.col("id") == F.col("id2"))
    filled = filled.select("cell", "i", "j", "class", "shingles")

    def links(table: pa.Table) -> pa.Table:
        lists = table.column("shingles").combine_chunks()
        classes, at = np.unique(table.column("class").to_numpy(), return_inverse=True)
        bounds = lists.offsets.to_numpy()
        sets = lists.values.to_numpy()[bounds[0] : bounds[-1]]
        a, b = linked(sets, np.diff(bounds), at, least)
        end = joined(a, b, len(classes))
        moved = np.flatnonzero(end != np.arange(len(classes)))
        return pa.table({"a": classes[moved], "b": classes[end[moved]]})

    return filled.groupBy("cell", "i", "j").applyInArrow(links, "a long, b long").distinct()


def linked(sets: np.ndarray, sizes: np.ndarray, group: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of groups between whose sets there is a weighted Jaccard similarity of ``least`` or more.

    ``sets`` holds all sets one after the other. Elements of one set only are
    left out; what the others share is summed as products of 0/1 matrices, some
    elements at a time.
    """
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    _, element, times = np.unique(sets, return_inverse=True, return_counts=True)
    held = times[element] > 1
    owner, element = owner[held], element[held]
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], np.unique(element[order], return_inverse=True)[1]
    shared = np.zeros((n, n), np.float32)
    rare = np.bincount(element, minlength=1)[element] == 2 if len(element) else np.zeros(0, bool)
    pair = owner[rare].reshape(-1, 2)  # elements of two sets, without a matrix
    np.add.at(shared, (pair[:, 0], pair[:, 1]), 1)
    np.add.at(shared, (pair[:, 1], pair[:, 0]), 1)
    owner, element = owner[~rare], element[~rare]
    element = np.unique(element, return_inverse=True)[1]
    edges = np.searchsorted(element, np.arange(0, (element[-1] if len(element) else -1) + 1 + WIDTH, WIDTH))
    rows = [(i, min(i + TILE, n)) for i in range(0, n, TILE)]
    for start, (x, y) in enumerate(zip(edges[:-1], edges[1:])):
        part = np.zeros((n, WIDTH), np.float32)
        part[owner[x:y], element[x:y] - start * WIDTH] = 1
        for i, j in rows:
            shared[i:j] += part[i:j] @ part.T
    found = []
    for i, j in rows:
        total = sizes[i:j, None] + sizes[None, :] - shared[i:j].astype(np.float64)
        close = (shared[i:j] >= least * total) & (group[i:j, None] < group[None, :])
        a, b = np.nonzero(close)
        found.append((group[a + i], group[b]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (group[:0], group[:0])


def joined(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of ``n`` is joined with by links ``(a, b)``."""
    end = np.arange(n)
    while True:
        low = np.minimum(end[a], end[b])
        new = end.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == end).all():
            return end
        end = new


def _across(open_: DataFrame) -> DataFrame:
    """The pairs of a bucket whose classes differ."""
    other = open_.select(F.col("id").alias("b"), F.col("cell").alias("cell2"), F.col("class").alias("class2"))
    both = open_.join(other, (F.col("cell") == F.col("cell2")) & (F.col("class") < F.col("class2")))
    return both.select(F.col("id").alias("a"), "b").distinct()
