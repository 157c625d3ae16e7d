"""Mixing sources to target weights along a curriculum.

Every source has a share of all words (its target) and a schedule that says how
its part of the stream changes over training. Integrating a schedule gives the
words the stream has asked of the source up to a moment; inverting that gives,
for each document, the moment at which its words are due. Only DataFrame
functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexvane.storage import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3

# Moments of training (0 to 1) and how strong a source is at each of them,
# relative to its own mean; straight lines between. By weight class: the
# heaviest sources lead, the lightest come late.
CURRICULUM = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)

CELLS = 1024  # cells a level when summing up the documents of one source


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``(source, source_size)`` to the words wanted of each source.

    Sources by code point, null last, take the weights in turn. A target is
    ``min(3 * size, level * weight)``, where the level makes the targets sum up
    to all sizes: what sharing the excess again and again comes to. Sources
    reach their cap in order of cap per weight, so the level follows from
    running sums. The windows see one row a source, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    klass = (F.row_number().over(by_name) - 1) % len(weights)
    ranked = sizes.select("source", "source_size", weight.alias("weight"), klass.alias("weight_class"))
    ratio = MAX_REPEATS * F.col("source_size") / F.col("weight")
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    capped = (
        ranked.withColumn("ratio", ratio)
        .withColumn("rank", F.row_number().over(by_ratio))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("weight_total", F.sum("weight").over(everything))
        .withColumn("filled", F.coalesce(F.sum(MAX_REPEATS * F.col("source_size")).over(below), F.lit(0)))
        .withColumn("weight_filled", F.coalesce(F.sum("weight").over(below), F.lit(0.0)))
    )
    level = (F.col("total") - F.col("filled")) / (F.col("weight_total") - F.col("weight_filled"))
    # The first source in this order whose cap is above the level sets the level.
    fits = capped.withColumn("level", level).withColumn("open", F.col("ratio") >= F.col("level"))
    final = F.min(F.when(F.col("open"), F.struct("rank", "level"))).over(everything)["level"]
    return fits.withColumn("final_level", final).select(
        "source",
        "source_size",
        "weight_class",
        F.least(
            (MAX_REPEATS * F.col("source_size")).cast("double"),
            F.coalesce(F.col("final_level"), F.lit(float("inf"))) * F.col("weight"),
        ).alias("target"),
    )


def _pieces(schedule: tuple[tuple[float, float], ...]) -> list[tuple[float, float, float, float, float]]:
    """Straight pieces ``(t0, t1, w0, slope, share asked before t0)`` of a schedule, area 1."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    whole, before, pieces = sum(areas), 0.0, []
    for (t0, w0), (t1, w1), area in zip(schedule, schedule[1:], areas):
        pieces.append((t0, t1, w0 / whole, (w1 - w0) / (t1 - t0) / whole, before))
        before += area / whole
    return pieces


def due(share: Column, weight_class: Column, curriculum=CURRICULUM) -> Column:
    """The moment at which a source has been asked for ``share`` of its target.

    Inverts the integral of the schedule: on a piece the demand is
    ``before + w0 * x + slope * x * x / 2``, solved for x in the form that also
    holds for a slope of 0.
    """
    moment = F.lit(None).cast("double")
    for number, schedule in enumerate(curriculum):
        inside = F.lit(None).cast("double")
        for t0, t1, w0, slope, before in _pieces(schedule):
            need = F.greatest(share - before, F.lit(0.0))
            root = F.sqrt(F.greatest(w0 * w0 + 2 * slope * need, F.lit(0.0)))
            x = F.when(need > 0, 2 * need / (w0 + root)).otherwise(0.0)
            inside = F.when(share >= before, F.least(t0 + x, F.lit(t1))).otherwise(inside)
        moment = F.when(weight_class == number, inside).otherwise(moment)
    return moment


def row_key(docs: DataFrame) -> Column:
    """A number for a document row; equal rows share it."""
    return F.xxhash64(
        F.col("doc_id").isNull(), "doc_id", F.col("source").isNull(), "source", F.col("text").isNull(), "text"
    )


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, curriculum=CURRICULUM) -> DataFrame:
    """What the mix takes of each document, and when.

    ``docs`` has ``doc_id, text, source``; further columns are left out.
    Returns ``doc_id, source, size, source_size, target, taken, position, takes``
    where ``takes`` lists ``(position, words)`` of each copy, and ``position`` is
    the first of them; rows are range-sorted by position, untaken documents
    last. ``row_key, row_no`` tell rows apart: equal rows share a key and are
    numbered.

    A source's documents stand in hashed order. As many whole passes as fit are
    taken of all of them, the rest of the target from the front of one more
    pass, in which one document may be cut. So the words taken are the target
    rounded down. Documents without words are never taken (``taken`` 0). Null
    texts count 0 words, a null source is a source of its own, repeated rows
    count as documents of their own, an empty table gives an empty table.

    No task sees a whole source: words are summed in cells of the hashed order
    and in cells of cells, and only sums of 1024 cells meet in a window.
    """
    sized = written(
        docs.select(
            "doc_id",
            "source",
            word_count(F.col("text")).alias("size"),
            F.xxhash64("doc_id", F.lit(17)).alias("h"),
            row_key(docs).alias("row_key"),
        ),
        "mix-sizes",
    )
    sized = sized.withColumn("c1", F.pmod(F.shiftright("h", 20), F.lit(CELLS))).withColumn(
        "c2", F.pmod(F.shiftright("h", 8), F.lit(CELLS))
    )
    cells = written(
        sized.filter("size > 0").groupBy("source", "c1", "c2").agg(F.sum("size").alias("words")), "mix-cells"
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sources, weights), "mix-targets")

    up_to = (Window.unboundedPreceding, -1)
    coarse = cells.groupBy("source", "c1").agg(F.sum("words").alias("words"))
    first = Window.partitionBy("source").orderBy("c1").rowsBetween(*up_to)
    coarse = coarse.select(
        F.col("source").alias("s1"),
        F.col("c1").alias("k1"),
        F.coalesce(F.sum("words").over(first), F.lit(0)).alias("before1"),
    )
    second = Window.partitionBy("source", "c1").orderBy("c2").rowsBetween(*up_to)
    fine = cells.select(
        "source", "c1", "c2", F.coalesce(F.sum("words").over(second), F.lit(0)).alias("before2")
    )
    starts = fine.join(coarse, F.col("source").eqNullSafe(F.col("s1")) & (F.col("c1") == F.col("k1"))).select(
        F.col("source").alias("s2"),
        F.col("c1").alias("k1"),
        F.col("c2").alias("k2"),
        (F.col("before1") + F.col("before2")).alias("cell_start"),
    )
    third = Window.partitionBy("source", "c1", "c2").orderBy("h", "doc_id", "row_key")
    same = Window.partitionBy("source", "c1", "c2", "row_key").orderBy("doc_id")
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(third.rowsBetween(*up_to)), F.lit(0)))
    placed = placed.withColumn("row_no", F.row_number().over(same))
    placed = placed.join(
        starts,
        F.col("source").eqNullSafe(F.col("s2")) & (F.col("c1") == F.col("k1")) & (F.col("c2") == F.col("k2")),
        "left",
    ).drop("s2", "k1", "k2")
    known = targets.select(
        F.col("source").alias("s3"), "source_size", "target", "weight_class"
    )
    # One row a source: small enough for Spark to send it along, by its measured size.
    placed = placed.join(known, F.col("source").eqNullSafe(F.col("s3")), "left").drop("s3")
    return _taken(placed, curriculum)


def _taken(placed: DataFrame, curriculum) -> DataFrame:
    size, whole = F.col("size"), F.col("source_size")
    offset = F.coalesce(F.col("cell_start"), F.lit(0)) + F.col("inside")
    wanted = F.floor(F.col("target"))

    def copy(n: int) -> Column:
        start = offset + n * whole
        words = F.greatest(F.least(size, wanted - start), F.lit(0)).cast("long")
        share = (start + words / 2.0) / F.col("target")
        moment = due(F.least(share, F.lit(1.0)), F.col("weight_class"), curriculum)
        return F.when(words > 0, F.struct(moment.alias("position"), words.alias("words")))

    copies = F.filter(F.array(*[copy(n) for n in range(MAX_REPEATS)]), lambda c: c.isNotNull())
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda s, c: s + c["words"])
    out = placed.withColumn("takes", copies).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        F.get("takes", F.lit(0))["position"].alias("position"),
        "takes",
        "row_key",
        "row_no",
    )
    return out.repartitionByRange(F.col("position").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(
        F.col("position").asc_nulls_last(), "doc_id"
    )


def first_words(text: Column, words: Column) -> Column:
    """The text up to the end of its ``words``-th word, white space kept."""
    pieces = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")


def training_stream(docs: DataFrame, weights=WEIGHTS, curriculum=CURRICULUM) -> DataFrame:
    """The documents the mix takes, a row for each copy, sorted by position.

    Has the columns of ``docs``, whatever else they are. The one document of a
    source that the target cuts is shortened to the words taken. Documents not
    taken are left out. Decisions join back by row key, so whole rows are
    shuffled for that join and for the final sort only.
    """
    plan = mix_sources(docs, weights, curriculum).filter("taken > 0")
    plan = plan.select(
        F.col("row_key").alias("plan_key"), F.col("row_no").alias("plan_no"), F.col("size").alias("words"), "takes"
    )
    keyed = docs.select(row_key(docs).alias("row_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    numbered = Window.partitionBy("row_key").orderBy("row.doc_id")
    keyed = keyed.withColumn("row_no", F.row_number().over(numbered))
    joined = keyed.join(plan, (F.col("row_key") == F.col("plan_key")) & (F.col("row_no") - F.col("plan_no") == 0))
    copies = joined.select("row", "words", F.explode("takes").alias("copy"))
    cut = F.col("copy.words") < F.col("words")
    row = F.col("row").withField("text", F.when(cut, first_words(F.col("row.text"), F.col("copy.words"))).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(cut, F.length(row["text"]).cast("long")).otherwise(F.col("row.n_chars")))
    placed = copies.select(row.alias("row"), F.col("copy.position").alias("position"))
    place = [F.col("position"), F.col("row.doc_id")]
    return placed.repartitionByRange(*place).sortWithinPartitions(*place).select("row.*")
