"""Quality rules: does a text look like its language?

Base rules look at length and repetition. The verdict compares a document's
histograms of character classes and of common words with those of its language,
by Jensen-Shannon distance. References are means over the documents of the
language that pass the base rules. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexvane.storage import written

WORD = r"[^\x20\x09-\x0D]+"

# The most common words of the languages compared.
COMMON = {
    "en": "the of and to a in is that it for on was with be as by this are at from",
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als",
    "fr": "de la le et les des en un du une que est pour qui dans sur par au pas avec",
    "es": "de la que el en y los se del las un por con no una para su al es lo",
}
# Character classes; what is in none of them is the last class.
CLASSES = (r"\p{Lu}", r"\p{Ll}", r"\p{Nd}", r"\x20\x09-\x0D", r"#*$%&|<>", r".,;:'\x22()?!\-")

MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.27
MIN_CLASS_CHARS = 200  # shorter texts have no reliable histogram of classes
MIN_WORDS = 100  # nor, below this, of common words
SEND_ROWS = 10_000  # references sent along with the documents at most
N_CLASSES, N_WORDS = len(CLASSES) + 1, 21


def _kept_chars(text: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words inside 3-word windows whose hash occurs again, given window hashes.

    Sorted by hash, equal windows are neighbours; sorted by place, a window adds
    the words that the one before does not cover.
    """
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    named = F.transform(
        F.array_repeat(placed, 1),
        lambda s: F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        s,
                        lambda x, j: F.when(
                            (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"]
                        ),
                    ),
                    lambda i: i.isNotNull(),
                ),
                lambda i: i,
            )
        ),
    )
    places = F.get(named, F.lit(0))
    covered = F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    distinct = F.size(F.array_distinct(hashes))
    return F.when(distinct == F.size(hashes), F.lit(0).cast("long")).otherwise(covered)


def document_counts(docs: DataFrame, common: dict[str, str] = COMMON) -> DataFrame:
    """Counts of every document: base figures and both histograms.

    Everything is computed inside the row; nothing is shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "lang", text.alias("text"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    lists = F.create_map(*[x for k, v in common.items() for x in (F.lit(k), F.array(*[F.lit(t) for t in v.split()]))])
    windows = F.when(
        F.size("w") >= 3,
        F.transform(
            F.slice("w", F.lit(1), F.greatest(F.size("w") - 2, F.lit(1))),
            lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    rows = rows.select(
        "doc_id",
        "lang",
        F.length("text").cast("long").alias("n_chars"),
        F.size("w").cast("long").alias("n_words"),
        F.array(*[_kept_chars(F.col("text"), c) for c in CLASSES]).alias("known"),
        lines.alias("lines"),
        windows.alias("windows"),
        F.coalesce(lists[F.col("lang")], F.array().cast("array<string>")).alias("list"),
        "w",
    )
    hits = F.filter(F.transform("w", lambda x: F.lower(x)), lambda x: F.array_contains(F.col("list"), x))
    rows = rows.withColumn("hits", F.when(F.size("list") > 0, hits).otherwise(F.array().cast("array<string>")))

    def times(i: int) -> Column:
        term = F.get("list", F.lit(i))
        return F.when(term.isNull(), 0).otherwise(F.size("hits") - F.size(F.array_remove("hits", term))).cast("long")

    rest = F.col("n_chars") - sum((F.get("known", F.lit(i)) for i in range(len(CLASSES))), F.lit(0))
    return rows.select(
        "doc_id",
        "lang",
        "n_words",
        "n_chars",
        (F.col("n_chars") - F.get("known", F.lit(3))).alias("word_chars"),
        F.get("known", F.lit(4)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w"), F.col("windows")).alias("n_repeat_words"),
        F.concat("known", F.array(rest)).alias("classes"),
        F.concat(F.array(*[times(i) for i in range(N_WORDS - 1)]), F.array(F.col("n_words") - F.size("hits"))).alias("words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two share arrays of equal length."""

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def language_references(counts: DataFrame) -> DataFrame:
    """``lang, ref_classes, ref_words``: mean shares over the passing documents of a language.

    Every document weighs the same. Sums are merged before the shuffle, so a
    language with most of the documents is no burden.
    """
    shares = counts.filter(~base_failed()).select(
        "lang", _shares(F.col("classes")).alias("c"), _shares(F.col("words")).alias("t")
    )
    sums = shares.groupBy("lang").agg(
        *[F.avg(F.get("c", F.lit(i))).alias(f"c{i}") for i in range(N_CLASSES)],
        *[F.avg(F.get("t", F.lit(i))).alias(f"t{i}") for i in range(N_WORDS)],
    )
    return sums.select(
        F.col("lang").alias("ref_lang"),
        F.array(*[f"c{i}" for i in range(N_CLASSES)]).alias("ref_classes"),
        F.array(*[f"t{i}" for i in range(N_WORDS)]).alias("ref_words"),
    )


def judge_quality(
    docs: DataFrame,
    common: dict[str, str] = COMMON,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Base figures, distances and verdict of every document.

    ``docs`` has ``doc_id, text, lang``; further columns are left out. Null
    texts have no words and fail the base rules; a null language is a language
    of its own, and one without a word list is judged by character classes
    only. Texts under 200 characters (100 words) have no class (word) distance
    and are not rejected by it. Repeated rows stay, an empty table stays empty.
    """
    counts = written(document_counts(docs, common), "quality-counts")
    references = written(language_references(counts), "quality-references")
    if references.count() <= SEND_ROWS:
        references = F.broadcast(references)
    joined = counts.join(references, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    listed = F.coalesce(F.col("lang").isin(*common), F.lit(False))
    by_class = F.when(F.col("n_chars") >= MIN_CLASS_CHARS, distance(_shares(F.col("classes")), F.col("ref_classes")))
    by_word = F.when((F.col("n_words") >= MIN_WORDS) & listed, distance(_shares(F.col("words")), F.col("ref_words")))
    far = (F.coalesce(by_class, F.lit(0.0)) > max_class_distance) | (F.coalesce(by_word, F.lit(0.0)) > max_word_distance)
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & ~far).alias("kept"),
        by_class.alias("class_distance"),
        by_word.alias("word_distance"),
    )
