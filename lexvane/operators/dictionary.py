"""Building and shrinking the term dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexvane.functions.aliases import alias_terms
from lexvane.functions.text import clean_text, normalize_name, strip
from lexvane.operators.entities import malware_spans, unpivot_entities
from lexvane.storage import written

# Lengths of the runs that terms are filed under.
HEADS = (1, 2, 4, 8, 16, 32)


def malware_names(reports: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """Distinct stripped malware span texts ``(name)`` of wide reports."""
    mentions = unpivot_entities(reports, id_col, ("label", "start", "end"), (text_col,))
    return names_of_mentions(mentions, text_col)


def names_of_mentions(mentions: DataFrame, text_col: str = "text") -> DataFrame:
    """Distinct stripped malware span texts ``(name)`` of a mentions table with text."""
    return malware_spans(mentions, text_col).filter(F.col("name") != "").select("name").distinct()


def base_terms(names: DataFrame, min_length: int = 4) -> DataFrame:
    """Distinct normalized names ``(term)`` of at least ``min_length`` characters."""
    terms = names.select(normalize_name(F.col("name")).alias("term"))
    return terms.filter(F.length("term") >= min_length).distinct()


def _answered(names: DataFrame, answers: DataFrame, min_length: int) -> DataFrame:
    """Long-enough names with the alias array of each of their answers (null: lookup failed)."""
    asked = names.filter(F.length("name") >= min_length)
    given = answers.select("name", alias_terms(F.col("content"), min_length).alias("aliases"))
    return asked.join(given, "name", "left")


def alias_expansion(names: DataFrame, answers: DataFrame, min_length: int = 4) -> DataFrame:
    """Distinct alias terms ``(term)`` of names, looked up in ``answers(name, content)``."""
    found = _answered(names, answers, min_length)
    terms = found.select(F.explode_outer("aliases").alias("term"))
    return terms.filter(F.col("term").isNotNull()).distinct()


def expand_terms(terms: DataFrame, aliases: DataFrame) -> DataFrame:
    """Union of base terms and alias terms without repeats."""
    return terms.select("term").union(aliases.select("term")).distinct()


def build_terms(
    names: DataFrame, answers: DataFrame | None = None, min_length: int = 4
) -> DataFrame:
    """Dictionary ``(term)`` of names, widened by alias answers if given."""
    terms = base_terms(names, min_length)
    if answers is None:
        return terms
    return expand_terms(terms, alias_expansion(names, answers, min_length))


def alias_quality(names: DataFrame, answers: DataFrame, min_length: int = 4) -> DataFrame:
    """One row: names asked, answered, failed, and terms the aliases added."""
    found = _answered(names, answers, min_length)
    per_name = found.groupBy("name").agg(F.max(F.col("aliases").isNotNull()).alias("ok"))
    counts = per_name.agg(
        F.count(F.lit(1)).alias("asked"),
        F.count_if("ok").alias("successful"),
        F.count_if(~F.col("ok")).alias("failed"),
    )
    added = alias_expansion(names, answers, min_length).join(
        base_terms(names, min_length), "term", "left_anti"
    )
    return counts.withColumn("newly_added", added.agg(F.count(F.lit(1))).scalar())


def term_counters(terms: DataFrame) -> DataFrame:
    """One row: usable terms, blank terms, and distinct usable terms."""
    term = strip(F.coalesce(F.col("term"), F.lit("")))
    return terms.select(term.alias("t")).agg(
        F.count_if(F.col("t") != "").alias("valid_terms"),
        F.count_if(F.col("t") == "").alias("skipped_terms"),
        F.countDistinct(F.when(F.col("t") != "", F.col("t"))).alias("dictionary_size"),
    )


def usable_terms(terms: DataFrame) -> DataFrame:
    """Distinct stripped terms, without blank ones."""
    return (
        terms.select(strip(F.col("term")).alias("term"))
        .filter(F.col("term") != "")
        .distinct()
    )


def terms_as_text(terms: DataFrame) -> DataFrame:
    """Terms cleaned the way texts are, so that punctuation does not stop a match."""
    cleaned = terms.select(clean_text(F.col("term")).alias("term"))
    return cleaned.filter(F.col("term") != "").distinct()


def _holding_candidates(kept: DataFrame) -> DataFrame:
    """``(term, part)``: pairs in which a term may hold another one, ``part``.

    A run of as many characters as a power of two allows is taken from every
    part, the one that the fewest terms have; terms meet it by their own runs.
    So neither common beginnings nor other common pieces gather many terms.
    """
    size = F.lit(HEADS[0])
    for n in HEADS[1:]:
        size = F.when(F.length("term") >= n, n).otherwise(size)
    sizes = [r[0] for r in kept.select(size.alias("n")).distinct().collect()]  # at most as many as HEADS
    if not sizes:
        return kept.select("term", F.col("term").alias("part"))
    lengths = kept.select("term", F.explode(F.array(*map(F.lit, sorted(sizes)))).alias("n"))
    places = F.sequence(F.lit(1), F.length("term") - F.col("n") + 1)
    runs = (
        lengths.filter(F.col("n") <= F.length("term"))
        .select("term", "n", F.explode(places).alias("i"))
        .select("term", "n", F.substring(F.col("term"), F.col("i"), F.col("n")).alias("run"))
        .distinct()
    )
    runs = written(runs, "runs")
    occurs = runs.groupBy("n", "run").agg(F.count(F.lit(1)).alias("occurs"))
    own = runs.filter(F.col("n") == size).join(occurs, ["n", "run"])
    rarest = own.groupBy(F.col("term").alias("part")).agg(F.min_by(F.struct("n", "run"), F.struct("occurs", "run")).alias("r"))
    filed = rarest.select("part", "r.n", "r.run")
    return runs.join(filed, ["n", "run"]).filter(F.col("term") != F.col("part")).select("term", "part")


def minimal_terms(terms: DataFrame, on_clean_text: bool = True, whole_word: bool = False) -> DataFrame:
    """A smaller dictionary that flags the same texts.

    Leaves out terms that can never occur in cleaned text, and terms holding
    another term: whatever they hit, the shorter one hits too. The work grows
    with the lengths of the terms, also where many begin alike.
    """
    kept = usable_terms(terms)
    if on_clean_text:
        kept = kept.filter(F.col("term") == clean_text(F.col("term")))
    held = [F.concat(F.lit(" "), F.col(c), F.lit(" ")) if whole_word else F.col(c) for c in ("term", "part")]
    holding = _holding_candidates(kept).filter((F.col("term") != F.col("part")) & F.contains(*held))
    return kept.join(holding.select("term").distinct(), "term", "left_anti")
