"""Streams against dictionaries that are met through their index."""

import pytest
from pyspark.sql import functions as F

from lexvane.operators.match import TermSet, dictionary_flag, file_sets, flag_sets
from lexvane.sources.terms import newest_version, publish_terms, version_terms
from lexvane.streaming.scoring import match_batches, write_available, write_matches
from workload import tables as T

WORDS = [f"term{i:04d}x" for i in range(300)] + ["two words", "ab"]


@pytest.fixture()
def texts(spark):
    rows = [(i, f"seen Term{i * 7 % 900:04d}X, used here") for i in range(90)]
    rows += [(None, "two  words"), (5, ""), (5, None), (7, "cab used"), (None, "nothing " * 3000)]
    return spark.createDataFrame(rows, "id long, text string")


def matched(spark, texts, folder, version):
    terms = version_terms(spark, folder, version)
    return dictionary_flag(texts, terms, "id", "text", plan="indexed").select("id", "malware_flag")


def counted(df):
    return sorted(map(repr, df.groupBy(df.columns).count().collect()))


def test_stream_gives_the_flags_of_the_table(spark, texts, tmp_path):
    folder, source, out = (str(tmp_path / n) for n in ("terms", "in", "out"))
    assert publish_terms(spark.createDataFrame([(w,) for w in WORDS], "term string"), folder) == 1
    texts.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    write_matches(stream, match_batches(folder, out, "id", "text", ("used",)), out + "-state").awaitTermination()
    got = spark.read.parquet(out)
    assert got.select("batch").distinct().count() == 3
    assert counted(got.select("id", "malware_flag")) == counted(matched(spark, texts, folder, 1))
    words = got.filter("has_info_keywords = 1").count()
    assert words == texts.filter(F.lower("text").contains("used")).count()


def test_index_plan_has_no_nested_loop(spark, texts):
    one = TermSet("hit", spark.createDataFrame([(w,) for w in WORDS if " " not in w and len(w) > 3], "term string"), "text", clean=True)
    filed = file_sets([one])
    assert filed[0].plan == "indexed"
    plan = flag_sets(texts, [one], ["id"], None, filed)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_failed_batch_is_replayed_once_by_the_newest_version(spark, texts, tmp_path):
    folder, source, out = (str(tmp_path / n) for n in ("terms", "in", "out"))
    publish_terms(spark.createDataFrame([(w,) for w in WORDS], "term string"), folder)
    texts.repartition(2).write.parquet(source)
    stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    write, seen = match_batches(folder, out, "id", "text", ("used",)), []

    def lost(rows, number):
        write(rows, number)
        seen.append(number)
        if number == 1:
            raise RuntimeError("lost after the batch was written")

    with pytest.raises(Exception, match="lost after"):
        write_matches(stream, lost, out + "-state").awaitTermination()
    assert seen == [0, 1] and spark.read.parquet(out).count() == texts.count()
    publish_terms(spark.createDataFrame([("nothing",)], "term string"), folder)
    assert newest_version(spark, folder) == 2
    write_matches(stream, match_batches(folder, out, "id", "text", ("used",)), out + "-state").awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == texts.count()
    assert {tuple(r) for r in got.select("batch", "dictionary_version").distinct().collect()} == {(0, 1), (1, 2)}
    # Only the long text without an id holds the word of the second version.
    assert all(r["id"] is None for r in got.filter("batch = 1 and malware_flag = 1").collect())


@pytest.mark.parametrize("files", [1, 3])
def test_table_of_several_files_is_streamed(spark, texts, tmp_path, files):
    """A table may be a folder of files; a stream of it used to find none of them."""
    named = texts.withColumnRenamed("id", "doc_id")
    named.repartition(files).write.parquet(str(tmp_path / "documents.parquet"))
    stream, out = T.stream(spark, str(tmp_path), "documents"), str(tmp_path / "out")
    write_available(stream, out, out + "-state").awaitTermination()
    assert counted(spark.read.parquet(out)) == counted(named)
