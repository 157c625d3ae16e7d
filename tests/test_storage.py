import pytest

from lexvane import storage as S


class Session:
    """Stands for a session; only its settings are looked at."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_the_named_folder_is_used():
    named = Session(spark_checkpoint_dir="hdfs://x/dir/", spark_master="spark://h:7077")
    assert S.shared_dir(named) == "hdfs://x/dir"
    assert S.new_path(named, "t") != S.new_path(named, "t")


def test_only_local_sessions_get_their_own():
    local = Session(spark_master="local[2]", spark_app_id="a")
    assert S.shared_dir(local) == S.shared_dir(local)
    assert S.shared_dir(Session(spark_master="local", spark_app_id="b")) != S.shared_dir(local)
    with pytest.raises(ValueError):
        S.shared_dir(Session(spark_master="yarn"))


def test_written_and_spread(spark):
    df = S.written(spark.range(10).coalesce(1), "numbers")
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().executedPlan().toString()
    assert S.spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 8
    many = spark.range(0, 100, 1, 20)
    assert S.spread(many) is many
