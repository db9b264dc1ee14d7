import pytest
from pyspark.sql import functions as F

from siltstone import session


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_small_sides_get_a_hint(spark):
    assert hinted(session.small_side(spark.range(10)))
    assert not hinted(session.small_side(spark.range(11), max_rows=10))
    wide = spark.range(10).withColumn("t", F.repeat(F.lit("x"), F.lit(100)))
    assert not hinted(session.small_side(wide, max_bytes=500))
    nested = spark.range(10).withColumn("t", F.array(F.lit("abc")))
    assert hinted(session.small_side(nested)) and not hinted(session.small_side(nested, max_bytes=100))


def test_materialised_tables_lie_in_the_shared_folder(spark):
    df = session.materialise(spark.range(5))
    root = session.checkpoint_root(spark)
    assert df.count() == 5 and all(root.removeprefix("file:") in f for f in df.inputFiles())


def test_a_cluster_needs_the_setting(spark):
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_discarded_tables_leave_no_files(spark):
    from siltstone import files
    from siltstone.session import discard, materialise

    first = materialise(spark.range(5), "first")
    second = materialise(first.where("id > 1"), "second")
    discard(first)
    assert not files.exists(spark, first._folder) and second.count() == 3
    discard(second)
