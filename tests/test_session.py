import pytest

from tracklane import session


def test_the_named_folder_is_used(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before is None:
        assert session.shared_folder(spark) == spark.sparkContext.getCheckpointDir()
    else:
        assert session.shared_folder(spark) == before
        assert spark.sparkContext.getCheckpointDir().split(":")[-1].startswith(before)
    one, two = session.scratch_path(spark, "t"), session.scratch_path(spark, "t")
    assert one != two and one.startswith(session.shared_folder(spark).rstrip("/"))


def test_settled_rows_do_not_change(spark):
    from pyspark.sql import functions as F

    settled = session.settle(spark.range(5).select(F.rand().alias("v")))
    assert settled.collect() == settled.collect()


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_stages_stay_within_what_the_compiler_takes(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
