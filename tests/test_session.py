from pathlib import Path

from telemill.session import scratch, scratch_dir


class Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class Session:
    def __init__(self, **values):
        self.conf = Conf({key.replace("_", "."): value for key, value in values.items()})


def test_scratch_is_below_the_folder_the_cluster_names():
    shared = Session(spark_checkpoint_dir="hdfs://cluster/shared/")
    first, second = (scratch_dir(shared, "x") for _ in range(2))
    assert first != second
    assert first.startswith("hdfs://cluster/shared/telemill/x-")


def test_scratch_without_such_a_folder_is_below_the_warehouse():
    own = Session(spark_sql_warehouse_dir="hdfs://cluster/warehouse")
    assert scratch_dir(own, "x").startswith("hdfs://cluster/warehouse/telemill/x-")


def test_scratch_is_dropped_after_use(spark, tmp_path):
    with scratch(spark, "gone") as folder:
        spark.range(3).write.parquet(folder)
        assert spark.read.parquet(folder).count() == 3
    assert not Path(folder.removeprefix("file:")).exists()
