import os
import re

import pytest

from cadence.session import cut_lineage, ensure_checkpoint_dir, get_spark, materialised


def _path(uri: str) -> str:
    return re.sub(r"^file:/+", "/", uri)


def test_cut_lineage_writes_under_the_checkpoint_folder(spark):
    root = ensure_checkpoint_dir(spark)
    assert root and root == spark.sparkContext.getCheckpointDir()
    df = cut_lineage(spark.range(10).withColumnRenamed("id", "k"))
    files = df.inputFiles()
    assert files and all(_path(f).startswith(_path(root).rstrip("/") + "/tables/") for f in files)
    assert sorted(r.k for r in df.collect()) == list(range(10))


def test_materialised_tables_are_deleted_after_use(spark):
    with materialised(spark.range(5)) as df:
        files = [_path(f) for f in df.inputFiles()]
        assert df.count() == 5 and all(map(os.path.exists, files))
    assert not any(map(os.path.exists, files))


class _Context:
    """What ``ensure_checkpoint_dir`` looks at, of a session without a checkpoint folder."""

    def __init__(self, master):
        self.master, self.conf = master, self

    sparkContext = property(lambda self: self)

    def get(self, key, default=None):
        return default

    def getConf(self):
        return self

    def getCheckpointDir(self):
        return None


def test_no_machine_local_folder_on_a_cluster():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(_Context(master))


def test_get_spark_keeps_values_that_are_set(spark):
    before = spark.sparkContext.getConf().get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert get_spark("other").conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
        assert get_spark("other").conf.get("spark.sql.shuffle.partitions") == before
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
