from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from quire.session import bytes_of, shared_dir, small, stored


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))
    assert shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: "hdfs://x/"), sparkContext=context)) == "hdfs://x"


def test_broadcasts_are_bounded_by_rows_and_bytes(spark):
    df = stored(spark.range(100).select("id", F.repeat(F.lit("x"), 1_000).alias("s"), F.array("id", "id").alias("a")))
    assert 100_000 < bytes_of(df) < 120_000
    assert small(df) is not df and small(df, rows=99) is df and small(df, size=90_000) is df and small(df.limit(0)) is not df
