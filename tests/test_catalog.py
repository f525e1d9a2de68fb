"""Every query against its SQL, on the smallest test folder (set ORACLE_SF_DIR for another)."""

import os

import pytest

from corpusloom.catalog import QUERIES
from tests.oracle import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, name):
    query = QUERIES[name]
    result = query.run(spark, SF_DIR)
    rows, problem = compare(result, tables, query.sql)
    assert problem is None and rows > 0


def test_one_row_group_is_spread(spark, tmp_path):
    """A file is cut by size, but its only row group goes to one split: the others are empty."""
    from pyspark.sql import functions as F

    from corpusloom.catalog import inputs

    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name, files in (("one", 1), ("many", 16)):
            rows.repartition(files, "doc_id").write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1000")
        cores = spark.sparkContext.defaultParallelism
        for name, few in (("one", True), ("many", False)):
            read = inputs.table(spark, str(tmp_path / name), "documents")
            assert read.rdd.getNumPartitions() >= cores and inputs.few_splits(read) is few
        held = inputs.documents(spark, str(tmp_path / "one")).groupBy(F.spark_partition_id()).count().collect()
        assert len(held) > cores and sum(r["count"] for r in held) == 4000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
