"""Scans of the given Parquet tables and of warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.sinks.versioned import VersionedTable


# Known layouts of the benchmark tables this engine reads. Declaring them skips the
# schema-inference job (a footer read per table) that every query would otherwise run.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``{sf_dir}/{name}.parquet`` — a columnar scan; Catalyst prunes columns and
    pushes filters into it. Known tables are read with their declared schema."""
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_state(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple:
    """(path, size, modification time) of every file of the tables ``names``: equal states
    mean unchanged inputs."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            files = fs.listFiles(path, True)
            while files.hasNext():
                f = files.next()
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over the cluster when it yields fewer input splits than there
    are task slots (e.g. one file with one row group): everything up to the first
    shuffle would otherwise run in one task. On a large multi-file input the scan
    already has far more splits than slots and this is a no-op."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def scan_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a warehouse table: the latest version of a versioned table, or any other folder
    (Parquet by default, partition discovery on)."""
    stored = VersionedTable(spark, path)
    return stored.read() if stored.versions() else spark.read.format(fmt).load(path)


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row DataFrame (partial counts per task, one final sum)."""
    from pyspark.sql import functions as F
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
