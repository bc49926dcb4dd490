import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.schema import RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-test-ckpt-", dir="/tmp"))
    yield s


CLEAN_ROWS = [
    ("RIY-001", "2023-01-15", "Riyadh", "Al Olaya", "Apartment", 850000.0, 120.0, 1, 12, "Sale", 7.5, 5.0, 0.045, 1.2, 1500, 0.08),
    ("DAM-002", "2023-06-20", "Dammam", "Al Shula", "Villa", 1200000.0, 380.0, 1, 0, "Sale", 6.2, 4.8, 0.050, 3.4, 800, 0.12),
    ("JED-003", "2024-03-10", "Jeddah", "Al Hamra", "Duplex", 950000.0, 200.0, 2, 24, "Rent", 8.1, 6.0, 0.042, 0.8, 2200, 0.05),
    ("KHO-004", "2024-07-05", "Khobar", "Al Khobar Al Shamaliyya", "Studio", 500000.0, 55.0, 1, 12, "Rent", 5.9, 3.5, 0.048, 2.1, 600, 0.15),
    ("JUB-005", "2025-01-01", "Jubail", "Al Fanateer", "Land", 2500000.0, 600.0, 1, 0, "Investment", 4.3, 7.0, 0.055, 8.5, 300, 0.20),
]


def with_order(rows):
    """Append an input ordinal (source position) used by keep-first dedup."""
    return [r + (i,) for i, r in enumerate(rows)]


@pytest.fixture
def sample_df(spark):
    return spark.createDataFrame(CLEAN_ROWS, RAW_SCHEMA)


@pytest.fixture
def dirty_df(spark):
    rows = [list(r) for r in CLEAN_ROWS]
    rows[0][5] = -1000.0        # negative value
    rows[1][6] = 0.0            # zero area
    rows[2][0] = None           # null ID
    rows[3][0] = "DAM-002"      # duplicate of row 1
    return spark.createDataFrame([tuple(r) for r in rows], RAW_SCHEMA)


def ordered(spark, rows):
    from pyspark.sql import types as T
    schema = T.StructType(list(RAW_SCHEMA.fields) + [T.StructField("ordinal", T.LongType())])
    return spark.createDataFrame(with_order(rows), schema)
