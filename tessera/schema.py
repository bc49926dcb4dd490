"""Record layout and fixed domain values.

Everything under "FIXED VALUES" must equal the values of the original pipeline for
results to match; they are stated once here and imported everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw 16-column transaction record. Parse-risky columns stay strings at the bronze
# boundary (Date), everything else is typed explicitly — no schema inference.
RAW_SCHEMA = T.StructType([
    T.StructField("Transaction_ID", T.StringType()),
    T.StructField("Date", T.StringType()),
    T.StructField("City", T.StringType()),
    T.StructField("District", T.StringType()),
    T.StructField("Property_Type", T.StringType()),
    T.StructField("Transaction_Value", T.DoubleType()),
    T.StructField("Area_sqm", T.DoubleType()),
    T.StructField("Number_of_Units", T.IntegerType()),
    T.StructField("Contract_Duration", T.IntegerType()),
    T.StructField("Purpose", T.StringType()),
    T.StructField("Demand_Score", T.DoubleType()),
    T.StructField("Supply_Score", T.DoubleType()),
    T.StructField("Interest_Rate", T.DoubleType()),
    T.StructField("Infrastructure_Distance_KM", T.DoubleType()),
    T.StructField("Population_Migration_Inflow", T.IntegerType()),
    T.StructField("Vacancy_Rate", T.DoubleType()),
])
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Columns that define the input order of the adapter rows (ties in Transaction_ID are
# broken by them; "keep first" dedup means smallest in this order).
ADAPTER_ORDER_COLUMNS = ["l_partkey", "l_suppkey", "l_extendedprice"]

# ── FIXED VALUES ──────────────────────────────────────────────────────────────
# Columns whose null (or unparseable date) drops the row in the ETL.
CRITICAL_COLUMNS = ["Transaction_ID", "Date", "City", "Property_Type", "Transaction_Value"]
# String columns that are stripped and title-cased.
STANDARDISED_COLUMNS = ["City", "District", "Property_Type", "Purpose"]
# Value bands: edges in SAR and labels.
BAND_EDGES = [500_000, 1_000_000, 2_000_000, 5_000_000]
BAND_LABELS = ["<500K", "500K-1M", "1M-2M", "2M-5M", ">5M"]
# Outlier cap percentiles.
CLIP_LOW, CLIP_HIGH = 0.01, 0.99
# Surrogate keys: md5 as a 128-bit integer, modulo this.
KEY_MODULUS = 10**6
# High-demand thresholds: the Spark job uses > 5, the mart uses > 7.
SPARK_HIGH_DEMAND = 5
MART_HIGH_DEMAND = 7.0
# Layered-model variables.
# Domains of the data-quality suite.
VALID_CITIES = ["Riyadh", "Jeddah", "Dammam", "Khobar", "Jubail"]
VALID_PROPERTY_TYPES = ["Apartment", "Villa", "Duplex", "Studio", "Commercial Unit", "Land"]
VALID_PURPOSES = ["Sale", "Rent", "Investment"]
# Data-quality suite: expected dataset size and its tolerance, date window.
EXPECTED_ROWS, ROW_TOLERANCE = 1_000_000, 0.01
DQ_MIN_DATE, DQ_MAX_DATE = "2020-01-01", "2026-12-31"
DATASET_NAME = "Housing_Market_SA_1M"
# Anomaly threshold on |z|.
Z_THRESHOLD = 3.0
# Dashboard fallback sample size.
FALLBACK_SAMPLE_ROWS = 50_000
# Chunk size of the chunked CSV read.
CHUNK_ROWS = 200_000
# Weekend days for dim_date, Monday = 0 (the original defines none; Saturday, Sunday).
WEEKEND_DAYS = [5, 6]
# Text tokens read as missing values in raw string columns.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# ──────────────────────────────────────────────────────────────────────────────
