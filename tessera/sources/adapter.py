"""Adapter: benchmark star-schema tables -> the raw 16-column transaction record.

One row per ``lineitem`` row:  lineitem ⋈ orders ⋈ supplier ⋈ nation ⋈ region ⋈ part.

The driving lineitem scan is spread over the task slots when it has fewer input
splits than slots (``tables.spread``; a no-op on large inputs).

Join strategy: nation (25 rows) and region (5 rows) have a fixed size by the
benchmark's definition and are broadcast explicitly. supplier, orders and part grow
with the data: Catalyst broadcasts each only while its file-size statistics are under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise plans a sort-merge join (AQE
splits skewed keys). At 100 TB orders and part are far above the threshold, so
lineitem ⋈ orders is the one big shuffle join. Whatever depends on one table only (date,
purpose, scores, inflow) is worked out before the joins where that takes fewer bytes to shuffle.

Deterministic "dirt" (null IDs, unparseable dates, messy city spelling, null districts,
negative values, zero areas) is injected by key arithmetic so the cleaning steps have
something to remove.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.exprs import dbl
from tessera.schema import ADAPTER_ORDER_COLUMNS, RAW_COLUMNS
from tessera.sources.tables import spread, table

# ── FIXED VALUES: dirt rules (modulus on the part / supplier key) ───────────────
ADAPTER_TABLES = ["lineitem", "orders", "part", "supplier", "nation", "region"]
NULL_ID_MOD = 97          # Transaction_ID null
BAD_DATE_MOD = 89         # Date = 'not-a-date'
MESSY_CITY_MOD = 7        # City = '  <lower case> '   (on the supplier key)
NULL_DISTRICT_MOD = 73    # District null
NEGATIVE_VALUE_MOD = 83   # Transaction_Value = -1000
ZERO_AREA_MOD = 79        # Area_sqm = 0
# ──────────────────────────────────────────────────────────────────────────────


def raw_transactions(spark: SparkSession, sf_dir: str, with_order: bool = True, in_order: bool = False) -> DataFrame:
    """The raw record (16 columns, in order) plus the input-order columns
    ``l_partkey, l_suppkey, l_extendedprice`` when ``with_order``. ``in_order``: sorted by
    them; the rows are dealt in ranges before names and derived columns are there."""
    purpose = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2).otherwise(0).cast("tinyint")
    # integers and small doubles in turn: the zero bytes of neighbours make one run for the compression
    li = spread(table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_suppkey", "l_quantity", "l_linenumber",
        F.round(F.col("l_discount") * 100.0, 0).alias("__demand"), purpose.alias("__purpose"),
        F.round(F.col("l_tax") * 100.0, 0).alias("__supply"), F.col("l_shipdate").cast("date").alias("__shipped")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 100.0).alias("__inflow"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    # Each join's right side is a base table, so Catalyst's broadcast decision sees
    # that table's own (file-size) statistics; a pre-joined supplier⋈nation⋈region
    # would be estimated as a product of sizes and never broadcast. orders and part, which
    # shuffle the line items, come first: the names are not there yet to be shuffled.
    j = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(part, F.col("l_partkey") == F.col("p_partkey"))
           .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))
    if in_order:
        j = j.repartitionByRange(*ADAPTER_ORDER_COLUMNS)
    j = (j.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
           .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")))

    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    ship = F.col("__shipped").cast("string")
    cols = {
        "Transaction_ID": F.when(pk % NULL_ID_MOD == 0, F.lit(None).cast("string")).otherwise(
            F.concat(F.substring("r_name", 1, 3), F.lit("-"), F.col("l_orderkey").cast("string"),
                     F.lit("-"), F.col("l_linenumber").cast("string"))),
        "Date": F.when(pk % BAD_DATE_MOD == 0, F.lit("not-a-date")).otherwise(ship),
        "City": F.when(sk % MESSY_CITY_MOD == 0,
                       F.concat(F.lit("  "), F.lower("r_name"), F.lit(" "))).otherwise(F.col("r_name")),
        "District": F.when(pk % NULL_DISTRICT_MOD == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")),
        "Property_Type": F.col("p_type"),
        "Transaction_Value": F.when(pk % NEGATIVE_VALUE_MOD == 0, dbl(-1000)).otherwise(
            F.round(F.col("l_extendedprice") * 50.0, 0)),
        "Area_sqm": F.when(pk % ZERO_AREA_MOD == 0, dbl(0)).otherwise(F.col("l_quantity") * 10.0),
        "Number_of_Units": F.col("l_linenumber").cast("int"),
        "Contract_Duration": F.col("p_size").cast("int"),
        "Purpose": F.when(F.col("__purpose") == 1, "Sale").when(F.col("__purpose") == 2, "Rent").otherwise("Investment"),
        "Demand_Score": F.col("__demand"),
        "Supply_Score": F.col("__supply"),
        "Interest_Rate": F.col("p_size").cast("double") / 1000.0,
        "Infrastructure_Distance_KM": F.col("p_size").cast("double") / 10.0,
        "Population_Migration_Inflow": F.col("__inflow").cast("int"),
        "Vacancy_Rate": F.round(F.col("p_retailprice") - 900.0, 1) / 500.0,
    }
    out = [cols[c].alias(c) for c in RAW_COLUMNS]
    if in_order:
        # a sort before the joins would be optimised away; the ranges hold through them
        ranked = j.select(*out, *ADAPTER_ORDER_COLUMNS).sortWithinPartitions(*ADAPTER_ORDER_COLUMNS)
        return ranked if with_order else ranked.drop(*ADAPTER_ORDER_COLUMNS)
    if with_order:
        out += [F.col(c) for c in ADAPTER_ORDER_COLUMNS]
    return j.select(*out)
