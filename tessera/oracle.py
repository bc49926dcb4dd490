"""Independent SQL statements (DuckDB dialect) for every registered query.

They are written from the semantics, not generated from the Spark plans, and run
on the same Parquet tables (views ``lineitem``, ``orders``, ... are registered by
the checker). Shared CTEs are plain strings joined into a WITH clause.

Conventions that keep both engines bit-identical:
* per-row and per-group rounding goes through the decimal text and DECIMAL(28,8);
* every output column is cast explicitly (int / bigint / double / varchar / date).
"""

from __future__ import annotations

from tessera.schema import (BAND_EDGES, BAND_LABELS, CLIP_HIGH, CLIP_LOW, KEY_MODULUS,
                            MART_HIGH_DEMAND, RAW_COLUMNS, SPARK_HIGH_DEMAND)
from tessera.sources.adapter import (BAD_DATE_MOD, MESSY_CITY_MOD, NEGATIVE_VALUE_MOD,
                                     NULL_DISTRICT_MOD, NULL_ID_MOD, ZERO_AREA_MOD)


def R(x: str, n: int) -> str:
    """Half away from zero on the number's shortest decimal text, cut to eight places
    first (DuckDB rounds DECIMAL half away from zero); from 1e19 on unchanged."""
    d = f"CAST(({x}) AS DOUBLE)"
    return f"(CASE WHEN abs({d}) < 1e19 THEN CAST(round(CAST(CAST({d} AS VARCHAR) AS DECIMAL(28,8)), {n}) AS DOUBLE) ELSE {d} END)"


def RA(x: str, n: int) -> str:
    """Aggregated value: the eight places drop summation-order noise."""
    return R(x, n)


def RATIO(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def TITLE(x: str) -> str:
    """Python-style title case: upper first letter of each run of letters, rest lower."""
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
            f"lambda r: upper(r[1:1]) || lower(r[2:])), '')")


WS = "[\\s\\x0b\\x1c-\\x1f\\x85\\xa0]"


def STRIP(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def INITCAP_TRIM(x: str) -> str:
    """initcap(trim(x)): words split on single spaces, first letter up, rest down."""
    return (f"array_to_string(list_transform(string_split(lower(trim({x}, ' ')), ' '), "
            f"lambda w: upper(w[1:1]) || w[2:]), ' ')")


def MD5MOD(x: str, m: int = KEY_MODULUS) -> str:
    parts = []
    for i in range(4):
        w = pow(2, 32 * (3 - i), m)
        parts.append(f"((CAST(('0x' || substr(md5({x}), {1 + 8 * i}, 8)) AS BIGINT) % {m}) * {w})")
    return f"CAST(({' + '.join(parts)}) % {m} AS BIGINT)"


def BAND_LEFT(x: str) -> str:
    whens = " ".join(f"WHEN {x} < {e} THEN '{l}'" for e, l in zip(BAND_EDGES, BAND_LABELS))
    return f"(CASE {whens} ELSE '{BAND_LABELS[-1]}' END)"


def BAND_RIGHT(x: str) -> str:
    whens = " ".join(f"WHEN {x} <= {e} THEN '{l}'" for e, l in zip(BAND_EDGES, BAND_LABELS))
    return f"(CASE WHEN {x} IS NULL OR {x} <= 0 THEN NULL {whens} ELSE '{BAND_LABELS[-1]}' END)"


RAW = f"""raw AS (
  SELECT
    CASE WHEN l.l_partkey % {NULL_ID_MOD} = 0 THEN NULL
         ELSE substr(r.r_name, 1, 3) || '-' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)
    END AS Transaction_ID,
    CASE WHEN l.l_partkey % {BAD_DATE_MOD} = 0 THEN 'not-a-date'
         ELSE CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) END AS Date,
    CASE WHEN l.l_suppkey % {MESSY_CITY_MOD} = 0 THEN '  ' || lower(r.r_name) || ' ' ELSE r.r_name END AS City,
    CASE WHEN l.l_partkey % {NULL_DISTRICT_MOD} = 0 THEN NULL ELSE n.n_name END AS District,
    p.p_type AS Property_Type,
    CASE WHEN l.l_partkey % {NEGATIVE_VALUE_MOD} = 0 THEN CAST(-1000 AS DOUBLE)
         ELSE round(l.l_extendedprice * CAST(50 AS DOUBLE), 0) END AS Transaction_Value,
    CASE WHEN l.l_partkey % {ZERO_AREA_MOD} = 0 THEN CAST(0 AS DOUBLE)
         ELSE l.l_quantity * CAST(10 AS DOUBLE) END AS Area_sqm,
    CAST(l.l_linenumber AS INTEGER) AS Number_of_Units,
    CAST(p.p_size AS INTEGER) AS Contract_Duration,
    CASE WHEN l.l_returnflag = 'A' THEN 'Sale' WHEN l.l_returnflag = 'N' THEN 'Rent' ELSE 'Investment' END AS Purpose,
    round(l.l_discount * CAST(100 AS DOUBLE), 0) AS Demand_Score,
    round(l.l_tax * CAST(100 AS DOUBLE), 0) AS Supply_Score,
    CAST(p.p_size AS DOUBLE) / CAST(1000 AS DOUBLE) AS Interest_Rate,
    CAST(p.p_size AS DOUBLE) / CAST(10 AS DOUBLE) AS Infrastructure_Distance_KM,
    CAST(floor(o.o_totalprice / CAST(100 AS DOUBLE)) AS INTEGER) AS Population_Migration_Inflow,
    round(p.p_retailprice - CAST(900 AS DOUBLE), 1) / CAST(500 AS DOUBLE) AS Vacancy_Rate,
    l.l_partkey, l.l_suppkey, l.l_extendedprice
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

RAW_COLS = ("Transaction_ID, Date, City, District, Property_Type, Transaction_Value, Area_sqm, "
            "Number_of_Units, Contract_Duration, Purpose, Demand_Score, Supply_Score, Interest_Rate, "
            "Infrastructure_Distance_KM, Population_Migration_Inflow, Vacancy_Rate")

STG = f"""stg AS (
  SELECT
    trim(Transaction_ID, ' ') AS transaction_id,
    TRY_CAST(Date AS DATE) AS transaction_date,
    CAST(year(TRY_CAST(Date AS DATE)) AS INTEGER) AS txn_year,
    CAST(month(TRY_CAST(Date AS DATE)) AS INTEGER) AS txn_month,
    CAST(quarter(TRY_CAST(Date AS DATE)) AS INTEGER) AS txn_quarter,
    {INITCAP_TRIM('City')} AS city,
    {INITCAP_TRIM('District')} AS district,
    {INITCAP_TRIM('Property_Type')} AS property_type,
    {INITCAP_TRIM('Purpose')} AS purpose,
    CAST(Transaction_Value AS BIGINT) AS transaction_value_sar,
    CAST(Area_sqm AS DOUBLE) AS area_sqm,
    {R(RATIO('Transaction_Value', 'Area_sqm'), 2)} AS price_per_sqm,
    CAST(Number_of_Units AS INTEGER) AS number_of_units,
    CAST(Contract_Duration AS INTEGER) AS contract_duration_months,
    {R('CAST(Demand_Score AS DOUBLE)', 4)} AS demand_score,
    {R('CAST(Supply_Score AS DOUBLE)', 4)} AS supply_score,
    {R('CAST(Interest_Rate AS DOUBLE)', 4)} AS interest_rate,
    {R('CAST(Infrastructure_Distance_KM AS DOUBLE)', 2)} AS infra_distance_km,
    CAST(Population_Migration_Inflow AS INTEGER) AS population_inflow,
    {R('CAST(Vacancy_Rate AS DOUBLE)', 4)} AS vacancy_rate,
    {BAND_LEFT('CAST(Transaction_Value AS BIGINT)')} AS value_band,
    CAST(CASE WHEN CAST(Demand_Score AS DOUBLE) > CAST(Supply_Score AS DOUBLE) THEN 1 ELSE 0 END AS INTEGER) AS is_demand_dominant,
    {R(RATIO('Demand_Score', 'Supply_Score'), 4)} AS demand_supply_ratio
  FROM raw
  WHERE Transaction_ID IS NOT NULL AND TRY_CAST(Date AS DATE) IS NOT NULL AND Transaction_Value > 0 AND Area_sqm > 0
)"""

# Spark-job feature view over raw rows.
HOUSING = f"""housing AS (
  SELECT * REPLACE (TRY_CAST(Date AS DATE) AS Date),
    CAST(year(TRY_CAST(Date AS DATE)) AS INTEGER) AS year,
    CAST(month(TRY_CAST(Date AS DATE)) AS INTEGER) AS month,
    CAST(quarter(TRY_CAST(Date AS DATE)) AS INTEGER) AS quarter,
    {RATIO('Transaction_Value', 'Area_sqm')} AS price_per_sqm,
    {RATIO('Demand_Score', 'Supply_Score')} AS demand_supply_ratio,
    CAST(CASE WHEN Demand_Score > {SPARK_HIGH_DEMAND} THEN 1 ELSE 0 END AS INTEGER) AS is_high_demand,
    {BAND_LEFT('Transaction_Value')} AS value_band
  FROM raw
)"""



PARSED = "parsed AS (SELECT * REPLACE (TRY_CAST(Date AS DATE) AS Date) FROM raw)"
NN = """nn AS (SELECT * FROM parsed WHERE Transaction_ID IS NOT NULL AND Date IS NOT NULL AND City IS NOT NULL
  AND Property_Type IS NOT NULL AND Transaction_Value IS NOT NULL AND NOT isnan(Transaction_Value))"""
DD = """dd AS (SELECT * FROM nn QUALIFY row_number() OVER (PARTITION BY Transaction_ID
  ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1)"""
POS = "pos AS (SELECT * FROM dd WHERE Transaction_Value > 0 AND Area_sqm > 0)"
ST = f"""st AS (SELECT quantile_cont(Transaction_Value, {CLIP_LOW}) AS lo, quantile_cont(Transaction_Value, {CLIP_HIGH}) AS hi,
  quantile_cont(Demand_Score, 0.5) AS med FROM pos)"""
CLIPPED = """clipped AS (SELECT pos.* REPLACE (CASE WHEN Transaction_Value IS NULL THEN NULL
  ELSE least(greatest(Transaction_Value, st.lo), st.hi) END AS Transaction_Value), st.med FROM pos, st)"""


def _std(c):
    return TITLE(STRIP(c))


ETL = f"""etl AS (
  SELECT Transaction_ID, Date, {_std('City')} AS City, {_std('District')} AS District,
    {_std('Property_Type')} AS Property_Type, Transaction_Value, Area_sqm, Number_of_Units, Contract_Duration,
    {_std('Purpose')} AS Purpose, Demand_Score, Supply_Score, Interest_Rate, Infrastructure_Distance_KM,
    Population_Migration_Inflow, Vacancy_Rate,
    CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month,
    CAST(quarter(Date) AS INTEGER) AS quarter, CAST(isodow(Date) - 1 AS INTEGER) AS day_of_week,
    strftime(Date, '%Y-%m') AS year_month,
    {R(RATIO('Transaction_Value', 'Area_sqm'), 2)} AS price_per_sqm,
    {BAND_RIGHT('Transaction_Value')} AS value_band,
    {R(RATIO('Demand_Score', 'Supply_Score'), 4)} AS demand_supply_ratio,
    coalesce(Demand_Score > med, false) AS is_high_demand,
    {MD5MOD(_std('City'))} AS city_key, {MD5MOD(_std('District'))} AS district_key
  FROM clipped
)"""
ETL_CHAIN = (RAW, PARSED, NN, DD, POS, ST, CLIPPED, ETL)
FACT_COLS = ("Transaction_ID, Date, city_key, district_key, Property_Type, Transaction_Value, Area_sqm, "
             "price_per_sqm, Number_of_Units, Contract_Duration, Purpose, Demand_Score, Supply_Score, "
             "Interest_Rate, Infrastructure_Distance_KM, Population_Migration_Inflow, Vacancy_Rate, "
             "demand_supply_ratio, value_band, is_high_demand, year, month, quarter, year_month")
FACT = f"fact AS (SELECT {FACT_COLS} FROM etl)"
DIM_CITY = "dim_city AS (SELECT DISTINCT city_key, City AS city_name FROM etl)"
DIM_DISTRICT = ("dim_district AS (SELECT DISTINCT district_key, District AS district_name, city_key, "
                "City AS city_name FROM etl)")
STAR = ETL_CHAIN + (FACT, DIM_CITY, DIM_DISTRICT)
SCORES = f"""scored AS (SELECT *,
  {R('interest_rate * 100 + vacancy_rate * 50 - demand_score * 5 + infra_distance_km * CAST(0.1 AS DOUBLE)', 2)} AS risk_score,
  {R('demand_score * 15 + (1 - vacancy_rate) * 10 - interest_rate * 50 + demand_supply_ratio * 5', 2)} AS investment_score
  FROM stg)"""
SNAP = f"""snap AS (
  SELECT f.city_key, c.city_name, f.year,
    {RA('avg(f.price_per_sqm)', 2)} AS avg_price_per_sqm,
    {RA('avg(f.Demand_Score)', 4)} AS avg_demand_score,
    {RA('avg(f.Vacancy_Rate)', 4)} AS avg_vacancy_rate,
    make_date(f.year, 1, 1) AS effective_date, make_date(f.year, 12, 31) AS expiry_date,
    CAST(CASE WHEN f.year = (SELECT max(year) FROM fact) THEN 1 ELSE 0 END AS INTEGER) AS is_current,
    md5(CAST(f.city_key AS VARCHAR) || '_' || CAST(f.year AS VARCHAR) || '_'
        || CAST(CAST({RA('avg(f.price_per_sqm)', 2)} AS DECIMAL(28,2)) AS VARCHAR)) AS record_hash
  FROM fact f LEFT JOIN dim_city c ON f.city_key = c.city_key
  GROUP BY f.city_key, c.city_name, f.year
)"""


def DEC_TXT(x, n):
    return f"CAST(CAST({R(x, n)} AS DECIMAL(28,{n})) AS VARCHAR)"


HIST = f"""hist AS (
  SELECT *, lag(h) OVER (PARTITION BY city_key, city_name ORDER BY year) AS prev_h FROM (
    SELECT city_key, city_name, year, avg_price_per_sqm, avg_demand_score, avg_vacancy_rate, effective_date,
      md5(concat_ws('|', CAST(city_key AS VARCHAR), coalesce(city_name, ''),
        coalesce({DEC_TXT('avg_price_per_sqm', 2)}, ''), coalesce({DEC_TXT('avg_demand_score', 4)}, ''),
        coalesce({DEC_TXT('avg_vacancy_rate', 4)}, ''))) AS h
    FROM snap)
),
versions AS (
  SELECT city_key, city_name, avg_price_per_sqm, avg_demand_score, avg_vacancy_rate, effective_date,
    coalesce(lead(effective_date) OVER (PARTITION BY city_key, city_name ORDER BY year) - INTERVAL 1 DAY,
             DATE '9999-12-31')::DATE AS expiry_date,
    CAST(CASE WHEN lead(effective_date) OVER (PARTITION BY city_key, city_name ORDER BY year) IS NULL
         THEN 1 ELSE 0 END AS INTEGER) AS is_current,
    h AS record_hash
  FROM hist WHERE prev_h IS NULL OR prev_h <> h
)"""



def TH(x):
    return f"format('{{:,}}', CAST({x} AS BIGINT))"


def FIX(x, n):
    return (f"coalesce(CAST(CAST(ROUND(TRY_CAST(({x}) AS DECIMAL(38,10)), {n}) AS DECIMAL(38,{n})) AS VARCHAR), "
            "'nan')")


def SHORT(x, n):
    t = FIX(x, n)
    if n == 0:
        return f"(CASE WHEN {t} = 'nan' THEN 'nan' ELSE {t} || '.0' END)"
    tr = f"regexp_replace({t}, '0+$', '')"
    return f"(CASE WHEN {t} = 'nan' THEN 'nan' WHEN ends_with({tr}, '.') THEN {tr} || '0' ELSE {tr} END)"


def PYLIST(arr):
    return f"('[' || array_to_string(list_transform({arr}, lambda x: coalesce(chr(39) || x || chr(39), 'nan')), ', ') || ']')"


def _check_sql(i, c, src="raw"):
    from tessera.plans.quality import _num_text
    k, p, col = c.kind, c.params, c.column
    head = f"SELECT {i} AS check_id, '{c.name}' AS name, '{col}' AS \"column\", "
    tail = f", '{c.severity}' AS severity"
    num_types = ("Transaction_Value", "Area_sqm", "Demand_Score", "Supply_Score", "Interest_Rate",
                 "Infrastructure_Distance_KM", "Vacancy_Rate")
    isnull = f"({col} IS NULL OR isnan({col}))" if col in num_types else f"({col} IS NULL)"
    clean = f"(CASE WHEN isnan({col}) THEN NULL ELSE {col} END)" if col in num_types else f"CAST({col} AS DOUBLE)"
    if k == "no_nulls":
        return (head + "n = 0 AS passed" + tail + ", CAST(n AS VARCHAR) AS observed_value, '0 nulls' AS expected, "
                f"CASE WHEN n > 0 THEN {TH('n')} || ' null values found' ELSE 'All values present' END AS details "
                f"FROM (SELECT count_if({isnull}) AS n FROM {src})")
    if k == "unique":
        return (head + "n = 0 AS passed" + tail + ", CAST(n AS VARCHAR) AS observed_value, '0 duplicates' AS expected, "
                f"CASE WHEN n > 0 THEN {TH('n')} || ' duplicates found' ELSE 'All values unique' END AS details "
                f"FROM (SELECT CAST(count(*) - count(DISTINCT {col}) - max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END) "
                f"AS BIGINT) AS n FROM {src})")
    if k == "no_negative":
        return (head + "n = 0 AS passed" + tail + ", CAST(n AS VARCHAR) AS observed_value, "
                "'No negative values' AS expected, "
                f"CASE WHEN n > 0 THEN {TH('n')} || ' negative values found' ELSE 'All values non-negative' END AS details "
                f"FROM (SELECT count_if({col} < 0) AS n FROM {src})")
    if k == "in_set":
        vals = ", ".join(f"'{v}'" for v in p["values"])
        bad = f"NOT coalesce({col} IN ({vals}), false)"
        exp = "Values in {" + ", ".join(f"''{v}''" for v in sorted(p["values"])) + "}"
        return (head + "n = 0 AS passed" + tail + f", {PYLIST('vals')} AS observed_value, '{exp}' AS expected, "
                f"CASE WHEN n = 0 THEN '' ELSE 'Invalid values: ' || {PYLIST('list_slice(vals, 1, 5)')} END AS details "
                f"FROM (SELECT count_if({bad}) AS n FROM {src}), "
                f"(SELECT coalesce(list(v ORDER BY v NULLS FIRST), []) AS vals FROM "
                f"(SELECT DISTINCT {col} AS v FROM {src} WHERE {bad} ORDER BY v NULLS FIRST LIMIT 10))")
    if k == "between":
        pct = "CAST(n AS DOUBLE) / NULLIF(CAST(rws AS DOUBLE), 0) * 100"
        return (head + "n = 0 AS passed" + tail + f", {TH('n')} || ' (' || {SHORT(pct, 2)} || '%)' AS observed_value, "
                f"'[{_num_text(p['min'])}, {_num_text(p['max'])}]' AS expected, "
                f"'Min=' || {FIX('mn', 2)} || ', Max=' || {FIX('mx', 2)} || ', Mean=' || {FIX('av', 2)} AS details "
                f"FROM (SELECT count_if({col} < {p['min']} OR {col} > {p['max']}) AS n, count(*) AS rws, "
                f"min({clean}) AS mn, max({clean}) AS mx, avg({clean}) AS av FROM {src})")
    if k == "date_range":
        d = f"TRY_CAST({col} AS DATE)"
        return (head + "n = 0 AS passed" + tail + f", {TH('n')} || ' out-of-range' AS observed_value, "
                f"'{p['min']} → {p['max']}' AS expected, "
                "'Date range in data: ' || coalesce(CAST(mn AS VARCHAR), 'NaT') || ' → ' || "
                "coalesce(CAST(mx AS VARCHAR), 'NaT') AS details "
                f"FROM (SELECT count_if({d} < DATE '{p['min']}' OR {d} > DATE '{p['max']}') AS n, "
                f"min({d}) AS mn, max({d}) AS mx FROM {src})")
    if k == "row_count":
        exp = int(p["expected"])
        diff = f"CAST(abs(n - {exp}) AS DOUBLE) / CAST({exp} AS DOUBLE)"
        return (head + f"{diff} <= {float(p['tolerance'])} AS passed" + tail + f", {TH('n')} AS observed_value, "
                f"'{exp:,} ± {p['tolerance'] * 100:.0f}%' AS expected, "
                f"'Difference: ' || {FIX(diff + ' * 100', 2)} || '%' AS details "
                f"FROM (SELECT count(*) AS n FROM {src})")
    if k == "mean_between":
        return (head + f"coalesce(m >= {float(p['min'])} AND m <= {float(p['max'])}, false) AS passed" + tail
                + f", {SHORT('m', 4)} AS observed_value, "
                f"'mean in [{_num_text(p['min'])}, {_num_text(p['max'])}]' AS expected, '' AS details "
                f"FROM (SELECT avg({clean}) AS m FROM {src})")
    raise ValueError(k)


def SUITE(kinds=None, name="suite"):
    from tessera.plans.quality import default_suite
    parts = [_check_sql(i + 1, c) for i, c in enumerate(default_suite()) if kinds is None or c.kind in kinds]
    return f"{name} AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


def Z(src, col, idc):
    return (f"SELECT {idc}, {R(col, 4)} AS {col}, {R('z', 6)} AS z_score FROM ("
            f"SELECT {idc}, {col}, ({col} - m) / NULLIF(sd, 0) AS z FROM {src}, "
            f"(SELECT avg({col}) AS m, stddev_samp({col}) AS sd FROM {src})) WHERE abs(z) > 3.0")


def ZSUM(src, col):
    return (f"SELECT '{col}' AS \"column\", CAST(count(*) AS BIGINT) AS total_rows, "
            f"CAST(count_if(abs(({col} - m) / NULLIF(sd, 0)) > 3.0) AS BIGINT) AS anomalies, "
            f"coalesce({R('CAST(count_if(abs((' + col + ' - m) / NULLIF(sd, 0)) > 3.0) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0) * 100', 2)}, 0.0) AS anomaly_pct "
            f"FROM {src}, (SELECT avg({col}) AS m, stddev_samp({col}) AS sd FROM {src})")


CITY_SUMMARY = f"""city_summary AS (
SELECT c.city_name, CAST(count(*) AS BIGINT) AS total_transactions,
  {R('sum(CAST(f.Transaction_Value AS DECIMAL(28,8)))', 0)} AS total_value_sar, {RA('avg(f.Transaction_Value)', 0)} AS avg_value_sar,
  {RA('avg(f.price_per_sqm)', 2)} AS avg_price_per_sqm, {RA('avg(f.Area_sqm)', 1)} AS avg_area_sqm,
  {RA('avg(f.Demand_Score)', 2)} AS avg_demand_score, {RA('avg(f.Vacancy_Rate) * 100', 2)} AS avg_vacancy_pct,
  {RA('avg(f.Interest_Rate) * 100', 2)} AS avg_interest_rate_pct
FROM fact f JOIN dim_city c ON f.city_key = c.city_key GROUP BY c.city_name)"""
PROPERTY = f"""prop AS (
SELECT Property_Type AS property_type, CAST(count(*) AS BIGINT) AS total_transactions,
  {RA('avg(Transaction_Value)', 0)} AS avg_value_sar, {RA('avg(Area_sqm)', 1)} AS avg_area_sqm,
  {RA('avg(price_per_sqm)', 2)} AS avg_price_per_sqm, {RA('avg(Demand_Score)', 2)} AS avg_demand_score,
  {R('sum(CAST(Transaction_Value AS DECIMAL(28,8)))', 0)} AS total_market_value
FROM fact GROUP BY Property_Type)"""
TREND = f"""trend AS (
SELECT year, CAST(count(*) AS BIGINT) AS total_transactions, {RA('avg(Transaction_Value)', 0)} AS avg_value_sar
FROM fact GROUP BY year)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def build() -> dict[str, str]:
    q: dict[str, str] = {}

    q["stg_transactions"] = with_(RAW, STG) + "SELECT * FROM stg"

    q["spark_city_summary"] = with_(RAW, HOUSING) + f"""
SELECT City,
  CAST(count(*) AS BIGINT) AS total_transactions,
  {R('sum(CAST(Transaction_Value AS DECIMAL(28,8)))', 0)} AS total_value,
  {RA('avg(Transaction_Value)', 0)} AS avg_value,
  {RA('avg(price_per_sqm)', 2)} AS avg_price_sqm,
  {RA('avg(Demand_Score)', 3)} AS avg_demand,
  {RA('avg(Vacancy_Rate) * 100', 2)} AS avg_vacancy_pct
FROM housing GROUP BY City ORDER BY total_transactions DESC"""

    q["spark_yearly_trend"] = with_(RAW, HOUSING) + f"""
SELECT year, CAST(count(*) AS BIGINT) AS transactions,
  {RA('avg(Transaction_Value)', 0)} AS avg_value,
  {RA('avg(Demand_Score)', 3)} AS avg_demand,
  {RA('avg(Interest_Rate) * 100', 2)} AS avg_interest_pct
FROM housing GROUP BY year ORDER BY year"""

    q["district_top5"] = with_(RAW, HOUSING) + f"""
SELECT * FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY City ORDER BY avg_price_sqm DESC NULLS LAST) AS INTEGER) AS rank_in_city
  FROM (SELECT City, District, CAST(count(*) AS BIGINT) AS txn_count,
          {RA('avg(Transaction_Value)', 0)} AS avg_value, {RA('avg(price_per_sqm)', 2)} AS avg_price_sqm
        FROM housing GROUP BY City, District))
WHERE rank_in_city <= 5 ORDER BY City, rank_in_city"""

    q["spark_features"] = with_(RAW, HOUSING) + f"SELECT {RAW_COLS}, year, month, quarter, price_per_sqm, " \
        "demand_supply_ratio, is_high_demand, value_band FROM housing"

    q["city_summary_basic"] = with_(RAW) + f"""
SELECT City, CAST(count(Transaction_ID) AS BIGINT) AS transactions,
  {RA('avg(Transaction_Value)', 0)} AS avg_value,
  {RA('avg(' + RATIO('Transaction_Value', 'Area_sqm') + ')', 0)} AS avg_price_sqm
FROM raw GROUP BY City"""

    q["parse_dates"] = with_(RAW, PARSED) + "SELECT Transaction_ID, Date FROM parsed"
    q["time_features"] = with_(RAW, PARSED) + """
SELECT Transaction_ID, Date, CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month,
  CAST(quarter(Date) AS INTEGER) AS quarter, CAST(isodow(Date) - 1 AS INTEGER) AS day_of_week,
  strftime(Date, '%Y-%m') AS year_month FROM parsed"""
    q["drop_null_critical"] = with_(RAW, PARSED, NN) + "SELECT * FROM nn"
    q["dedup_keep_first"] = with_(RAW, PARSED, NN, DD) + "SELECT * FROM dd"
    q["filter_positive"] = with_(RAW, PARSED, NN, DD, POS) + "SELECT * FROM pos"
    q["outlier_bounds"] = with_(RAW, PARSED, NN, DD, POS, ST) + \
        f"SELECT {R('lo', 4)} AS lower, {R('hi', 4)} AS upper FROM st"
    q["outlier_clip"] = with_(RAW, PARSED, NN, DD, POS, ST, CLIPPED) + \
        f"SELECT Transaction_ID, {R('Transaction_Value', 4)} AS Transaction_Value FROM clipped"
    q["high_demand_median"] = with_(*ETL_CHAIN) + "SELECT Transaction_ID, Demand_Score, is_high_demand FROM etl"
    q["price_per_sqm"] = with_(*ETL_CHAIN) + "SELECT Transaction_ID, price_per_sqm FROM etl"
    q["value_band_right_closed"] = with_(*ETL_CHAIN) + "SELECT Transaction_ID, value_band FROM etl"
    q["value_band_left_closed"] = with_(RAW, STG) + "SELECT transaction_id, transaction_value_sar, value_band FROM stg"
    q["demand_supply_ratio"] = with_(*ETL_CHAIN) + "SELECT Transaction_ID, demand_supply_ratio FROM etl"
    q["standardise_strings"] = with_(RAW) + \
        f"SELECT Transaction_ID, {_std('City')} AS City, {_std('District')} AS District, " \
        f"{_std('Property_Type')} AS Property_Type, {_std('Purpose')} AS Purpose FROM raw"
    q["surrogate_keys"] = with_(*ETL_CHAIN) + "SELECT DISTINCT City, District, city_key, district_key FROM etl"
    q["etl_clean"] = with_(*ETL_CHAIN) + \
        f"SELECT * EXCLUDE (Transaction_Value), {R('Transaction_Value', 4)} AS Transaction_Value FROM etl"
    q["etl_row_accounting"] = with_(RAW, PARSED, NN, DD, POS) + """,
c AS (SELECT (SELECT count(*) FROM raw) AS a, (SELECT count(*) FROM nn) AS b,
             (SELECT count(*) FROM dd) AS d, (SELECT count(*) FROM pos) AS e)
SELECT * , rows_in - rows_out AS rows_dropped FROM (
  SELECT 1 AS step_order, 'drop_null_critical' AS step, CAST(a AS BIGINT) AS rows_in, CAST(b AS BIGINT) AS rows_out FROM c
  UNION ALL SELECT 2, 'dedup_transaction_id', b, d FROM c
  UNION ALL SELECT 3, 'filter_positive', d, e FROM c
  UNION ALL SELECT 4, 'total', a, e FROM c)""".replace("WITH ", "WITH ", 1)

    q["fact_transactions"] = with_(*STAR) + \
        f"SELECT * EXCLUDE (Transaction_Value), {R('Transaction_Value', 4)} AS Transaction_Value FROM fact"
    q["fact_star_keyed"] = with_(*ETL_CHAIN) + f"""
SELECT Transaction_ID, CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS date_key,
  city_key, district_key, {MD5MOD('Property_Type')} AS property_type_key, {MD5MOD('Purpose')} AS purpose_key
FROM etl"""
    q["dim_city"] = with_(*STAR) + \
        "SELECT city_key, city_name, CAST(NULL AS VARCHAR) AS region, 1 AS is_major_city FROM dim_city"
    q["dim_district"] = with_(*STAR) + "SELECT * FROM dim_district"
    q["dim_date"] = with_(*ETL_CHAIN) + """
SELECT CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS date_key, Date, year, quarter, month,
  monthname(Date) AS month_name, day_of_week, dayname(Date) AS day_name,
  CAST(CASE WHEN day_of_week IN (5, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend, year_month
FROM (SELECT DISTINCT Date, year, month, quarter, day_of_week, year_month FROM etl)"""
    q["dim_property_type"] = with_(*ETL_CHAIN) + f"""
SELECT {MD5MOD('Property_Type')} AS property_type_key, Property_Type AS property_type_name,
  CAST(NULL AS VARCHAR) AS category, min(Area_sqm) AS typical_area_min, max(Area_sqm) AS typical_area_max
FROM etl GROUP BY Property_Type"""
    q["dim_purpose"] = with_(*ETL_CHAIN) + f"""
SELECT {MD5MOD('Purpose')} AS purpose_key, Purpose AS purpose_name,
  CAST(CASE WHEN Purpose = 'Investment' THEN 1 ELSE 0 END AS INTEGER) AS is_investment
FROM (SELECT DISTINCT Purpose FROM etl)"""

    q["mart_city_summary"] = with_(*STAR) + f"""
SELECT c.city_name, CAST(count(*) AS BIGINT) AS total_transactions,
  {R('sum(CAST(f.Transaction_Value AS DECIMAL(28,8)))', 0)} AS total_value_sar, {RA('avg(f.Transaction_Value)', 0)} AS avg_value_sar,
  {RA('avg(f.price_per_sqm)', 2)} AS avg_price_per_sqm, {RA('avg(f.Area_sqm)', 1)} AS avg_area_sqm,
  {RA('avg(f.Demand_Score)', 2)} AS avg_demand_score, {RA('avg(f.Vacancy_Rate) * 100', 2)} AS avg_vacancy_pct,
  {RA('avg(f.Interest_Rate) * 100', 2)} AS avg_interest_rate_pct
FROM fact f JOIN dim_city c ON f.city_key = c.city_key
GROUP BY c.city_name ORDER BY total_transactions DESC"""
    q["mart_yearly_trend"] = with_(*STAR) + f"""
SELECT year, CAST(count(*) AS BIGINT) AS total_transactions,
  {R('sum(CAST(Transaction_Value AS DECIMAL(28,8)))', 0)} AS total_value_sar, {RA('avg(Transaction_Value)', 0)} AS avg_value_sar,
  {RA('avg(Demand_Score)', 3)} AS avg_demand, {RA('avg(Supply_Score)', 3)} AS avg_supply,
  {RA('avg(Interest_Rate) * 100', 2)} AS avg_interest_rate_pct, {RA('avg(Vacancy_Rate) * 100', 2)} AS avg_vacancy_pct
FROM fact GROUP BY year ORDER BY year"""
    q["mart_property_analysis"] = with_(*STAR) + f"""
SELECT Property_Type AS property_type, CAST(count(*) AS BIGINT) AS total_transactions,
  {RA('avg(Transaction_Value)', 0)} AS avg_value_sar, {RA('avg(Area_sqm)', 1)} AS avg_area_sqm,
  {RA('avg(price_per_sqm)', 2)} AS avg_price_per_sqm, {RA('avg(Demand_Score)', 2)} AS avg_demand_score,
  {R('sum(CAST(Transaction_Value AS DECIMAL(28,8)))', 0)} AS total_market_value
FROM fact GROUP BY Property_Type ORDER BY total_transactions DESC"""
    q["mart_district_heatmap"] = with_(*STAR) + f"""
SELECT c.city_name, d.district_name, CAST(count(*) AS BIGINT) AS transactions,
  {RA('avg(f.Transaction_Value)', 0)} AS avg_value, {RA('avg(f.Demand_Score)', 2)} AS avg_demand,
  {RA('avg(f.Vacancy_Rate) * 100', 2)} AS vacancy_pct, {RA('avg(f.price_per_sqm)', 2)} AS avg_price_sqm
FROM fact f JOIN (SELECT DISTINCT city_key, city_name FROM dim_city) c ON f.city_key = c.city_key
JOIN (SELECT DISTINCT district_key, district_name, city_name FROM dim_district) d
  ON f.district_key = d.district_key AND d.city_name = c.city_name
GROUP BY c.city_name, d.district_name ORDER BY transactions DESC"""
    q["mart_value_band_distribution"] = with_(*STAR) + f"""
SELECT f.value_band, c.city_name, CAST(count(*) AS BIGINT) AS count,
  {RA('avg(f.Area_sqm)', 1)} AS avg_area, {RA('avg(f.Demand_Score)', 2)} AS avg_demand
FROM fact f JOIN dim_city c ON f.city_key = c.city_key
GROUP BY f.value_band, c.city_name ORDER BY f.value_band, count DESC"""
    q["register_marts"] = with_(*STAR) + """
SELECT 'mart_city_summary' AS view_name, CAST(count(DISTINCT c.city_name) AS BIGINT) AS row_count
  FROM fact f JOIN dim_city c ON f.city_key = c.city_key
UNION ALL SELECT 'mart_yearly_trend', CAST(count(DISTINCT coalesce(year, -1)) AS BIGINT) FROM fact
UNION ALL SELECT 'mart_property_analysis', CAST(count(DISTINCT Property_Type) AS BIGINT) FROM fact
UNION ALL SELECT 'mart_district_heatmap', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT c.city_name, d.district_name
  FROM fact f JOIN dim_city c ON f.city_key = c.city_key JOIN dim_district d
  ON f.district_key = d.district_key AND d.city_name = c.city_name)
UNION ALL SELECT 'mart_value_band_distribution', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT f.value_band, c.city_name
  FROM fact f JOIN dim_city c ON f.city_key = c.city_key)"""
    q["yearly_mean_value"] = with_(*STAR) + f"SELECT year, {RA('avg(Transaction_Value)', 2)} AS mean_value FROM etl GROUP BY year"
    q["price_by_property_type"] = with_(*STAR) + \
        f"SELECT Property_Type, {RA('avg(price_per_sqm)', 2)} AS mean_price_per_sqm FROM fact GROUP BY Property_Type"
    q["city_txn_ranking"] = with_(*STAR) + """
SELECT City, transactions, CAST(rank() OVER (ORDER BY transactions DESC) AS INTEGER) AS rank
FROM (SELECT City, CAST(count(Transaction_ID) AS BIGINT) AS transactions FROM etl GROUP BY City)"""
    q["scd2_yearly_snapshots"] = with_(*STAR, SNAP) + "SELECT * FROM snap"
    q["scd2_change_history"] = with_(*STAR, SNAP, HIST) + "SELECT * FROM versions"
    q["assert_scd2_valid"] = with_(*STAR, SNAP, HIST) + """
SELECT city_key, city_name, year, avg_price_per_sqm, avg_demand_score, avg_vacancy_rate, effective_date,
  expiry_date, is_current, record_hash FROM snap WHERE expiry_date < effective_date
UNION ALL
SELECT city_key, city_name, CAST(year(effective_date) AS INTEGER), avg_price_per_sqm, avg_demand_score,
  avg_vacancy_rate, effective_date, expiry_date, is_current, record_hash FROM versions
WHERE expiry_date < effective_date"""

    q["city_stats"] = with_(RAW, STG) + f"""
SELECT city, {RA('avg(transaction_value_sar)', 6)} AS city_avg_value, {RA('avg(price_per_sqm)', 6)} AS city_avg_price_sqm,
  {RA('avg(demand_score)', 6)} AS city_avg_demand, {RA('avg(vacancy_rate)', 6)} AS city_avg_vacancy
FROM stg GROUP BY city"""
    q["district_stats"] = with_(RAW, STG) + f"""
SELECT city, district, CAST(count(*) AS BIGINT) AS district_txn_count,
  {RA('avg(transaction_value_sar)', 6)} AS district_avg_value, {RA('avg(demand_score)', 6)} AS district_avg_demand
FROM stg GROUP BY city, district"""
    ENR = f"""enriched AS (
  SELECT b.*, cs.city_avg_value, cs.city_avg_price_sqm, cs.city_avg_demand, cs.city_avg_vacancy,
    {R('(b.transaction_value_sar - cs.city_avg_value) / NULLIF(cs.city_avg_value, 0) * 100', 2)} AS pct_above_city_avg,
    ds.district_txn_count, ds.district_avg_value, ds.district_avg_demand
  FROM scored b
  LEFT JOIN (
    SELECT city, {RA('avg(transaction_value_sar)', 6)} AS city_avg_value, {RA('avg(price_per_sqm)', 6)} AS city_avg_price_sqm,
      {RA('avg(demand_score)', 6)} AS city_avg_demand, {RA('avg(vacancy_rate)', 6)} AS city_avg_vacancy
    FROM stg GROUP BY city) cs ON b.city = cs.city
  LEFT JOIN (SELECT city, district, CAST(count(*) AS BIGINT) AS district_txn_count,
      {RA('avg(transaction_value_sar)', 6)} AS district_avg_value, {RA('avg(demand_score)', 6)} AS district_avg_demand
    FROM stg GROUP BY city, district) ds ON b.city = ds.city AND b.district = ds.district
)"""
    q["int_transactions_enriched"] = with_(RAW, STG, SCORES, ENR) + "SELECT * FROM enriched"
    q["pct_above_city_avg"] = with_(RAW, STG, SCORES, ENR) + \
        "SELECT transaction_id, city, transaction_value_sar, pct_above_city_avg FROM enriched"
    q["risk_score"] = with_(RAW, STG, SCORES) + "SELECT transaction_id, risk_score FROM scored"
    q["investment_score"] = with_(RAW, STG, SCORES) + "SELECT transaction_id, investment_score FROM scored"
    q["investment_score_basic"] = with_(RAW, STG) + \
        f"SELECT transaction_id, {R('demand_score * 15 + (1 - vacancy_rate) * 10 - interest_rate * 50', 2)} " \
        "AS investment_score_basic FROM stg"
    q["mart_city_performance"] = with_(RAW, STG, SCORES) + f"""
SELECT *, CAST(rank() OVER (PARTITION BY year ORDER BY avg_investment_score DESC NULLS LAST) AS INTEGER) AS investment_rank,
  CAST(rank() OVER (PARTITION BY year ORDER BY total_transactions DESC) AS INTEGER) AS volume_rank
FROM (
  SELECT city, txn_year AS year, CAST(count(*) AS BIGINT) AS total_transactions,
    CAST(count(DISTINCT district) AS BIGINT) AS active_districts,
    CAST(sum(transaction_value_sar) AS BIGINT) AS total_market_value_sar,
    {RA('avg(transaction_value_sar)', 0)} AS avg_transaction_value,
    {RA('avg(price_per_sqm)', 2)} AS avg_price_per_sqm, {R('min(price_per_sqm)', 2)} AS min_price_per_sqm,
    {R('max(price_per_sqm)', 2)} AS max_price_per_sqm, {RA('avg(area_sqm)', 1)} AS avg_area_sqm,
    {RA('avg(demand_score)', 3)} AS avg_demand_score, {RA('avg(supply_score)', 3)} AS avg_supply_score,
    {RA('avg(demand_supply_ratio)', 3)} AS avg_demand_supply_ratio,
    {RA('avg(vacancy_rate) * 100', 2)} AS avg_vacancy_pct, {RA('avg(interest_rate) * 100', 2)} AS avg_interest_rate_pct,
    {RA('avg(risk_score)', 2)} AS avg_risk_score, {RA('avg(investment_score)', 2)} AS avg_investment_score,
    {R(f'sum(CASE WHEN demand_score > {MART_HIGH_DEMAND} THEN 1 ELSE 0 END) * CAST(100 AS DOUBLE) / count(*)', 2)}
      AS high_demand_share_pct
  FROM scored GROUP BY city, txn_year)
ORDER BY year, total_transactions DESC"""
    q["high_demand_share"] = with_(RAW, STG) + f"""
SELECT city, CAST(count(*) AS BIGINT) AS total_transactions,
  CAST(sum(CASE WHEN demand_score > {MART_HIGH_DEMAND} THEN 1 ELSE 0 END) AS BIGINT) AS high_demand_transactions,
  {R(f'sum(CASE WHEN demand_score > {MART_HIGH_DEMAND} THEN 1 ELSE 0 END) * CAST(100 AS DOUBLE) / count(*)', 2)} AS high_demand_share_pct
FROM stg GROUP BY city"""
    q["assert_no_negative_prices"] = with_(RAW, STG) + "SELECT * FROM stg WHERE price_per_sqm < 0"

    q["dq_suite"] = with_(RAW, SUITE()) + "SELECT * FROM suite"
    for key, kind in [("dq_no_nulls", "no_nulls"), ("dq_unique", "unique"), ("dq_values_in_set", "in_set"),
                      ("dq_between", "between"), ("dq_date_range", "date_range"),
                      ("dq_no_negative", "no_negative"), ("dq_row_count", "row_count"),
                      ("dq_mean_between", "mean_between")]:
        q[key] = with_(RAW, SUITE({kind})) + "SELECT * FROM suite"
    SUMMARY = f"""summ AS (SELECT CAST(count(*) AS BIGINT) AS total_checks, CAST(count_if(passed) AS BIGINT) AS passed,
  CAST(count_if(NOT passed) AS BIGINT) AS failed,
  CAST(count_if(NOT passed AND severity = 'critical') AS BIGINT) AS critical_failures,
  coalesce({R('CAST(count_if(passed) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0) * 100', 2)}, 0.0) AS quality_score,
  count_if(NOT passed AND severity = 'critical') = 0 AS gate_passed FROM suite)"""
    q["dq_summary"] = with_(RAW, SUITE(), SUMMARY) + \
        "SELECT *, (SELECT CAST(count(*) AS BIGINT) FROM raw) AS total_rows, 'Housing_Market_SA_1M' AS dataset FROM summ"
    q["dq_score"] = with_(RAW, SUITE(), SUMMARY) + "SELECT quality_score FROM summ"
    q["dq_gate"] = with_(RAW, SUITE(), SUMMARY) + "SELECT gate_passed, critical_failures FROM summ"
    q["dq_critical_failures"] = with_(RAW, SUITE()) + \
        "SELECT * FROM suite WHERE NOT passed AND severity = 'critical'"
    from tessera.catalog import NUMERIC_RAW_COLUMNS
    prof = []
    for c in NUMERIC_RAW_COLUMNS:
        v = f"(CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END)"
        prof.append(f"SELECT '{c}' AS \"column\", {R(f'min({v})', 2)} AS min_value, {R(f'max({v})', 2)} AS max_value, "
                    f"{RA(f'avg({v})', 2)} AS mean_value FROM raw")
    q["dq_column_profile"] = with_(RAW) + "\nUNION ALL\n".join(prof)
    FSK = f"""fsk AS (SELECT CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS date_key,
  city_key, district_key, {MD5MOD('Property_Type')} AS property_type_key, {MD5MOD('Purpose')} AS purpose_key FROM etl)"""
    part = "SELECT * FROM {} WHERE year < (SELECT max(year) FROM etl) AND Number_of_Units > 6"
    FSK2 = FSK.replace("fsk AS", "held AS").replace("FROM etl)", f"FROM ({part.format('etl')}))")
    orphan = []
    for label, dims_of in (("all rows", "fsk"), ("held out", "held")):
        for key in ["city_key", "district_key", "date_key", "property_type_key", "purpose_key"]:
            orphan.append(f"SELECT '{key}' AS foreign_key, CAST(count(*) AS BIGINT) AS orphans, '{label}' AS dims FROM fsk a "
                          f"WHERE a.{key} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dims_of} b WHERE b.{key} = a.{key})")
    q["dq_referential_integrity"] = with_(*ETL_CHAIN, FSK, FSK2) + "\nUNION ALL\n".join(orphan)
    dims = {
        "dim_city": "SELECT DISTINCT city_key AS k, City FROM etl",
        "dim_district": "SELECT DISTINCT district_key AS k, District, city_key, City FROM etl",
        "dim_date": "SELECT DISTINCT CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS k, Date FROM etl",
        "dim_property_type": f"SELECT DISTINCT {MD5MOD('Property_Type')} AS k, Property_Type FROM etl",
        "dim_purpose": f"SELECT DISTINCT {MD5MOD('Purpose')} AS k, Purpose FROM etl",
    }
    dup = [f"SELECT '{n}' AS table_name, CAST(k AS BIGINT) AS key_value, CAST(count(*) AS BIGINT) AS rows "
           f"FROM ({sql}) WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1" for n, sql in dims.items()]
    q["assert_dim_keys_unique"] = with_(*ETL_CHAIN) + "\nUNION ALL\n".join(dup)
    q["assert_dim_keys_violating"] = with_(*ETL_CHAIN) + """
SELECT 'dim_district_by_city' AS table_name, CAST(city_key AS BIGINT) AS key_value, CAST(count(*) AS BIGINT) AS rows
FROM (SELECT DISTINCT district_key, District, city_key, City FROM etl) GROUP BY city_key HAVING count(*) > 1"""
    q["assert_not_null"] = with_(*ETL_CHAIN) + """
SELECT 'fact_transactions' AS table_name, 'Transaction_ID' AS column_name, CAST(count(*) - count(Transaction_ID) AS BIGINT) AS nulls FROM etl
UNION ALL SELECT 'dim_city', 'city_name', CAST(count(*) - count(City) AS BIGINT) FROM (SELECT DISTINCT city_key, City FROM etl)
UNION ALL SELECT 'dim_property_type', 'property_type_name', CAST(count(*) - count(Property_Type) AS BIGINT) FROM (SELECT DISTINCT Property_Type FROM etl)
UNION ALL SELECT 'dim_purpose', 'purpose_name', CAST(count(*) - count(Purpose) AS BIGINT) FROM (SELECT DISTINCT Purpose FROM etl)
UNION ALL SELECT 'dim_district', 'district_name', CAST(count(*) - count(District) AS BIGINT) FROM (SELECT DISTINCT district_key, District, city_key, City FROM etl)"""
    q["assert_scd2_violating"] = with_(*STAR, SNAP) + """
SELECT city_key, year, make_date(year, 12, 31) AS effective_date, make_date(year, 1, 1) AS expiry_date FROM snap WHERE year IS NOT NULL"""
    q["fact_surrogate_key"] = with_(*STAR) + \
        "SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_sk, CAST(0 AS BIGINT) AS null_sk FROM fact"
    q["dq_report_json"] = with_(RAW, SUITE(), SUMMARY) + """
SELECT true AS run_stamped, 'Housing_Market_SA_1M' AS dataset, (SELECT CAST(count(*) AS BIGINT) FROM raw) AS total_rows, quality_score,
  total_checks, critical_failures, name, "column", suite.passed AS check_passed, severity, observed_value, expected, details
FROM suite, summ"""
    from tessera.schema import VALID_CITIES
    vc = ", ".join(f"'{v}'" for v in VALID_CITIES)
    q["domain_except"] = with_(RAW, STG) + \
        f"SELECT DISTINCT city AS value FROM stg WHERE NOT coalesce(city IN ({vc}), false)"

    q["anomaly_zscore"] = with_(*ETL_CHAIN) + Z("etl", "Transaction_Value", "Transaction_ID")
    q["anomaly_zscore_price"] = with_(*ETL_CHAIN) + Z("etl", "price_per_sqm", "Transaction_ID")
    q["anomaly_zscore_events"] = Z("events", "value", "event_id")
    q["anomaly_summary"] = with_(*ETL_CHAIN) + ZSUM("etl", "Transaction_Value") + "\nUNION ALL\n" + \
        ZSUM("etl", "price_per_sqm") + "\nUNION ALL\n" + ZSUM("events", "value")

    q["dash_kpis"] = with_(*STAR, CITY_SUMMARY) + f"""
SELECT CAST(sum(total_transactions) AS BIGINT) AS total_transactions, sum(total_value_sar) AS total_value_sar,
  {R('sum(total_value_sar) / CAST(sum(total_transactions) AS DOUBLE)', 0)} AS avg_value_sar,
  {RA('avg(coalesce(avg_demand_score, 0))', 2)} AS avg_demand_score,
  {RA('avg(coalesce(avg_vacancy_pct, 0))', 1)} AS avg_vacancy_pct
FROM city_summary"""
    q["dash_property_share"] = with_(*STAR, PROPERTY) + f"""
SELECT property_type, total_transactions,
  {R('total_transactions * CAST(100 AS DOUBLE) / (SELECT sum(total_transactions) FROM prop)', 2)} AS share_pct
FROM prop"""
    q["dash_city_series"] = with_(*STAR, CITY_SUMMARY) + \
        "SELECT city_name, total_transactions, avg_value_sar FROM city_summary"
    q["dash_trend_series"] = with_(*STAR, TREND) + "SELECT year, avg_value_sar, total_transactions FROM trend"
    q["dash_property_series"] = with_(*STAR, PROPERTY) + """
SELECT property_type, total_transactions, coalesce(NULLIF(avg_price_per_sqm, 0), avg_value_sar) AS bar_value
FROM prop"""
    q["dash_fallback_sample"] = with_(*ETL_CHAIN) + f"""
SELECT City, CAST(count(Transaction_ID) AS BIGINT) AS total_transactions,
  {RA('avg(Transaction_Value)', 2)} AS avg_value_sar
FROM (SELECT * FROM etl ORDER BY Transaction_ID LIMIT 50000) GROUP BY City"""

    q["dash_json_records"] = q["mart_city_summary"]
    q["dash_loader"] = with_(*STAR, CITY_SUMMARY) + """
SELECT 'marts' AS source, city_name, total_transactions FROM city_summary
UNION ALL SELECT 'fallback', City, CAST(count(Transaction_ID) AS BIGINT)
FROM (SELECT * FROM etl ORDER BY Transaction_ID LIMIT 50000) GROUP BY City"""
    q["etl_clean_from_csv"] = q["etl_clean"]
    q["anomaly_csv_fact"] = with_(*STAR) + f"""
SELECT * EXCLUDE (m, sd, Transaction_Value), {R('Transaction_Value', 4)} AS Transaction_Value, {R('(price_per_sqm - m) / NULLIF(sd, 0)', 6)} AS z_score
FROM fact, (SELECT avg(price_per_sqm) AS m, stddev_samp(price_per_sqm) AS sd FROM fact) WHERE abs((price_per_sqm - m) / NULLIF(sd, 0)) > 3.0"""
    q["sink_csv_yearly_trend"] = q["spark_yearly_trend"]

    q["assert_negative_prices_raw"] = with_(RAW, HOUSING) + \
        f"SELECT Transaction_ID, Transaction_Value, Area_sqm, {R('price_per_sqm', 4)} AS price_per_sqm " \
        "FROM housing WHERE price_per_sqm < 0"
    order_cols = f"{RAW_COLS}, l_partkey, l_suppkey, l_extendedprice"
    q["scan_csv_typed"] = with_(RAW) + f"SELECT {order_cols} FROM raw"
    q["footer_statistics"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"))
    q["scan_csv_inferred"] = q["scan_csv_typed"]
    q["scan_csv_checked"] = q["scan_csv_typed"] + " WHERE l_partkey % 41 <> 5 AND l_partkey % 43 <> 7"
    q["scan_csv_rejected"] = with_(RAW) + """
SELECT *, CAST(line_count AS BIGINT) AS with_text, (SELECT count(*) FROM raw) AS rows_in,
       (SELECT count(*) FROM raw WHERE l_partkey % 41 <> 5 AND l_partkey % 43 <> 7) AS rows_kept
FROM (SELECT CASE WHEN l_partkey % 41 = 5 THEN 'columns' ELSE 'values' END AS reason,
             CASE WHEN l_partkey % 41 = 5 THEN NULL ELSE 'Area_sqm' END AS bad_columns, count(*) AS line_count
      FROM raw WHERE l_partkey % 41 = 5 OR l_partkey % 43 = 7 GROUP BY ALL)"""
    q["union_chunks"] = with_(RAW) + f"SELECT {order_cols} FROM raw"
    q["scan_bronze"] = with_(RAW) + f"SELECT {RAW_COLS} FROM raw"
    q["row_count"] = with_(RAW) + "SELECT CAST(count(*) AS BIGINT) AS row_count FROM raw"
    q["scan_table"] = q["fact_transactions"]
    q["sink_parquet_partitioned"] = q["etl_clean"]
    q["sink_parquet_city_year"] = q["spark_features"]
    q["sink_csv_summary"] = q["spark_city_summary"]
    q["anomaly_csv_roundtrip"] = q["anomaly_zscore_events"]
    q["sink_table_replace"] = with_(*STAR, SNAP) + """
SELECT 'fact_transactions' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM fact
UNION ALL SELECT 'dim_city', CAST(count(*) AS BIGINT) FROM dim_city
UNION ALL SELECT 'dim_district', CAST(count(*) AS BIGINT) FROM dim_district
UNION ALL SELECT 'dim_date', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT Date, year, month, quarter, day_of_week, year_month FROM etl)
UNION ALL SELECT 'scd2_city_metrics', CAST(count(*) AS BIGINT) FROM snap"""
    q["layers_materialize"] = with_(*STAR, STG) + """
SELECT 'bronze' AS layer, 'transactions_raw' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM raw
UNION ALL SELECT 'silver', 'transactions_clean', CAST(count(*) AS BIGINT) FROM etl
UNION ALL SELECT 'gold', 'mart_city_summary', CAST(count(DISTINCT c.city_name) AS BIGINT)
  FROM fact f JOIN dim_city c ON f.city_key = c.city_key
UNION ALL SELECT 'gold', 'mart_yearly_trend', CAST(count(DISTINCT coalesce(year, -1)) AS BIGINT) FROM fact
UNION ALL SELECT 'gold', 'mart_property_analysis', CAST(count(DISTINCT Property_Type) AS BIGINT) FROM fact
UNION ALL SELECT 'gold', 'mart_district_heatmap', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT c.city_name, d.district_name
  FROM fact f JOIN dim_city c ON f.city_key = c.city_key JOIN dim_district d
  ON f.district_key = d.district_key AND d.city_name = c.city_name)
UNION ALL SELECT 'gold', 'mart_value_band_distribution', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT f.value_band, c.city_name
  FROM fact f JOIN dim_city c ON f.city_key = c.city_key)"""
    q["layers_materialize"] = q["layers_materialize"] + """
UNION ALL SELECT 'view', 'stg_transactions', CAST(count(*) AS BIGINT) FROM stg
UNION ALL SELECT 'table', 'int_transactions_enriched', CAST(count(*) AS BIGINT) FROM stg
UNION ALL SELECT 'table', 'mart_city_performance', CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT city, txn_year FROM stg)"""
    SCLEAN = f"""sclean AS (
  SELECT Transaction_ID, Date, {_std('City')} AS City, {_std('District')} AS District,
    {_std('Property_Type')} AS Property_Type, Transaction_Value, Area_sqm, Number_of_Units, Contract_Duration,
    {_std('Purpose')} AS Purpose, Demand_Score, Supply_Score, Interest_Rate, Infrastructure_Distance_KM,
    Population_Migration_Inflow, Vacancy_Rate,
    CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month,
    CAST(quarter(Date) AS INTEGER) AS quarter, CAST(isodow(Date) - 1 AS INTEGER) AS day_of_week,
    strftime(Date, '%Y-%m') AS year_month, {BAND_LEFT('Transaction_Value')} AS value_band,
    {MD5MOD(_std('City'))} AS city_key, {MD5MOD(_std('District'))} AS district_key
  FROM nn WHERE Transaction_Value > 0 AND Area_sqm > 0)"""
    q["stream_ingest_clean"] = with_(RAW, PARSED, NN, SCLEAN) + "SELECT * FROM sclean"
    firsts = """firsts AS (SELECT * FROM nn WHERE Transaction_Value > 0 AND Area_sqm > 0
  QUALIFY row_number() OVER (PARTITION BY Transaction_ID ORDER BY l_partkey, l_suppkey, l_extendedprice) = 1)"""
    q["stream_dedup"] = with_(RAW, PARSED, NN, firsts, SCLEAN.replace("FROM nn WHERE Transaction_Value > 0 AND Area_sqm > 0", "FROM firsts")) \
        + "SELECT * FROM sclean"
    q["scd2_merge"] = q["scd2_change_history"]
    q["etl_observed_accounting"] = q["etl_row_accounting"]
    q["etl_observed_nulls"] = with_(RAW, PARSED) + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count, "
        "CAST(count(*) AS BIGINT) AS row_count FROM parsed" for c in RAW_COLUMNS)
    q["table_replace_atomic"] = with_(*STAR) + """
SELECT 1 AS version, year, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(Number_of_Units) AS BIGINT) AS units FROM fact GROUP BY year
UNION ALL SELECT 2, year, CAST(count(*) AS BIGINT), CAST(sum(Number_of_Units) AS BIGINT) FROM fact
WHERE year < (SELECT max(year) FROM fact) OR Number_of_Units > 1 GROUP BY year"""
    q["stream_monthly_trend"] = with_(RAW, PARSED, NN, SCLEAN) + f"""
SELECT year_month, CAST(count(*) AS BIGINT) AS transactions, {R('sum(CAST(Transaction_Value AS DECIMAL(28,8)))', 0)} AS total_value
FROM sclean GROUP BY year_month"""

    return q
