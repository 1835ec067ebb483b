from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskflow.constants import PAYMENT_BEHAVIOURS
from riskflow.functions import scalars as S
from riskflow.operators import cleaning as C
from riskflow.operators import features as G
from riskflow.operators import profiling as P
from riskflow.operators.ordered import first_rows
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query
from riskflow.schemas import SOURCES
from riskflow.session import scratch_dir


@query(
    "loan_dpd",
    f"""WITH {V.LOAN_DPD} SELECT loan_id, mob, snapshot_date, due_amt, overdue_amt, installments_missed,
    first_missed_date, dpd FROM loan_d""",
)
def loan_dpd(t: Tables) -> DataFrame:
    return V.loan_d(t)


@query(
    "numeric_profile",
    f"""WITH {V.DIRTY}, x AS (
  SELECT 'q_txt' AS "column", TRY_CAST(NULLIF(TRIM(REGEXP_REPLACE(q_txt, '[^0-9.\\-]+', '', 'g')), '') AS DOUBLE) AS v FROM dirty
  UNION ALL
  SELECT 'age_txt', TRY_CAST(NULLIF(TRIM(REGEXP_REPLACE(age_txt, '[^0-9.\\-]+', '', 'g')), '') AS DOUBLE) FROM dirty)
SELECT "column", COUNT(*) AS n_rows, COUNT(*) AS n_known, COUNT(v) AS n_numeric, COALESCE(MAX(ABS(v - FLOOR(v))), 0.0) AS max_fraction,
       MAX(ABS(v)) AS max_size, COUNT(v) / COUNT(*) AS share FROM x GROUP BY 1""",
)
def numeric_profile(t: Tables) -> DataFrame:
    return C.numeric_profile(V.dirty(t), exclude=())


@query(
    "numeric_sweep",
    f"""WITH {V.DIRTY} SELECT l_orderkey, l_linenumber, CAST(REGEXP_REPLACE(q_txt, '[^0-9]', '', 'g') AS BIGINT) AS q_txt,
    age_txt, 'n/a ' || CAST(l_linenumber AS VARCHAR) || '-' || q_txt AS code_txt FROM dirty""",
)
def numeric_sweep(t: Tables) -> DataFrame:
    """q_txt becomes a number in place; code_txt is numeric nowhere and stays text; age_txt is protected."""
    code = F.concat(F.lit("n/a "), F.col("l_linenumber").cast("string"), F.lit("-"), F.col("q_txt"))
    return C.sweep_numeric(V.dirty(t).withColumn("code_txt", code), exclude=("age_txt",))


_BEHAVIOUR_SQL = """CASE o_orderpriority WHEN '1-URGENT' THEN ' Low_spent_Small_value_payments '
  WHEN '2-HIGH' THEN 'High_spent_Large_value_payments' WHEN '3-MEDIUM' THEN '!@9#%8' WHEN '5-LOW' THEN 'Low_spent'
  ELSE CASE o_orderstatus WHEN 'F' THEN 'NA' WHEN 'O' THEN '' END END"""


@query(
    "normalise_category",
    f"""SELECT o_orderkey, CASE WHEN TRIM({_BEHAVIOUR_SQL}) IN ({', '.join(f"'{v}'" for v in PAYMENT_BEHAVIOURS)})
    THEN TRIM({_BEHAVIOUR_SQL}) ELSE 'Unknown' END AS behaviour FROM orders""",
)
def normalise_category(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    raw = (
        F.when(priority == "1-URGENT", " Low_spent_Small_value_payments ")
        .when(priority == "2-HIGH", "High_spent_Large_value_payments")
        .when(priority == "3-MEDIUM", "!@9#%8")
        .when(priority == "5-LOW", "Low_spent")
        .when(F.col("o_orderstatus") == "F", "NA")
        .when(F.col("o_orderstatus") == "O", "")
    )
    return t["orders"].select("o_orderkey", S.normalise_category(raw, PAYMENT_BEHAVIOURS).alias("behaviour"))


@query(
    "parse_years_months",
    f"""WITH {V.DIRTY} SELECT l_orderkey, l_linenumber,
      TRY_CAST(NULLIF(REGEXP_EXTRACT(age_txt, '(\\d+)\\s*Years', 1), '') AS INT) AS years,
      TRY_CAST(NULLIF(REGEXP_EXTRACT(age_txt, '(\\d+)\\s*Months', 1), '') AS INT) AS months FROM dirty""",
)
def parse_years_months(t: Tables) -> DataFrame:
    return V.dirty(t).select(
        "l_orderkey",
        "l_linenumber",
        S.duration_part("age_txt", "Years").alias("years"),
        S.duration_part("age_txt", "Months").alias("months"),
    )


@query(
    "occupation_known",
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN 0 ELSE 1 END AS is_occu_known
    FROM customer""",
)
def occupation_known(t: Tables) -> DataFrame:
    segment = F.col("c_mktsegment")
    occupation = F.when(segment == "MACHINERY", "  UnKnown ").when(segment != "HOUSEHOLD", segment)
    return t["customer"].select("c_custkey", S.is_known(occupation).alias("is_occu_known"))


@query(
    "typed_columns",
    """SELECT CAST(l_orderkey AS INT) AS l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(CASE l_linenumber % 7
      WHEN 0 THEN l_quantity * 10 WHEN 1 THEN l_quantity * 100 WHEN 2 THEN l_quantity * 1000 WHEN 3 THEN -l_quantity WHEN 4 THEN l_quantity + 0.5
      WHEN 5 THEN l_quantity END AS DOUBLE) AS q_txt, CAST(NULL AS DATE) AS asof FROM lineitem""",
)
def typed_columns(t: Tables) -> DataFrame:
    """Numbers with exponents, currency, separators, marks and none at all."""
    q, kind = F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber") % 7
    text = F.when(kind == 0, F.concat(q, F.lit("E1_"))).when(kind == 1, F.concat(F.lit("$"), q, F.lit("e2"))).when(kind == 2, F.concat(q, F.lit(",000 ")))
    text = text.when(kind == 3, F.concat(F.lit("-"), q, F.lit("%"))).when(kind == 4, F.concat(q, F.lit(".5E+0"))).when(kind == 5, q).otherwise("n/a")
    schema = StructType.fromDDL("l_orderkey int, l_linenumber double, q_txt double, asof date")
    return C.enforce_schema(t["lineitem"].select("l_orderkey", "l_linenumber", text.alias("q_txt")), schema)


# Text columns by year of the order: whole numbers that outgrow an int, numbers that get a fraction, numbers that turn into text, text,
# and a column that is empty at first.
_YEAR = "YEAR(o_orderdate)"
_TYPES_SQL = f"""y AS (SELECT DISTINCT CAST({_YEAR} AS INT) AS year FROM orders), types AS (
  SELECT 'whole_txt' AS "column", year, 'bigint' AS type FROM y UNION ALL
  SELECT 'price_txt', year, CASE WHEN year >= 1998 THEN 'double' ELSE 'bigint' END FROM y UNION ALL
  SELECT 'mixed_txt', year, CASE WHEN year = 1999 THEN 'string' ELSE 'bigint' END FROM y UNION ALL
  SELECT 'code_txt', year, 'string' FROM y UNION ALL
  SELECT 'late_txt', year, CASE WHEN year >= 1997 THEN 'bigint' ELSE 'void' END FROM y), merged AS (
  SELECT 'whole_txt' AS "column", 'bigint' AS merged_type UNION ALL SELECT 'price_txt', 'double' UNION ALL SELECT 'mixed_txt', 'string' UNION ALL
  SELECT 'code_txt', 'string' UNION ALL SELECT 'late_txt', 'bigint')"""


def _yearly(t: Tables) -> DataFrame:
    year, key = F.year("o_orderdate"), F.col("o_orderkey")
    return t["orders"].select(
        year.alias("year"),
        F.when(year >= 1999, key * 10_000_000_000).otherwise(key).cast("string").alias("whole_txt"),
        F.when(year >= 1998, F.concat(key.cast("string"), F.lit(".25"))).otherwise(F.concat(F.lit("$"), key.cast("string"))).alias("price_txt"),
        F.when(year == 1999, F.lit("lost")).otherwise(F.concat(key.cast("string"), F.lit("_"))).alias("mixed_txt"),
        F.concat(F.lit("c"), F.lit("-"), F.col("o_orderpriority")).alias("code_txt"),
        F.when(year >= 1997, (key % 100).cast("string")).alias("late_txt"),
    )


@query("column_types", f"""WITH {_TYPES_SQL} SELECT "column", year, type, merged_type FROM types JOIN merged USING ("column")""")
def column_types(t: Tables) -> DataFrame:
    """The type of each text column in each year, and the one that holds for all years: it only moves up."""
    types = C.column_types(C.numeric_profile(_yearly(t), exclude=(), by=["year"]))
    return types.join(C.merged_types(types).withColumnRenamed("type", "merged_type"), "column")


@query("type_drift", f"""WITH {_TYPES_SQL} SELECT "column", year, type, merged_type FROM types JOIN merged USING ("column") WHERE type <> merged_type""")
def type_drift(t: Tables) -> DataFrame:
    return C.type_drift(C.column_types(C.numeric_profile(_yearly(t), exclude=(), by=["year"])), "year")


@query(
    "schema_consistency",
    f"""WITH y AS (SELECT DISTINCT CAST({_YEAR} AS INT) AS year FROM orders), c AS (
      SELECT 'o_orderkey' AS "column", year, CASE WHEN year >= 2000 THEN 'bigint' ELSE 'int' END AS type, 'int' AS common_type FROM y UNION ALL
      SELECT 'total', year, CASE WHEN year = 1996 THEN 'string' ELSE 'double' END, 'double' FROM y UNION ALL
      SELECT 'status', year, CASE WHEN year < 1997 THEN 'absent' ELSE 'string' END, 'string' FROM y)
    SELECT "column", CAST(year AS VARCHAR) AS partition, type, common_type, type <> common_type AS differs FROM c""",
)
def schema_consistency(t: Tables) -> DataFrame:
    """Yearly folders, written at different times with different types and columns: their schemas as a table."""
    root, frames = scratch_dir(t.spark, "schemas"), {}
    dated = t["orders"].withColumn("year", F.year("o_orderdate"))
    for (year,) in sorted(dated.select("year").distinct().collect()):
        columns = [F.col("o_orderkey").cast("bigint" if year >= 2000 else "int"), F.col("o_totalprice").cast("string" if year == 1996 else "double").alias("total")]
        columns += [F.col("o_orderstatus").alias("status")] if year >= 1997 else []
        dated.where(F.col("year") == year).select(*columns).write.parquet(f"{root}/year={year}")
        frames[str(year)] = t.spark.read.parquet(f"{root}/year={year}")
    return P.schema_table(t.spark, frames)


_LINE = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]


@query(
    "dedup_latest",
    f"""SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship, {', '.join(_LINE)} FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
             {', '.join(f'{c} DESC' for c in _LINE)}) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_latest(t: Tables) -> DataFrame:
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("ship"), *_LINE)
    return C.keep_one_per_grain(lines, ["l_orderkey", "l_linenumber"], ["ship"])


@query(
    "first_row_per_key",
    """SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS first_date FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def first_row_per_key(t: Tables) -> DataFrame:
    first = first_rows(t["orders"], ["o_custkey"], [F.asc("o_orderdate"), F.asc("o_orderkey")])
    return first.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("first_date"))


@query(
    "duplicate_groups",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)
def duplicate_groups(t: Tables) -> DataFrame:
    return P.duplicate_groups(t["lineitem"], ["l_orderkey", "l_linenumber"])


@query(
    "key_quality",
    """SELECT COUNT(*) AS n_rows, COUNT(*) - COUNT(o_custkey) AS n_null_keys, COUNT(DISTINCT o_custkey) AS n_keys FROM orders""",
)
def key_quality(t: Tables) -> DataFrame:
    return C.key_quality(t["orders"], "o_custkey")


@query(
    "drop_personal_data",
    "SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal FROM customer",
)
def drop_personal_data(t: Tables) -> DataFrame:
    return C.drop_personal_data(t["customer"], ["c_name"])


# ---- ages ----


@query(
    "age_band",
    """SELECT p_partkey, p_size AS age, CASE WHEN p_size < 25 THEN '18-24' WHEN p_size < 35 THEN '25-34'
      WHEN p_size < 45 THEN '35-44' WHEN p_size < 55 THEN '45-54' ELSE '55+' END AS age_band,
      CASE WHEN p_size < 25 THEN 1 ELSE 0 END AS age_band_18_24,
      CASE WHEN p_size >= 25 AND p_size < 35 THEN 1 ELSE 0 END AS age_band_25_34,
      CASE WHEN p_size >= 35 AND p_size < 45 THEN 1 ELSE 0 END AS age_band_35_44,
      CASE WHEN p_size >= 45 AND p_size < 55 THEN 1 ELSE 0 END AS age_band_45_54,
      CASE WHEN p_size >= 55 THEN 1 ELSE 0 END AS age_band_55, 0 AS "age_band_Unknown",
      CASE WHEN p_size BETWEEN 18 AND 40 THEN p_size END AS age_clean,
      CASE WHEN p_size BETWEEN 18 AND 100 THEN 0 ELSE 1 END AS age_invalid_flag FROM part""",
)
def age_band(t: Tables) -> DataFrame:
    ages = t["part"].select("p_partkey", F.col("p_size").alias("age"))
    return ages.withColumns(
        {
            "age_band": S.age_band("age"),
            **G.age_flags("age"),
            "age_clean": S.plausible_age("age", 18, 40),
            "age_invalid_flag": S.flag(S.plausible_age("age", 18, 100).isNull()),
        }
    )


@query(
    "age_unit_profile",
    """SELECT CASE WHEN a <= 0 THEN '<=0' WHEN a >= 18 AND a <= 100 THEN '18-100_ok'
        WHEN a > 120 AND a / 365.25 >= 15 AND a / 365.25 <= 100 THEN 'looks_days'
        WHEN a > 120 AND a / 12.0 >= 15 AND a / 12.0 <= 100 THEN 'looks_months'
        WHEN a > 120 THEN '>120_other' ELSE 'other' END AS unit, COUNT(*) AS n
       FROM (SELECT p_size * p_size * 10 AS a FROM part) GROUP BY 1""",
)
def age_unit_profile(t: Tables) -> DataFrame:
    ages = t["part"].select((F.col("p_size") * F.col("p_size") * 10).alias("a"))
    return P.value_counts(ages.select(S.age_unit("a").alias("unit")), "unit")


# ---- encodings ----

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "one_hot_segment",
    "SELECT c_custkey, "
    + ", ".join(f"CASE WHEN c_mktsegment = '{v}' THEN 1 ELSE 0 END AS segment_{v}" for v in SEGMENTS)
    + " FROM customer",
)
def one_hot_segment(t: Tables) -> DataFrame:
    return t["customer"].select("c_custkey", *[c.alias(n) for n, c in S.one_hot("c_mktsegment", SEGMENTS, "segment").items()])


TYPES = ("ECO", "STANDARD", "PROMO", "SMALL", "MEDIUM", "LARGE")


@query(
    "multi_hot_contains",
    "SELECT p_partkey, "
    + ", ".join(f"CASE WHEN p_type LIKE '%{v}%' THEN 1 ELSE 0 END AS type_{v}" for v in TYPES)
    + " FROM part",
)
def multi_hot_contains(t: Tables) -> DataFrame:
    return t["part"].select("p_partkey", *[c.alias(n) for n, c in S.multi_hot("p_type", TYPES, "type").items()])


@query(
    "multi_hot_list",
    """SELECT p_partkey, CASE WHEN p_type = 'PROMO' OR p_brand = 'PROMO' THEN 1 ELSE 0 END AS loan_type__PROMO,
       CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS loan_type__ECONOMY,
       CASE WHEN p_brand = 'Brand#1' THEN 1 ELSE 0 END AS "loan_type__Brand#1",
       CASE WHEN p_type = p_brand THEN 1 ELSE 2 END AS loan_type_count FROM part""",
)
def multi_hot_list(t: Tables) -> DataFrame:
    text = F.concat("p_type", F.lit(", "), "p_brand", F.lit(", and "), "p_type")
    flags = S.list_hot(text, ("PROMO", "ECONOMY", "Brand#1"), "loan_type__")
    return t["part"].select("p_partkey", *[c.alias(n) for n, c in flags.items()], S.list_size(text).alias("loan_type_count"))


@query(
    "top_k_one_hot",
    """WITH top AS (SELECT p_brand, COUNT(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 3),
       ranked AS (SELECT p_brand, ROW_NUMBER() OVER (ORDER BY n DESC, p_brand) AS rk FROM top)
       SELECT p.p_partkey, p.p_brand, CASE WHEN r.rk = 1 THEN 1 ELSE 0 END AS top_1,
         CASE WHEN r.rk = 2 THEN 1 ELSE 0 END AS top_2, CASE WHEN r.rk = 3 THEN 1 ELSE 0 END AS top_3
       FROM part p LEFT JOIN ranked r ON r.p_brand = p.p_brand""",
)
def top_k_one_hot(t: Tables) -> DataFrame:
    """The flags are named after the values found; renamed by rank here so that the schema is fixed."""
    flags = G.one_hot_top(t["part"].select("p_partkey", "p_brand"), "p_brand", 3, "brand")
    names = flags.columns[2:]
    return flags.withColumnsRenamed({c: f"top_{i}" for i, c in enumerate(names, 1)})


# ---- capacity and request ----

_INCOME = "c.c_acctbal * 10"


@query(
    "capacity_features",
    f"""WITH {V.APPS_O} SELECT a.loan_id, ROUND(CASE WHEN {_INCOME} > 0 THEN a.loan_amt / ({_INCOME}) END, 6) AS DTI,
      ROUND(CASE WHEN {_INCOME} > 0 THEN LN({_INCOME}) END, 6) AS log_Annual_Income,
      CASE WHEN {_INCOME} < 20000 THEN '0-20k' WHEN {_INCOME} < 50000 THEN '20-50k' WHEN {_INCOME} < 100000 THEN '50-100k'
           ELSE '100k+' END AS income_band,
      ROUND(CASE WHEN {_INCOME} > 0 THEN a.loan_amt / ({_INCOME}) END, 6) AS Loan_to_Income,
      ROUND(a.loan_amt / a.tenure, 4) AS avg_instalment
      FROM apps_o a JOIN customer c ON c.c_custkey = a.customer_id""",
)
def capacity_features(t: Tables) -> DataFrame:
    joined = V.apps_o(t).join(t["customer"], F.col("c_custkey") == F.col("customer_id"))
    joined = joined.withColumn("income", F.col("c_acctbal") * 10)
    columns = G.capacity("income", "loan_amt") | G.exposure("loan_amt", "income", tenure="tenure")
    digits = {"DTI": 6, "log_Annual_Income": 6, "Loan_to_Income": 6, "avg_instalment": 4}
    return joined.select(
        "loan_id", *[(F.round(c, digits[n]) if n in digits else c).alias(n) for n, c in columns.items()]
    )


@query(
    "emi",
    f"""WITH {V.APPS_O}, e AS (SELECT a.*, c.c_acctbal AS income, a.loan_amt * 0.01 * POW(1.01, tenure) / (POW(1.01, tenure) - 1) AS p
      FROM apps_o a JOIN customer c ON c.c_custkey = a.customer_id)
    SELECT loan_id, ROUND(p, 4) AS estimated_EMI, ROUND(CASE WHEN income > 0 THEN p / (income / 12) END, 6) AS EMI_to_income,
      loan_amt AS requested_amount, tenure AS requested_tenure FROM e""",
)
def emi(t: Tables) -> DataFrame:
    joined = V.apps_o(t).join(t["customer"], F.col("c_custkey") == F.col("customer_id"))
    columns = G.request_features("loan_amt", "tenure", "c_acctbal")
    columns["estimated_EMI"] = F.round(columns["estimated_EMI"], 4)
    columns["EMI_to_income"] = F.round(columns["EMI_to_income"], 6)
    return joined.select("loan_id", *[c.alias(n) for n, c in columns.items()])


# ---- a whole cleaner ----

_SILVER_COLUMNS = (
    "Customer_ID", "snapshot_date", "asof_date", "Annual_Income", "Outstanding_Debt", "Num_of_Delayed_Payment", "DTI",
    "Payment_Behaviour", "Credit_History_Age_Year", "Credit_History_Age_Month", "loan_type__AutoLoan",
    "loan_type__PaydayLoan", "loan_type__StudentLoan", "loan_type_count",
)


@query(
    "silver_financials",
    f"""WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS "Customer_ID", CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS m,
      o_totalprice AS income, CAST(o_orderkey AS DOUBLE) AS debt, CAST(SUBSTR(o_orderpriority, 1, 1) AS INT) AS delayed,
      o_orderstatus AS st, {_BEHAVIOUR_SQL} AS behaviour, o_orderkey AS k FROM orders),
    d AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "Customer_ID", m ORDER BY income DESC, k DESC) AS rn FROM r)
    SELECT "Customer_ID", m AS snapshot_date, m AS asof_date, income AS "Annual_Income", debt AS "Outstanding_Debt",
      delayed AS "Num_of_Delayed_Payment", ROUND(CASE WHEN income > 0 THEN debt / income END, 8) AS "DTI",
      CASE WHEN TRIM(behaviour) IN ({', '.join(f"'{v}'" for v in PAYMENT_BEHAVIOURS)}) THEN TRIM(behaviour) ELSE 'Unknown' END
        AS "Payment_Behaviour",
      CASE WHEN st = 'F' THEN NULL ELSE CAST(k % 30 AS DOUBLE) END AS "Credit_History_Age_Year",
      CAST(k % 12 AS INT) AS "Credit_History_Age_Month",
      CASE WHEN st <> 'O' THEN 1 ELSE 0 END AS "loan_type__AutoLoan", CASE WHEN st = 'P' THEN 1 ELSE 0 END AS "loan_type__PaydayLoan",
      0 AS "loan_type__StudentLoan", CASE st WHEN 'P' THEN 2 WHEN 'F' THEN 1 ELSE 0 END AS loan_type_count
    FROM d WHERE rn = 1""",
)
def silver_financials(t: Tables) -> DataFrame:
    """Dirty text of every order through the cleaner of the financials table."""
    status, key, priority = F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_orderpriority")
    months = F.concat(key % 12, F.lit(" Months"))
    raw = t["orders"].select(
        F.col("o_custkey").cast("string").alias("Customer_ID"),
        F.concat(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("_")).alias("Annual_Income"),
        F.concat(F.lit(" "), key.cast("string"), F.lit(" ")).alias("Outstanding_Debt"),
        F.concat(F.substring(priority, 1, 1), F.lit("_")).alias("Num_of_Delayed_Payment"),
        F.when(status == "P", "Auto Loan, and Payday Loan").when(status == "F", "Auto Loan").alias("Type_of_Loan"),
        F.when(status == "F", months).otherwise(F.concat(key % 30, F.lit(" Years and "), months)).alias("Credit_History_Age"),
        F.when(priority == "1-URGENT", " Low_spent_Small_value_payments ")
        .when(priority == "2-HIGH", "High_spent_Large_value_payments")
        .when(priority == "3-MEDIUM", "!@9#%8")
        .when(priority == "5-LOW", "Low_spent")
        .otherwise("NA")
        .alias("Payment_Behaviour"),
        F.trunc(F.to_date("o_orderdate"), "MM").cast("string").alias("snapshot_date"),
    )
    schema, keys = SOURCES["features_financials"]
    return C.clean_financials(raw, schema, keys).withColumn("DTI", F.round("DTI", 8)).select(*_SILVER_COLUMNS)
