from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions import scalars as S
from riskflow.operators import dataset as D
from riskflow.operators import profiling as P
from riskflow.operators.cleaning import fill_numeric
from riskflow.queries import views as V
from riskflow.queries.registry import Tables, query
from riskflow.sources import tables as T

# ---- joins ----


@query(
    "left_join_features",
    f"""WITH {V.APPS_O} SELECT a.loan_id, a.customer_id, a.application_date, c.c_mktsegment, c.c_acctbal, n.n_name
    FROM apps_o a LEFT JOIN customer c ON c.c_custkey = a.customer_id AND c.c_acctbal > 0
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
)
def left_join_features(t: Tables) -> DataFrame:
    solvent = t["customer"].where("c_acctbal > 0").withColumnRenamed("c_custkey", "customer_id")
    nations = t["nation"].withColumnRenamed("n_nationkey", "c_nationkey")
    return (
        V.apps_o(t)
        .join(solvent, "customer_id", "left")
        .join(nations, "c_nationkey", "left")
        .select("loan_id", "customer_id", "application_date", "c_mktsegment", "c_acctbal", "n_name")
    )


@query(
    "assemble_by_customer_and_date",
    f"""WITH {V.APPS_E}, {V.CLICKS} SELECT a.customer_id, a.application_date AS snapshot_date, a.label,
    ROUND(k.fe_1, 4) AS fe_1, ROUND(k.fe_4, 4) AS fe_4 FROM (SELECT *, CASE WHEN application_id < 0 THEN 1 ELSE 0 END AS label
    FROM apps_e) a JOIN clicks k ON k.customer_id = a.customer_id AND k.snapshot_date = a.application_date""",
)
def assemble_by_customer_and_date(t: Tables) -> DataFrame:
    labels = V.apps_e(t).select(
        "customer_id",
        F.col("application_date").alias("snapshot_date"),
        F.when(F.col("application_id") < 0, 1).otherwise(0).alias("label"),
    )
    features = V.clicks(t).select("customer_id", "snapshot_date", F.round("fe_1", 4).alias("fe_1"), F.round("fe_4", 4).alias("fe_4"))
    return D.assemble(labels, features, on=("customer_id", "snapshot_date"))


@query(
    "outer_chain",
    """WITH a AS (SELECT o_custkey, COUNT(*) AS n_high FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1),
    b AS (SELECT o_custkey, COUNT(*) AS n_low FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1),
    c AS (SELECT o_custkey, MAX(o_totalprice) AS max_final FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
    SELECT o_custkey, COALESCE(n_high, 0) AS n_high, COALESCE(n_low, 0) AS n_low, COALESCE(max_final, 0) AS max_final
    FROM a FULL JOIN b USING (o_custkey) FULL JOIN c USING (o_custkey)""",
)
def outer_chain(t: Tables) -> DataFrame:
    """Three aggregates that the outer joins would glue together are one conditional aggregate. Keys that fall
    into none of the three are absent from a chain of outer joins, so they are filtered."""
    priority = F.col("o_orderpriority")
    rows = t["orders"].where(priority.isin("2-HIGH", "5-LOW") | (F.col("o_orderstatus") == "F"))
    return rows.groupBy("o_custkey").agg(
        F.count_if(priority == "2-HIGH").alias("n_high"),
        F.count_if(priority == "5-LOW").alias("n_low"),
        F.coalesce(F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))), F.lit(0.0)).alias("max_final"),
    )


@query(
    "outer_join",
    """WITH a AS (SELECT user_id AS k, COUNT(*) AS n_events FROM events GROUP BY 1),
    b AS (SELECT o_custkey AS k, COUNT(*) AS n_orders FROM orders GROUP BY 1)
    SELECT k, n_events, n_orders FROM a FULL JOIN b USING (k)""",
)
def outer_join(t: Tables) -> DataFrame:
    events = t["events"].groupBy(F.col("user_id").alias("k")).agg(F.count(F.lit(1)).alias("n_events"))
    orders = t["orders"].groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    return events.join(orders, "k", "outer")


@query(
    "right_join_apps",
    f"""WITH {V.APPS_E}, {V.CLICKS} SELECT a.customer_id, a.application_date, a.application_id, k.snapshot_date,
    ROUND(k.fe_2, 4) AS fe_2 FROM (SELECT * FROM clicks WHERE fe_2 > 100) k
    RIGHT JOIN apps_e a ON a.customer_id = k.customer_id AND a.application_date = k.snapshot_date""",
)
def right_join_apps(t: Tables) -> DataFrame:
    busy = V.clicks(t).where("fe_2 > 100").withColumn("application_date", F.col("snapshot_date"))
    return (
        busy.join(V.apps_e(t), ["customer_id", "application_date"], "right")
        .select("customer_id", "application_date", "application_id", "snapshot_date", F.round("fe_2", 4).alias("fe_2"))
    )


@query(
    "aliased_join",
    """SELECT l.o_orderkey, l.o_custkey, l.o_totalprice, f.c_acctbal, f.c_mktsegment,
    ROUND(CASE WHEN f.c_acctbal > 0 THEN l.o_totalprice / f.c_acctbal END, 6) AS loan_to_income
    FROM orders l JOIN customer f ON f.c_custkey = l.o_custkey""",
)
def aliased_join(t: Tables) -> DataFrame:
    loans, customers = t["orders"].alias("l"), t["customer"].alias("f")
    return loans.join(customers, F.col("l.o_custkey") == F.col("f.c_custkey")).select(
        "l.o_orderkey",
        "l.o_custkey",
        "l.o_totalprice",
        "f.c_acctbal",
        "f.c_mktsegment",
        F.round(F.when(F.col("f.c_acctbal") > 0, F.col("l.o_totalprice") / F.col("f.c_acctbal")), 6).alias("loan_to_income"),
    )


@query(
    "inner_suffix",
    f"""WITH {V.APPS_E}, {V.CLICKS} SELECT a.customer_id, a.snapshot_date AS snapshot_date_label,
    k.snapshot_date AS snapshot_date_feat, a.n AS n_label, k.n AS n_feat
    FROM (SELECT customer_id, MIN(application_date) AS snapshot_date, COUNT(*) AS n FROM apps_e GROUP BY 1) a
    JOIN (SELECT customer_id, MAX(snapshot_date) AS snapshot_date, COUNT(*) AS n FROM clicks GROUP BY 1) k
    ON k.customer_id = a.customer_id""",
)
def inner_suffix(t: Tables) -> DataFrame:
    count = F.count(F.lit(1)).alias("n")
    left = V.apps_e(t).groupBy("customer_id").agg(F.min("application_date").alias("snapshot_date"), count)
    right = V.clicks(t).groupBy("customer_id").agg(F.max("snapshot_date").alias("snapshot_date"), count)
    left, right = D.rename_collisions(left, right, ["customer_id"], ("_label", "_feat"))
    return left.join(right, "customer_id")


@query(
    "flag_join",
    """WITH bad AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
    SELECT o.o_orderkey, CASE WHEN b.l_orderkey IS NULL THEN 0 ELSE 1 END AS returned
    FROM orders o LEFT JOIN bad b ON b.l_orderkey = o.o_orderkey""",
)
def flag_join(t: Tables) -> DataFrame:
    returned = F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned")
    flags = t["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(returned)
    return t["orders"].select("o_orderkey").join(flags, "o_orderkey", "left").fillna({"returned": 0})


@query(
    "leakage_check",
    f"""WITH {V.APPS_O}, {V.FIN_O}
    SELECT COUNT(CASE WHEN f.snapshot_date = a.application_date THEN 1 END) AS pairs_same_day,
           COUNT(CASE WHEN f.snapshot_date < a.application_date THEN 1 END) AS pairs_before,
           COUNT(CASE WHEN f.snapshot_date > a.application_date THEN 1 END) AS pairs_after
    FROM apps_o a JOIN fin_o f ON f.customer_id = a.customer_id""",
)
def leakage_check(t: Tables) -> DataFrame:
    return P.leakage_counts(V.fin_o(t), V.apps_o(t), key="customer_id")


@query(
    "same_day_rows",
    f"""WITH {V.APPS_O}, {V.FIN_O} SELECT f.* FROM fin_o f WHERE EXISTS (SELECT 1 FROM apps_o a
    WHERE a.customer_id = f.customer_id AND a.application_date = f.snapshot_date)""",
)
def same_day_rows(t: Tables) -> DataFrame:
    return P.same_day_rows(V.fin_o(t), V.apps_o(t), key="customer_id")


# ---- set operations ----


@query(
    "union_missing_cols",
    f"""WITH {V.APPS_O}, {V.FIN_O} SELECT customer_id, application_date, loan_amt, NULL AS credit_mix FROM apps_o
    UNION ALL SELECT customer_id, snapshot_date, NULL, credit_mix FROM fin_o""",
)
def union_missing_cols(t: Tables) -> DataFrame:
    applications = V.apps_o(t).select("customer_id", "application_date", "loan_amt")
    history = V.fin_o(t).select("credit_mix", F.col("snapshot_date").alias("application_date"), "customer_id")
    return T.union_snapshots([applications, history])


@query(
    "union_strict",
    f"""WITH {V.APPS_E}, {V.CLICKS} SELECT customer_id, application_date AS day FROM apps_e
    UNION ALL SELECT customer_id, snapshot_date FROM clicks""",
)
def union_strict(t: Tables) -> DataFrame:
    a = V.apps_e(t).select("customer_id", F.col("application_date").alias("day"))
    return T.union_snapshots([a, V.clicks(t).select(F.col("snapshot_date").alias("day"), "customer_id")], strict=True)


def _customers(t: Tables) -> dict[str, DataFrame]:
    return {
        "orders": t["orders"].select(F.col("o_custkey").alias("key")),
        "events": t["events"].select(F.col("user_id").alias("key")),
        "solvent": t["customer"].where("c_acctbal > 0").select(F.col("c_custkey").alias("key")),
    }


@query(
    "coverage_matrix",
    """WITH x AS (SELECT o_custkey AS key, 1 AS o, 0 AS e, 0 AS s FROM orders UNION ALL SELECT user_id, 0, 1, 0 FROM events
    UNION ALL SELECT c_custkey, 0, 0, 1 FROM customer WHERE c_acctbal > 0)
    SELECT key, MAX(o) AS orders, MAX(e) AS events, MAX(s) AS solvent FROM x GROUP BY 1""",
)
def coverage_matrix(t: Tables) -> DataFrame:
    return P.coverage(_customers(t), "key")


@query(
    "intersect_customers",
    """SELECT o_custkey AS key FROM orders INTERSECT SELECT user_id FROM events
    INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0""",
)
def intersect_customers(t: Tables) -> DataFrame:
    return P.common_keys(_customers(t), "key")


# ---- filters and null policies ----


@query(
    "filter_predicates",
    """SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1998-06-30'
      AND o_orderstatus IN ('F', 'O') AND o_orderpriority ILIKE '%low%' AND o_totalprice >= 1000""",
)
def filter_predicates(t: Tables) -> DataFrame:
    """Range, membership, case-insensitive pattern and threshold in one filter; the range reaches the scan."""
    orders = t["orders"].where(F.col("o_orderstatus").isin("F", "O") & (F.col("o_totalprice") >= 1000))
    orders = orders.where(
        (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-07-01").cast("timestamp_ntz"))
        & F.col("o_orderpriority").rlike("(?i)low")
    )
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"))


@query(
    "drop_null_rows",
    f"""WITH {V.CLICKS} SELECT customer_id, snapshot_date, ROUND(fe_1, 4) AS fe_1, ROUND(fe_2, 4) AS fe_2 FROM clicks
    WHERE fe_1 IS NOT NULL AND fe_2 IS NOT NULL""",
)
def drop_null_rows(t: Tables) -> DataFrame:
    kept = V.clicks(t).dropna(subset=["fe_1", "fe_2"])
    return kept.select("customer_id", "snapshot_date", F.round("fe_1", 4).alias("fe_1"), F.round("fe_2", 4).alias("fe_2"))


@query(
    "fill_numeric",
    f"""WITH {V.CLICKS} SELECT customer_id, snapshot_date, {', '.join(f'ROUND(COALESCE(fe_{i}, 0), 4) AS fe_{i}' for i in range(1, 5))},
    ROUND(COALESCE(fe_1, 0) + COALESCE(fe_2, 0) + COALESCE(fe_3, 0) + COALESCE(fe_4, 0), 4) AS total_activity FROM clicks""",
)
def fill_numeric_columns(t: Tables) -> DataFrame:
    names = [f"fe_{i}" for i in range(1, 5)]
    filled = fill_numeric(V.clicks(t).withColumn("total_activity", S.row_sum(names)), 0, ["customer_id"])
    return filled.withColumns({c: F.round(c, 4) for c in [*names, "total_activity"]})


@query(
    "fill_by_column",
    f"""WITH {V.CLICKS} SELECT customer_id, snapshot_date, ROUND(COALESCE(fe_1, -1), 4) AS fe_1,
    ROUND(COALESCE(fe_2, 7.5), 4) AS fe_2, ROUND(fe_3, 4) AS fe_3 FROM clicks""",
)
def fill_by_column(t: Tables) -> DataFrame:
    filled = V.clicks(t).fillna({"fe_1": -1.0, "fe_2": 7.5}).drop("fe_4")
    return filled.withColumns({c: F.round(c, 4) for c in ("fe_1", "fe_2", "fe_3")})


@query(
    "finite_values",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount = 0 THEN NULL ELSE ROUND(l_tax / l_discount, 6) END AS tax_share,
    LEAST(GREATEST(l_quantity, 5.0), 40.0) AS quantity FROM lineitem""",
)
def finite_values(t: Tables) -> DataFrame:
    infinite = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_tax") / F.col("l_discount"))
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        F.round(S.finite(infinite), 6).alias("tax_share"),
        S.clip("l_quantity", 5.0, 40.0).alias("quantity"),
    )


@query(
    "scalar_functions",
    """SELECT o_orderkey, ROUND(LOG10(o_totalprice + 1), 6) AS log_price, CAST(CEIL(o_totalprice / 1000) AS BIGINT) AS up,
    CAST(FLOOR(o_totalprice / 1000) AS BIGINT) AS down, ROUND(ABS(o_totalprice - 100000), 2) AS distance,
    CAST(o_orderdate - INTERVAL 3 MONTH AS DATE) AS quarter_before, CAST(DATE_TRUNC('month', o_orderdate) AS DATE) AS month,
    LOWER(TRIM(o_orderpriority)) AS priority, LENGTH(o_orderpriority) AS size, REPLACE(o_orderpriority, '-', '_') AS slug FROM orders""",
)
def scalar_functions(t: Tables) -> DataFrame:
    price, day = F.col("o_totalprice"), F.to_date("o_orderdate")
    return t["orders"].select(
        "o_orderkey",
        F.round(F.log10(price + 1), 6).alias("log_price"),
        F.ceil(price / 1000).alias("up"),
        F.floor(price / 1000).alias("down"),
        F.round(F.abs(price - 100000), 2).alias("distance"),
        F.add_months(day, -3).alias("quarter_before"),
        F.trunc(day, "MM").alias("month"),
        F.lower(F.trim("o_orderpriority")).alias("priority"),
        F.length("o_orderpriority").cast("bigint").alias("size"),
        F.regexp_replace("o_orderpriority", "-", "_").alias("slug"),
    )
