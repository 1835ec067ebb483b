"""The whole feature table, every column of it: from all histories at once, and month by month from stored state."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.constants import CREDIT_MIXES, LOAN_TYPES, PAYMENT_BEHAVIOURS, UNKNOWN
from riskflow.functions.scalars import slug
from riskflow.operators import features as G
from riskflow.operators import state as T
from riskflow.operators.ordered import first_rows
from riskflow.queries.registry import Tables, query
from riskflow.schemas import CLICK_COLUMNS
from riskflow.session import scratch_dir
from riskflow.sources import sinks, tables

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STATISTICS = {"sum": ("SUM", 0), "mean": ("AVG", 6), "std": ("STDDEV_SAMP", 6)}
ROUNDED = {"DTI": 6, "log_Annual_Income": 6, "Loan_to_Income": 6, "EMI_to_income": 6, "estimated_EMI": 4}
_CLICKS = [(c, s, d) for d in (7, 30) for c in CLICK_COLUMNS for s in STATISTICS]


def gold_inputs(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Applications, financials, attributes and clickstream in the schema of the cleaned tables, of all orders and their lines.

    Some loans have no customer, some customers no plausible age, some rows no income, no delay or no change of limit.
    """
    key = F.col("o_orderkey")
    customer = F.when(key % 50 != 0, F.col("o_custkey").cast("string")).alias("Customer_ID")
    day = F.to_date("o_orderdate")
    applications = t["orders"].where("o_orderpriority = '1-URGENT'").select(
        customer, day.alias("application_date"), F.col("o_totalprice").alias("loan_amt"), F.lit(10).alias("tenure")
    )
    joined = t["orders"].where("o_orderpriority <> '1-URGENT'").join(t["customer"], F.col("c_custkey") == F.col("o_custkey"))
    snapshots = first_rows(joined.withColumn("snapshot_date", day), ["o_custkey", "snapshot_date"], [F.desc("o_orderkey")])

    def choice(values, number):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))

    owner = F.col("o_custkey").cast("string").alias("Customer_ID")
    status = F.col("o_orderstatus")
    financials = snapshots.select(
        owner,
        "snapshot_date",
        F.when(key % 9 != 0, F.col("c_acctbal") * 10).alias("Annual_Income"),
        F.col("o_totalprice").alias("Outstanding_Debt"),
        choice((*PAYMENT_BEHAVIOURS, UNKNOWN), key).alias("Payment_Behaviour"),
        F.when(status == "P", "Standard").when(status == "F", "Good").otherwise("Bad").alias("Credit_Mix"),
        F.concat_ws(", and ", choice(LOAN_TYPES, key), choice(LOAN_TYPES, F.floor(key / 8))).alias("Type_of_Loan"),
        F.concat_ws("", key % 30, F.lit(" Years and "), key % 12, F.lit(" Months")).alias("Credit_History_Age"),
        (key % 9).cast("int").alias("Num_of_Loan"),
        F.when(key % 4 == 0, (key % 40).cast("int")).otherwise(0).alias("Num_of_Delayed_Payment"),
        F.when(key % 3 != 1, (key % 5) * 1.5).alias("Changed_Credit_Limit"),
    )
    attributes = snapshots.select(
        owner, "snapshot_date", (F.col("c_custkey") % 100).cast("int").alias("Age"), F.col("c_mktsegment").alias("Occupation")
    )
    clicks = (
        t["lineitem"]
        .join(t["orders"], F.col("o_orderkey") == F.col("l_orderkey"))
        .groupBy(owner, F.to_date("l_shipdate").alias("snapshot_date"))
        .agg(*[F.sum((F.col("l_quantity") * i) % 97 - 10).cast("int").alias(c) for i, c in enumerate(CLICK_COLUMNS, 1)])
    )
    return applications, financials, attributes, clicks


def _choice_sql(values, number: str) -> str:
    return f"CASE {number} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


APPLICATIONS_SQL = """SELECT CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer, CAST(o_orderdate AS DATE) AS day,
    o_totalprice AS loan_amt FROM orders WHERE o_orderpriority = '1-URGENT'"""
REQUESTS_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS customer, (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders) AS day, 10000 AS loan_amt FROM customer"""


def _gold_sql(applications: str) -> str:
    age, emi = "CASE WHEN la.age BETWEEN 18 AND 85 THEN la.age END", "a.loan_amt * 0.01 * POW(1.01, 10) / (POW(1.01, 10) - 1)"
    bands = {"18_24": "{0} < 25", "25_34": "{0} >= 25 AND {0} < 35", "35_44": "{0} >= 35 AND {0} < 45", "45_54": "{0} >= 45 AND {0} < 55", "55": "{0} >= 55", "Unknown": "{0} IS NULL"}
    one = lambda condition: f"CASE WHEN {condition} THEN 1 ELSE 0 END"
    outputs = {
        "Customer_ID": "a.customer", "application_date": "a.day", "snapshot_date": "a.day", "loan_amt": "a.loan_amt", "tenure": "10",
        "Annual_Income": "COALESCE(lf.income, 0)", "Outstanding_Debt": "COALESCE(lf.debt, 0)", "Age": "COALESCE(la.age, 0)",
        "Num_of_Loan_active": "COALESCE(lf.loans, 0)", "time_since_last_delay": "CAST(a.day - ld.late AS INT)",
        **{f"Num_of_Delayed_Payment_{h}": f"CAST(COALESCE(w.d{h}, 0) AS BIGINT)" for h in ("3m", "6m", "12m")},
        "max_dpd_prior": "COALESCE(w.worst, 0)", "ever_30dpd_prior": one("w.worst >= 30"),
        **{f"Changed_Credit_Limit_sum_{h}": f"ROUND(COALESCE(w.s{h}, 0), 2)" for h in ("3m", "6m")},
        **{f"count_credit_limit_changes_{h}": f"COALESCE(w.n{h}, 0)" for h in ("3m", "6m")},
        "DTI": "COALESCE(CASE WHEN lf.income > 0 THEN lf.debt / lf.income END, 0)",
        "log_Annual_Income": "COALESCE(CASE WHEN lf.income > 0 THEN LN(lf.income) END, 0)",
        "Loan_to_Income": "COALESCE(CASE WHEN lf.income > 0 THEN a.loan_amt / lf.income END, 0)",
        "income_band": "CASE WHEN lf.income < 20000 THEN '0-20k' WHEN lf.income < 50000 THEN '20-50k' WHEN lf.income < 100000 THEN '50-100k' WHEN lf.income IS NOT NULL THEN '100k+' END",
        **{f"Payment_Behaviour_{slug(v)}": one(f"lf.behaviour = '{v}'") for v in PAYMENT_BEHAVIOURS},
        **{f"Credit_Mix_{v}": one(f"lf.mix = '{v}'") for v in CREDIT_MIXES},
        **{f"Type_of_Loan_{slug(v)}": one(f"lf.type1 = '{v}' OR lf.type2 = '{v}'") for v in LOAN_TYPES},
        "loan_type_count": "CASE WHEN lf.type1 = lf.type2 THEN 1 WHEN lf.type1 IS NOT NULL THEN 2 ELSE 0 END",
        "Credit_History_Age_Year": "COALESCE(lf.years, 0)", "Credit_History_Age_Month": "COALESCE(lf.months, 0)",
        "estimated_EMI": emi, "EMI_to_income": f"COALESCE(CASE WHEN lf.income > 0 THEN {emi} / (lf.income / 12) END, 0)",
        "requested_amount": "a.loan_amt", "requested_tenure": "10",
        **{f"age_band_{n}": one(c.format(f"({age})")) for n, c in bands.items()},
        **{f"Occupation_{v}": one(f"la.segment = '{v}'") for v in SEGMENTS},
        **{f"{c}_sum_{d}d": f"CAST(COALESCE(ck.{c}_sum_{d}d, 0) AS BIGINT)" for c, s, d in _CLICKS if s == "sum"},
        **{f"{c}_{s}_{d}d": f"ROUND(COALESCE(ck.{c}_{s}_{d}d, 0), {STATISTICS[s][1]})" for c, s, d in _CLICKS if s != "sum"},
    }
    outputs |= {c: f"ROUND({outputs[c]}, {n})" for c, n in ROUNDED.items()}
    look = lambda d, x: f"CASE WHEN a.day - f.day <= {d} THEN {x} END"
    days = {"3m": 90, "6m": 180, "12m": 365}
    return f"""WITH a0 AS ({applications}),
    a AS (SELECT customer, day, max(loan_amt) AS loan_amt FROM a0 GROUP BY 1, 2),
    f0 AS (
      SELECT CAST(o_custkey AS VARCHAR) AS customer, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 9 <> 0 THEN c_acctbal * 10 END AS income,
        o_totalprice AS debt, {_choice_sql((*PAYMENT_BEHAVIOURS, UNKNOWN), "o_orderkey")} AS behaviour,
        CASE o_orderstatus WHEN 'P' THEN 'Standard' WHEN 'F' THEN 'Good' ELSE 'Bad' END AS mix, {_choice_sql(LOAN_TYPES, "o_orderkey")} AS type1,
        {_choice_sql(LOAN_TYPES, "(o_orderkey // 8)")} AS type2, CAST(o_orderkey % 30 AS INT) AS years, CAST(o_orderkey % 12 AS INT) AS months,
        CAST(o_orderkey % 9 AS INT) AS loans, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderkey % 40 AS INT) ELSE 0 END AS delayed,
        NULLIF(CASE WHEN o_orderkey % 3 <> 1 THEN (o_orderkey % 5) * 1.5::DOUBLE END, 0) AS changed, CAST(c_custkey % 100 AS INT) AS age, c_mktsegment AS segment
      FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority <> '1-URGENT'
      QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) = 1),
    f AS MATERIALIZED (SELECT * FROM f0),
    k AS MATERIALIZED (
      SELECT CAST(o_custkey AS VARCHAR) AS customer, CAST(l_shipdate AS DATE) AS day,
        {", ".join(f"CAST(SUM((l_quantity * {i}) % 97 - 10) AS INT) AS {c}" for i, c in enumerate(CLICK_COLUMNS, 1))}
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
    lf AS (SELECT a.day AS app, f.* FROM a JOIN f ON f.customer = a.customer AND f.day <= a.day
           QUALIFY row_number() OVER (PARTITION BY a.customer, a.day ORDER BY f.day DESC) = 1),
    la AS (SELECT app, customer, age, segment FROM lf),
    ld AS (SELECT a.customer, a.day, max(f.day) AS late FROM a JOIN f ON f.customer = a.customer AND f.day <= a.day AND f.delayed > 0 GROUP BY 1, 2),
    w AS (SELECT a.customer, a.day, max(delayed) AS worst, {", ".join(f"SUM({look(days[h], 'delayed')}) AS d{h}" for h in days)},
            {", ".join(f"SUM({look(days[h], 'changed')}) AS s{h}, COUNT({look(days[h], 'changed')}) AS n{h}" for h in ("3m", "6m"))}
          FROM a JOIN f ON f.customer = a.customer AND a.day - f.day BETWEEN 0 AND 365 GROUP BY 1, 2),
    ck AS (SELECT a.customer, a.day, {", ".join(f"{STATISTICS[s][0]}(CASE WHEN a.day - f.day <= {d} THEN {c} END) AS {c}_{s}_{d}d" for c, s, d in _CLICKS)}
           FROM a JOIN k f ON f.customer = a.customer AND a.day - f.day BETWEEN 0 AND 30 GROUP BY 1, 2)
    SELECT {", ".join(f"{x} AS {name}" for name, x in outputs.items())}
    FROM a LEFT JOIN lf ON lf.customer = a.customer AND lf.app = a.day LEFT JOIN la ON la.customer = a.customer AND la.app = a.day
           LEFT JOIN ld ON ld.customer = a.customer AND ld.day = a.day LEFT JOIN w ON w.customer = a.customer AND w.day = a.day
           LEFT JOIN ck ON ck.customer = a.customer AND ck.day = a.day"""


GOLD_SQL = _gold_sql(APPLICATIONS_SQL)


def _rounded(features: DataFrame) -> DataFrame:
    digits = ROUNDED | {f"Changed_Credit_Limit_sum_{h}": 2 for h in ("3m", "6m")} | {f"{c}_{s}_{d}d": STATISTICS[s][1] for c, s, d in _CLICKS if s != "sum"}
    return features.withColumns({c: F.round(c, n) for c, n in digits.items()})


@query("gold_features", GOLD_SQL)
def gold_features(t: Tables) -> DataFrame:
    return _rounded(G.build_features(*gold_inputs(t), top_occupations=SEGMENTS))


# ---- from stored state ----


def periods(first: date, last: date, years: int = 2) -> list[date]:
    """Last days of periods of some years, from the period of ``first`` to that of ``last``."""
    return [date(y + years - 1, 12, 31) for y in range(first.year // years * years, last.year + 1, years)]


@query("gold_features_from_state", GOLD_SQL)
def gold_features_from_state(t: Tables) -> DataFrame:
    """All applications, one period after the other: features from the state before it and the rows of the period only,
    then the state is merged with these rows. Must equal the build from the whole history."""
    root, kept = scratch_dir(t.spark, "customer_state"), T.feature_states()
    applications, *sources = gold_inputs(t)
    year = F.year("snapshot_date")
    end_of = F.make_date(year - F.pmod(year, F.lit(2)) + 1, F.lit(12), F.lit(31))
    names = ("applications", *kept)
    for name, df in zip(names, (applications.withColumnRenamed("application_date", "snapshot_date"), *sources)):
        sinks.write_snapshots(df.withColumn("period", end_of), f"{root}/source/{name}", "period")
    ends = [d for n in names for d in tables.stored_dates(t.spark, f"{root}/source/{n}", "period")]
    through = None
    for end in periods(min(ends), max(ends)):
        rows = {n: tables.at_snapshot(tables.read_table(t.spark, f"{root}/source/{n}"), end, "period").drop("period") for n in names}
        states = {n: T.read_state(t.spark, f"{root}/state/{n}", through) for n in kept}
        histories = [T.history(states[n], rows[n], kept[n], through, end) for n in kept]
        features = G.build_features(rows["applications"].withColumnRenamed("snapshot_date", "application_date"), *histories, top_occupations=SEGMENTS)
        sinks.write_snapshots(features.withColumn("period", F.lit(end)), f"{root}/features", "period")
        for n in kept:
            T.write_state(T.merge(states[n], rows[n], kept[n], end, buckets=4), f"{root}/state/{n}", end)
        through = end
    return _rounded(tables.read_table(t.spark, f"{root}/features").drop("period"))


@query("request_features", _gold_sql(REQUESTS_SQL))
def request_features(t: Tables) -> DataFrame:
    """A request of every customer on the last day of an order, from the state half a year before it and the rows since."""
    root, kept = scratch_dir(t.spark, "requests"), T.feature_states()
    last = t["orders"].agg(F.max(F.to_date("o_orderdate"))).first()[0]
    through = last - timedelta(182)
    histories = []
    requests = t["customer"].select(F.col("c_custkey").cast("string").alias("Customer_ID"), F.lit(last).alias("application_date"), F.lit(10_000).alias("loan_amt"), F.lit(10).alias("tenure"))
    for name, df in zip(kept, gold_inputs(t)[1:]):
        T.write_state(T.merge(None, df, kept[name], through, buckets=4), f"{root}/{name}", through)
        known = T.of_customers(T.read_state(t.spark, f"{root}/{name}", through), requests, buckets=4)
        histories.append(T.history(known, df, kept[name], through, last))
    return _rounded(G.build_features(requests, *histories, top_occupations=SEGMENTS))
