"""The layers as whole plans: all months of a table in one plan, one write per table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators import applications as apps
from riskflow.operators import dataset, labels, metrics, modeling, profiles, stages, state
from riskflow.operators.cleaning import CLEANERS, LINEAGE, Cast, apply_casts, casts_of, column_types, merged_types, numeric_profile, require_columns
from riskflow.operators.features import build_features, top_values
from riskflow.schemas import MONITORING, PREDICTIONS, SOURCES
from riskflow.session import scratch_dir
from riskflow.sources import sinks, tables


def bronze(spark: SparkSession, csv: str, table: str, root: str, dates: Sequence[str] | None = None) -> str:
    """Raw rows as text, all columns as they are, one partition per snapshot date, with the file they came from. The text of
    the date stays in ``snapshot_text``, also where it can't be read as a date."""
    raw = tables.read_raw_csv(spark, csv, lineage=True)
    raw = raw.withColumns({"snapshot_text": F.col("snapshot_date"), "snapshot_date": F.col("snapshot_date").try_cast("date")})
    if dates:
        raw = tables.at_snapshots(raw, dates)
    return sinks.write_snapshots(raw, f"{root}/bronze/{table}")


def swept_casts(spark: SparkSession, table: str, root: str, raw: DataFrame) -> tuple[list[Cast], list[date]]:
    """Casts for the text columns that no schema declares, and the stored dates whose columns have a lower type than that.

    The types of each snapshot's text columns are kept (``types/<table>``, one row per column and snapshot); a column has the
    highest one, so types only move up and do not depend on which months a run happens to read.
    """
    schema, keys = SOURCES[table]
    path = f"{root}/types/{table}"
    declared = [*schema.fieldNames(), *keys, *LINEAGE, "snapshot_text"]
    before = tables.read_table(spark, path, missing="none")
    low = {} if before is None else {r["column"]: r["type"] for r in merged_types(before).collect()}
    found = column_types(numeric_profile(raw, exclude=declared, by=["snapshot_date"]))
    sinks.write_snapshots(found, path)
    types = merged_types(tables.read_table(spark, path))
    risen = [r["column"] for r in types.collect() if low.get(r["column"], r["type"]) != r["type"]]
    old = set(tables.stored_dates(spark, f"{root}/silver/{table}")) if risen else set()
    return casts_of(types), sorted(old)


def silver(
    spark: SparkSession,
    table: str,
    root: str,
    dates: Sequence[str] | None = None,
    only_new: bool = False,
    casts: Sequence[Cast] = (),
    sweep: bool = False,
    only_changed: bool = False,
) -> str:
    """Typed, deduplicated snapshots: all months, some months, the months not yet there, or those whose raw files were written
    since they were last cleaned (told by folders and file times, noted in ``watermarks/<table>``). Of several rows of a key the
    newest delivery stays, with its file and time.

    Declared columns get their declared types; ``casts`` types the rest, the same way in every snapshot, or, with ``sweep``,
    the types kept for the table. When a kept type rises, the stored months are built again with it.
    """
    schema, keys = SOURCES[table]
    bronze_rows = tables.read_table(spark, f"{root}/bronze/{table}")
    raw, target = bronze_rows, f"{root}/silver/{table}"
    watermark = f"{root}/watermarks/{table}"
    changed = tables.changed_dates(spark, f"{root}/bronze/{table}", watermark) if only_changed else {}
    if only_changed:
        if not changed:
            return target
        dates = sorted(changed)
    if only_new:
        held = set(tables.stored_dates(spark, target))
        here = tables.stored_dates(spark, f"{root}/bronze/{table}")
        dates = [d for d in (here if dates is None else (date.fromisoformat(str(d)) for d in dates)) if d not in held]
        if not dates:
            return target
    if dates:
        raw = tables.at_snapshots(raw, dates)
    require_columns(raw, keys, table)
    if sweep:
        casts, again = swept_casts(spark, table, root, raw)
        if dates and again:
            raw = tables.at_snapshots(bronze_rows, sorted({*again, *(date.fromisoformat(str(d)) for d in dates)}))
    raw = apply_casts(raw.drop("snapshot_text"), casts)
    cleaned = CLEANERS[table](raw, schema, keys)
    sinks.write_snapshots(cleaned, target)
    if changed:
        noted = spark.createDataFrame(sorted(changed.items()), "snapshot_date date, modified long")
        sinks.write_snapshots(noted, watermark)
    return target


def profile(spark: SparkSession, root: str, table: str, layer: str = "silver", exact: Sequence[str] = ()) -> DataFrame:
    """The profile of a stored table, one row per column; ``n_distinct`` and the most frequent value beside it for the columns
    named in ``exact``.

    Profiles are kept per snapshot (``profiles/<layer>/<table>``); only snapshots that were written since are read again, told by
    folders and file times. Value counts are kept the same way, from the first run that asks for a set of columns on.
    """
    source, kept = f"{root}/{layer}/{table}", f"{root}/profiles/{layer}/{table}"
    rows = tables.read_table(spark, source, merge_schema=True)

    def renew(path: str, make) -> DataFrame:
        changed = tables.changed_dates(spark, source, f"{path}_seen")
        if changed:
            sinks.write_snapshots(make(tables.at_snapshots(rows, sorted(changed))), path)
            noted = spark.createDataFrame(sorted(changed.items()), "snapshot_date date, modified long")
            sinks.write_snapshots(noted, f"{path}_seen")
        return tables.read_table(spark, path)

    by = ["snapshot_date"]
    stored = renew(kept, lambda new: profiles.partition_profiles(new, by))
    out = profiles.read_profile(profiles.merge_profiles(stored))
    if not exact:
        return out
    counts = renew(f"{kept}_values_{'_'.join(sorted(exact))}", lambda new: profiles.value_counts_of(new, by, sorted(exact)))
    return out.join(profiles.exact_distinct(counts), "column", "left")


def profile_report(spark: SparkSession, root: str, table: str, layer: str = "silver", exact: Sequence[str] = ()) -> str:
    """The profile as one small file. Columns that the table does not have are left out of ``exact``."""
    here = tables.read_table(spark, f"{root}/{layer}/{table}", merge_schema=True).columns
    out = profile(spark, root, table, layer, [c for c in exact if c in here])
    return sinks.write_report(out, f"{root}/reports/profiles/{layer}/{table}", ["column"])


def application_table(spark: SparkSession, root: str, choice: str = "latest", first: str | None = None, last: str | None = None) -> str:
    loans = tables.read_table(spark, f"{root}/silver/lms_loan_daily")
    chosen = apps.select_dates(apps.application_store(loans), choice, first, last)
    return sinks.write_snapshots(chosen, f"{root}/gold/application_store", "application_date")


def categories(spark: SparkSession, root: str, asof: str | None = None, top: int = 15, refit: bool = False) -> list[str]:
    """The occupations that get a flag: fitted once, on what was known by ``asof``, then read from the store, so that all
    months of the feature store have the same columns."""
    path = f"{root}/gold/categories"
    stored = None if refit else tables.read_table(spark, path, missing="none")
    if stored is None:
        attributes = tables.read_table(spark, f"{root}/silver/features_attributes", missing="none")
        if attributes is None:
            return []
        known = tables.up_to(attributes, asof) if asof else attributes
        ranked = top_values(known, "Occupation", top).withColumn("column", F.lit("Occupation"))
        ranked.select("column", F.col("Occupation").alias("value"), "count").write.mode("overwrite").parquet(path)
        stored = tables.read_table(spark, path)
    return [r[0] for r in stored.where("column = 'Occupation'").orderBy(F.desc("count"), "value").select("value").collect()]


def customer_state(spark: SparkSession, root: str, through: str) -> None:
    """Merge the newest state before a day with the snapshots since, up to the day. Older snapshots are not read."""
    end = date.fromisoformat(through)
    for name, kept in state.feature_states().items():
        rows = tables.read_table(spark, f"{root}/silver/{name}", missing="none")
        if rows is None:
            continue
        path = f"{root}/gold/customer_state/{name}"
        before = state.newest_state(spark, path, end)
        since = tables.up_to(rows, through)
        since = since if before is None else since.where(F.col("snapshot_date") > F.lit(before))
        state.write_state(state.merge(state.read_state(spark, path, before), since, kept, through), path, through)


def feature_history(spark: SparkSession, root: str, name: str, first: date, last: date) -> DataFrame | None:
    """What applications from ``first`` to ``last`` need of a source: the newest state before ``first`` and the snapshots since."""
    rows = tables.read_table(spark, f"{root}/silver/{name}", missing="none")
    if rows is None:
        return None
    path = f"{root}/gold/customer_state/{name}"
    before = state.newest_state(spark, path, first)
    since = rows.where(F.col("snapshot_date") <= F.lit(last))
    since = since if before is None else since.where(F.col("snapshot_date") > F.lit(before))
    return state.history(state.read_state(spark, path, before), since, state.feature_states()[name], before, last)


def request_features(spark: SparkSession, root: str, requests: DataFrame) -> DataFrame:
    """Features of applications passed by a caller, as the batch build gives them: from the buckets of their customers in the newest
    state before the earliest request, and the snapshots since. Nothing is written."""
    first, last = requests.agg(F.min("application_date"), F.max("application_date")).first()
    found = []
    for name in state.feature_states():
        rows = tables.read_table(spark, f"{root}/silver/{name}", missing="none")
        if rows is None or first is None:
            found.append(None if rows is None else rows.limit(0))
            continue
        path = f"{root}/gold/customer_state/{name}"
        before = state.newest_state(spark, path, first)
        since = rows.where(F.col("snapshot_date") <= F.lit(last))
        since = since if before is None else since.where(F.col("snapshot_date") > F.lit(before))
        since = since.join(requests.select("Customer_ID").distinct(), "Customer_ID", "left_semi")
        kept = state.read_state(spark, path, before)
        kept = None if kept is None else state.of_customers(kept, requests)
        found.append(state.history(kept, since, state.feature_states()[name], before, last))
    return build_features(requests, *found, top_occupations=categories(spark, root)).drop("income_band")


def score_requests(spark: SparkSession, root: str, model_name: str, requests: DataFrame) -> DataFrame:
    """Predictions of the newest model for applications passed by a caller."""
    return modeling.predictions(*_ready(modeling.latest_model(spark, f"{root}/models/model_runs", model_name), request_features(spark, root, requests)), model_name)


def feature_table(
    spark: SparkSession,
    root: str,
    asof: str | None = None,
    strict: bool = False,
    top: int = 15,
    *,
    dates: Sequence[str] | None = None,
    only_new: bool = False,
) -> str:
    """Features of the stored applications: all of them, those up to a day, those of some days, or those of days that the
    feature store does not hold. Sources that do not exist leave their features out.

    Some days are built from the newest customer state before them and the snapshots since; other partitions of the
    store stay. Days are told by folder names, so no file of the other days is opened.
    """
    target = f"{root}/gold/feature_store"
    applications = tables.read_table(spark, f"{root}/gold/application_store")
    asked = None if dates is None else sorted(date.fromisoformat(d) for d in dates)
    if only_new:
        held = set(tables.stored_dates(spark, target))
        asked = [d for d in asked or tables.stored_dates(spark, f"{root}/gold/application_store", "application_date") if d not in held]
    if asked is not None:
        if not asked:
            return target
        applications = tables.at_snapshots(applications, asked, "application_date")
        known = lambda name: feature_history(spark, root, name, asked[0], asked[-1])
    else:

        def known(name: str) -> DataFrame | None:
            df = tables.read_table(spark, f"{root}/silver/{name}", missing="none")
            return tables.up_to(df, asof) if df is not None and asof else df

        if asof:
            applications = tables.up_to(applications, asof, "application_date")
    features = build_features(
        applications,
        known("features_financials"),
        known("features_attributes"),
        known("feature_clickstream"),
        strict=strict,
        top_occupations=categories(spark, root, asof, top),
    )
    return sinks.write_snapshots(features.drop("income_band"), target)


def label_table(spark: SparkSession, root: str, dpd: int = 30, mob: int = 1, dates: Sequence[str] | None = None) -> str:
    loans = tables.read_table(spark, f"{root}/silver/lms_loan_daily")
    if dates:
        loans = tables.at_snapshots(loans, dates)
    return sinks.write_snapshots(labels.snapshot_labels(loans, dpd, mob), f"{root}/gold/label_store", ["label_def", "snapshot_date"])


def stored_labels(spark: SparkSession, root: str, dpd: int, mob: int) -> DataFrame:
    """The stored labels of one definition; the others are not read."""
    stored = tables.read_table(spark, f"{root}/gold/label_store")
    return stored.where(F.col("label_def") == labels.definition(dpd, mob))


def ever_default_table(spark: SparkSession, root: str, asof: str, dpd: int = 30, mob: int = 0) -> str:
    """Ever-default labels of all loans known on a date, as one snapshot of that date."""
    loans = tables.read_asof(spark, f"{root}/silver/lms_loan_daily", asof, missing="raise")
    first = apps.first_snapshots(loans, asof).withColumn("application_date", F.col("loan_start_date"))
    out = labels.ever_default_labels(first, loans, dpd, mob).withColumn("snapshot_date", F.lit(asof).cast("date"))
    return sinks.write_snapshots(out, f"{root}/gold/ever_default_store")


def train(
    spark: SparkSession,
    root: str,
    train_date: str,
    kind: str = "lr",
    *,
    dpd: int = 30,
    mob: int = 1,
    n_trials: int = 10,
    parallelism: int = 4,
    select: int | None = None,
    balanced: bool = False,
) -> str:
    """Train on the window before the date, test out of time, save the model and log the run.

    Labels are those of one definition. A label belongs to the features taken ``mob`` months before its snapshot. With
    ``select`` the preprocessing is fitted too (see ``stages.preparation``): the ``select`` features that go with the label
    most, medians in place of nulls, and, if ``balanced``, class weights; it is saved with the model. Else nulls are 0 and all
    features are used.
    """
    window = dataset.time_split(train_date)
    y = tables.between(stored_labels(spark, root, dpd, mob), window.train_test_start, window.oot_end).withColumn("label_date", F.col("snapshot_date"))
    y = y.withColumn("snapshot_date", F.add_months("label_date", -mob)).drop("loan_id", "label_def")
    y = y.groupBy("Customer_ID", "snapshot_date", "label_date").agg(F.max("label").alias("label"))
    x = tables.read_table(spark, f"{root}/gold/feature_store")
    start, end = (spark.sql(f"SELECT add_months(DATE '{d}', {-mob})").first()[0] for d in (window.train_test_start, window.oot_end))
    x = tables.between(x, start, end)  # the window bounds the features too
    data = dataset.tag_time_split(dataset.assemble(y, x), window, "label_date")
    names = [c for c in dataset.feature_columns(data) if c != "label_date"]
    data = (data if select else data.fillna(0, subset=names)).withColumn("row_key", F.concat_ws("|", "Customer_ID", "snapshot_date"))
    data = sinks.materialise(data, scratch_dir(spark, "training_rows"))  # the split reads them several times

    inside = dataset.stratified_split(data.where("period = 'train_test'"), "label", "row_key")
    sets = inside.unionByName(data.where("period = 'oot'").withColumn("split", F.lit("oot")))
    name = f"credit_model_{kind.upper()}"
    version = f"{name}_{train_date.replace('-', '_')}"
    sets = sinks.materialise(sets, f"{root}/models/training_sets/{version}")
    weight = "weight" if select and balanced else None
    prepared = stages.preparation(names, k=select, weight=weight) if select else None
    best = modeling.search(
        sets.where("split = 'train'"),
        names,
        kind=kind,
        key="row_key",
        n_trials=n_trials,
        parallelism=parallelism,
        stages=prepared,
        weight=weight,
    )
    path = f"{root}/models/{version}"
    best.model.write().overwrite().save(path)

    saved = PipelineModel.load(path)
    modeling.record_run(
        spark,
        f"{root}/models/model_runs",
        model_name=name,
        model_path=path,
        train_date=train_date,
        parameters={**best.parameters, "cv_auc": best.cv_auc, "label_def": labels.definition(dpd, mob)},
        metrics=modeling.evaluate(saved, sets),
        sizes=dataset.split_stats(sets),
    )
    return path


def _ready(model: PipelineModel, features: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """The model, and features as it expects them: without nulls, unless its own stages fill them."""
    first = model.stages[0]
    return model, features.fillna(0, subset=first.getInputCols()) if isinstance(first, VectorAssembler) else features


def score(
    spark: SparkSession, root: str, model_name: str, dates: Sequence[date | str] | None = None, format: str = "parquet"
) -> str:
    """Predictions of the newest model for some months (or all), in one plan."""
    model = modeling.latest_model(spark, f"{root}/models/model_runs", model_name)
    features = tables.read_table(spark, f"{root}/gold/feature_store")
    if dates:
        features = tables.at_snapshots(features, dates)
    out = modeling.predictions(*_ready(model, features), model_name)
    return sinks.write_predictions(out, f"{root}/gold/model_predictions", format)


def monitor(
    spark: SparkSession,
    root: str,
    model_name: str,
    mode: str = "maturity",
    mob: int = 1,
    format: str = "parquet",
    dpd: int = 30,
    dates: Sequence[str] | None = None,
) -> str:
    """Monthly quality of the stored predictions against the labels of one definition that came in later.

    With ``dates`` (label months) only these are computed, from their labels and the predictions that they judge; the
    report keeps its other months.
    """
    stored = tables.read_table(spark, f"{root}/gold/model_predictions", schema=PREDICTIONS, format=format)
    predictions = stored.where(F.col("model_name") == model_name)
    known = stored_labels(spark, root, dpd, mob)
    path = f"{root}/gold/model_monitoring/{model_name}"
    if dates:
        known = tables.at_snapshots(known, dates)
        if mode != "customer":
            shift = mob if mode == "maturity" else 0
            months = [spark.sql(f"SELECT add_months(DATE '{d}', {-shift})").first()[0] for d in dates]
            predictions = tables.at_snapshots(predictions, months)
    outcomes = metrics.join_outcomes(predictions, known, mode, mob)
    report = metrics.monitoring(outcomes, weight="weight")
    before = tables.read_table(spark, path, schema=MONITORING, format="csv", missing="none") if dates else None
    if before is not None:
        # One row a month; they are read before their file is replaced.
        kept = before.where(~F.col("month").isin([F.lit(d).cast("date") for d in dates])).collect()
        report = spark.createDataFrame(kept, MONITORING).unionByName(report)
    return sinks.write_report(report, path, ["month"])
