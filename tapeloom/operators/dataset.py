"""Final datasets: wide rows, completion of the scope, balances, and a catalog of datasets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.identity import content_id
from tapeloom.guards import require_empty
from tapeloom.operators import splits


def split_samples(reqs: DataFrame, feature_status: DataFrame, label_status: DataFrame) -> DataFrame:
    """Samples with complete features and their labels' status."""
    done = feature_status.filter("feature_status = 'COMPLETE'").select("sample_key")
    return reqs.select("sample_key", "code", "feature_window_close").join(done, "sample_key").join(label_status, "sample_key")


def _wide(values: DataFrame, names: list[str]) -> DataFrame:
    """One column for each name, in one aggregation."""
    return values.groupBy("sample_key").agg(*(F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names))


def rows(assigned: DataFrame, features: DataFrame, labels: DataFrame, feature_names: list[str], label_names: list[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """The dataset: a row for each sample with complete features; labels of an incomplete sample are null. kinds gives the type of a label that is not a double."""
    kinds = kinds or {}
    f, y = _wide(features, feature_names), _wide(labels, label_names)
    out = assigned.join(f, "sample_key").join(y, "sample_key", "left")
    complete = F.col("label_status") == "COMPLETE"
    return out.select(
        "code", "sample_key", "feature_window_close", "actual_label_end_time", "label_status", *feature_names, *(F.when(complete, F.col(n)).cast(kinds.get(n, "double")).alias(n) for n in label_names),
        "feature_window_close_date", "nominal_split", "final_split", "assignment_status", "reason_code", "purge_boundary",
    )


def completion(symbols: DataFrame, dates: DataFrame, reqs: DataFrame, feature_status: DataFrame, label_status: DataFrame) -> DataFrame:
    """code, trade_date, status, reason of the whole product of symbols and dates, which is the result: MISSING without a request, COMPLETE with a complete sample, else INCOMPLETE."""
    product = symbols.select("code").distinct().crossJoin(dates.select("trade_date").distinct())
    own = reqs.select("sample_key", "code", F.col("anchor_market_calendar_date").alias("trade_date")).join(feature_status, "sample_key", "left").join(label_status, "sample_key", "left")
    found = own.groupBy("code", "trade_date").agg(
        F.count("*").alias("n_samples"),
        F.bool_or((F.col("feature_status") == "COMPLETE") & (F.col("label_status") == "COMPLETE")).alias("_done"),
        F.bool_or(F.col("feature_status") == "COMPLETE").alias("_features"),
    )
    status = F.when(F.col("n_samples").isNull(), "MISSING").when(F.col("_done"), "COMPLETE").otherwise("INCOMPLETE")
    reason = F.when(status == "INCOMPLETE", F.when(F.col("_features"), "INCOMPLETE_LABELS").otherwise("NO_COMPLETE_FEATURES"))
    return product.join(found, ["code", "trade_date"], "left").select("code", "trade_date", F.coalesce("n_samples", F.lit(0)).alias("n_samples"), status.alias("status"), reason.alias("reason"))


def diagnostics(assigned: DataFrame, reqs: DataFrame) -> DataFrame:
    """One row of counts: requests = excluded by features + rows; rows = assigned + purged + excluded; assigned = train + validation + test."""
    n = lambda c, v: F.count_if(F.col(c) == v)
    own = assigned.agg(
        F.count("*").alias("n_rows"), n("assignment_status", "ASSIGNED").alias("n_assigned"), n("assignment_status", "PURGED").alias("n_purged"), n("assignment_status", "EXCLUDED").alias("n_excluded"),
        n("final_split", "TRAIN").alias("n_train"), n("final_split", "VALIDATION").alias("n_validation"), n("final_split", "TEST").alias("n_test"),
    )
    return own.join(reqs.agg(F.count("*").alias("n_requests"))).withColumn("n_without_features", F.col("n_requests") - F.col("n_rows"))  # one row each


def require_bound(reqs: DataFrame, symbols: DataFrame, dates: DataFrame, *sample_tables: DataFrame) -> None:
    """Requests lie in the scope, and every table of samples has just the requested ones: none that was not requested, and all that were."""
    outside = reqs.join(symbols.select("code"), "code", "left_anti").select("sample_key").union(
        reqs.join(dates.select(F.col("trade_date").alias("anchor_market_calendar_date")), "anchor_market_calendar_date", "left_anti").select("sample_key")
    )
    require_empty(outside, "a request lies outside the scope")
    for t in sample_tables:
        both = t.select("sample_key").distinct().withColumn("n", F.lit(1)).unionByName(reqs.select("sample_key").distinct().withColumn("n", F.lit(-1))).groupBy("sample_key").agg(F.sum("n").alias("n"))
        require_empty(both.filter("n <> 0"), "a sample was not requested, or a requested one is lost")


def ledger(reqs: DataFrame, symbols: DataFrame, dates: DataFrame, assoc: DataFrame, features: DataFrame, labels: DataFrame, assigned: DataFrame) -> DataFrame:
    """One row for each sample that any table of a job names, with what each table has of it; one aggregation over all of them.

    sample_key, n_requests, in_scope (code and anchor date are those of symbols and dates), n_feature_rows and n_label_rows of the association, positions (of the
    feature rows: the last and 1), n_features, n_complete_features, n_labels, n_assigned.
    """
    known = reqs.select("sample_key", "code", F.col("anchor_market_calendar_date").alias("trade_date"))
    known = known.join(symbols.select("code").distinct().withColumn("_s", F.lit(True)), "code", "left").join(dates.select("trade_date").distinct().withColumn("_d", F.lit(True)), "trade_date", "left")
    parts = [
        known.select("sample_key", F.lit("request").alias("source"), (F.col("_s").isNotNull() & F.col("_d").isNotNull()).alias("good"), F.lit(None).cast("long").alias("position")),
        assoc.select("sample_key", F.col("role").alias("source"), F.lit(True).alias("good"), "position"),
        features.select("sample_key", F.lit("feature").alias("source"), (F.col("status") == "COMPLETE").alias("good"), F.lit(None).cast("long").alias("position")),
        labels.select("sample_key", F.lit("label").alias("source"), F.lit(True).alias("good"), F.lit(None).cast("long").alias("position")),
        assigned.select("sample_key", F.lit("assigned").alias("source"), F.lit(True).alias("good"), F.lit(None).cast("long").alias("position")),
    ]
    rows, source = reduce(DataFrame.unionByName, parts), F.col("source")
    n = lambda s: F.count_if(source == s)
    return rows.groupBy("sample_key").agg(
        n("request").alias("n_requests"), F.coalesce(F.bool_and(F.when(source == "request", F.col("good"))), F.lit(False)).alias("in_scope"), n("FEATURE").alias("n_feature_rows"), n("LABEL").alias("n_label_rows"),
        F.coalesce(F.max(F.when(source == "FEATURE", F.col("position"))) + 1, F.lit(0)).alias("positions"), n("feature").alias("n_features"), F.count_if((source == "feature") & F.col("good")).alias("n_complete_features"),
        n("label").alias("n_labels"), n("assigned").alias("n_assigned"),
    )


def ledger_rules(n_features: int, n_labels: int) -> dict:
    """What each row of a ledger must keep, as conditions under which it does not. Lost samples break them as well as ones that were never requested."""
    return {
        "a sample was not requested": F.col("n_requests") == 0,
        "two requests have one key": F.col("n_requests") > 1,
        "a request lies outside the scope": ~F.col("in_scope"),
        "positions of a sample have gaps": F.col("positions") != F.col("n_feature_rows"),
        "a sample lacks features or has some twice": F.col("n_features") != n_features,
        "a sample lacks labels or has some twice": F.col("n_labels") != n_labels,
        "a sample comes twice, or is lost, or has incomplete features": F.col("n_assigned") != F.when(F.col("n_complete_features") == n_features, 1).otherwise(0),
    }


def materialize(df: DataFrame, root: str, facts: dict[str, str] | None = None) -> tuple[str, str]:
    """Write a dataset once under the id of its content; a finished one of the same content is verified and used again. Returns (id, path).

    The manifest (id, rows, assigned and purged rows, and the job's facts) is written last; without it a dataset is unfinished and written again.
    """
    from tapeloom.sources import tables

    spark = df.sparkSession
    own = content_id(df).first()[0]
    path = f"{root}/dataset_id={own}"
    if tables.read_manifest(spark, path) is not None:
        tables.verified_dataset(spark, f"{path}/rows", own, df.schema)
        return own, path
    tables.write_dataset(df, f"{path}/rows", mode="overwrite")
    tables.write_manifest(spark, path, {"dataset_id": own} | _balances(df) | (facts or {}))
    return own, path


def _balances(df: DataFrame) -> dict[str, str]:
    """Rows of a dataset in all and by assignment status."""
    n = df.agg(F.count("*").alias("n_rows"), *(F.count_if(F.col("assignment_status") == s).alias(f"n_{s.lower()}") for s in ("ASSIGNED", "PURGED", "EXCLUDED"))).first()
    return {k: str(v) for k, v in n.asDict().items()}


def verified(spark: SparkSession, path: str, own: str, spec: splits.SplitSpec, schema=None) -> DataFrame:
    """A dataset whose manifest, content id, row counts by status and split columns are those derived again; else raises."""
    from tapeloom.sources import tables

    facts = tables.read_manifest(spark, path)
    if facts is None or facts["dataset_id"] != own:
        raise ValueError(f"{path} is not a finished dataset {own}")
    df = tables.verified_dataset(spark, f"{path}/rows", own, schema)
    found = _balances(df)
    if {k: facts.get(k) for k in found} != found or int(found["n_rows"]) != sum(int(v) for k, v in found.items() if k != "n_rows"):
        raise ValueError(f"row counts of {path} are not those of its manifest: {found}")
    require_empty(splits.mismatches(df, spec), "stored split columns are not the derived ones")
    return df


def page(df: DataFrame, offset: int, limit: int) -> DataFrame:
    """A page of rows as JSON, in the order of the dataset."""
    return df.orderBy("code", "feature_window_close", "sample_key").offset(offset).limit(limit).select(F.to_json(F.struct(*df.columns)).alias("row"))
