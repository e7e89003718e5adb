"""Chronological train, validation and test splits with purging."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions import market_time as mt
from tapeloom.guards import require_empty


@dataclass(frozen=True)
class SplitSpec:
    """Last local dates of the three splits."""

    train_end: str
    validation_end: str
    test_end: str
    zone: str = mt.MARKET_ZONE

    def __post_init__(self):
        if not self.train_end < self.validation_end < self.test_end:
            raise ValueError("the ends of the splits must ascend")

    def boundary(self, end: str) -> Column:
        """The instant at which a split's last day is over."""
        return mt.next_local_midnight(F.lit(end).cast("date"), self.zone)


def nominal_split(day: Column, spec: SplitSpec) -> Column:
    return F.when(day <= F.lit(spec.train_end).cast("date"), "TRAIN").when(day <= F.lit(spec.validation_end).cast("date"), "VALIDATION").when(day <= F.lit(spec.test_end).cast("date"), "TEST")


def assigned(samples: DataFrame, spec: SplitSpec) -> DataFrame:
    """samples (feature_window_close, label_status, actual_label_end_time) with the split columns.

    In this order: after the test end, and with an incomplete label, a sample is EXCLUDED; a train or validation
    sample whose label ends at or behind its split's boundary is PURGED; others are ASSIGNED. A null close is after the end.
    """
    day = mt.market_date(F.col("feature_window_close"), spec.zone)
    rows = samples.withColumn("feature_window_close_date", day).withColumn("nominal_split", nominal_split(F.col("feature_window_close_date"), spec))
    edge = F.when(F.col("nominal_split") == "TRAIN", spec.boundary(spec.train_end)).when(F.col("nominal_split") == "VALIDATION", spec.boundary(spec.validation_end))
    crosses = F.coalesce(F.col("actual_label_end_time") >= edge, F.lit(False))
    reason = (
        F.when(F.col("nominal_split").isNull(), "FEATURE_CLOSE_AFTER_TEST_END")
        .when(F.col("label_status") == "INCOMPLETE", "INCOMPLETE_LABEL")
        .when(crosses, F.concat(F.lit("ACTUAL_LABEL_END_CROSSES_"), F.col("nominal_split"), F.lit("_BOUNDARY")))
    )
    rows = rows.withColumn("reason_code", reason)
    status = F.when(F.col("reason_code").isNull(), "ASSIGNED").when(F.col("reason_code").startswith("ACTUAL"), "PURGED").otherwise("EXCLUDED")
    rows = rows.withColumn("assignment_status", status)
    return rows.withColumn("final_split", F.when(F.col("assignment_status") == "ASSIGNED", F.col("nominal_split"))).withColumn("purge_boundary", F.when(F.col("assignment_status") == "PURGED", edge))


def require_unique_samples(samples: DataFrame) -> None:
    require_empty(samples.groupBy("sample_key").count().filter("count > 1"), "a sample comes twice")


def split_counts(rows: DataFrame) -> DataFrame:
    """Samples by status, split and reason."""
    return rows.groupBy("assignment_status", "nominal_split", "reason_code").agg(F.count("*").alias("n_samples"))


def mismatches(stored: DataFrame, spec: SplitSpec) -> DataFrame:
    """Rows whose stored split columns are not those derived again."""
    own = ["feature_window_close_date", "nominal_split", "final_split", "assignment_status", "reason_code", "purge_boundary"]
    again = assigned(stored.drop(*own), spec).select("sample_key", *(F.col(c).alias(f"_{c}") for c in own))
    differs = F.lit(False)
    for c in own:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    return stored.join(again, "sample_key").filter(differs).select(*stored.columns)
