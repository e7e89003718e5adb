"""Labels of samples: forward returns and excursions over the bars after a sample's window."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.guards import require_empty
from tapeloom.operators.features import positive_zero

#: The type of a label that is not a double.
KINDS = {"forward_direction": "long"}
FORWARD = ("forward_return", "forward_direction")
EXCURSION = ("maximum_favorable_excursion", "maximum_adverse_excursion")


@dataclass(frozen=True)
class LabelSpec:
    """A named output: a transform and its horizon in bars."""

    name: str
    transform: str
    horizon: int


def _value(kind: str, anchor: Column, target: Column, window: Column) -> Column:
    if kind == "forward_return":
        return target["close"] / anchor["close"] - 1
    if kind == "forward_direction":
        return F.signum(target["close"] - anchor["close"])
    if kind == "maximum_favorable_excursion":
        return F.greatest(F.lit(0.0), F.array_max(F.transform(window, lambda x: x["high"])) / anchor["close"] - 1)
    return F.least(F.lit(0.0), F.array_min(F.transform(window, lambda x: x["low"])) / anchor["close"] - 1)


def require_row_contract(resolved: DataFrame, reqs: DataFrame) -> None:
    """Every label row lies in its sample's code, label window and anchor date."""
    rows = resolved.filter("role = 'LABEL'").select("sample_key", F.col("code").alias("_code"), "event_time", "market_calendar_date")
    r = rows.join(reqs.select("sample_key", "code", "label_window_start", "label_window_close", F.col("anchor_market_calendar_date").alias("_anchor")), "sample_key", "left")
    good = (F.col("code") == F.col("_code")) & (F.col("event_time") >= F.col("label_window_start")) & (F.col("event_time") < F.col("label_window_close")) & (F.col("market_calendar_date") == F.col("_anchor"))
    require_empty(r.filter(~F.coalesce(good, F.lit(False))).select("sample_key", "event_time"), "a label row breaks its sample's contract")


def needed(assoc: DataFrame, seconds: int) -> DataFrame:
    """The rows of an association that labels read: those of label windows, and the anchor's bar, one interval before the feature window's close."""
    anchor = F.unix_micros("feature_window_close") - F.unix_micros("event_time") == seconds * 1_000_000
    return assoc.filter((F.col("role") == "LABEL") | anchor)


def execute(samples: DataFrame, specs: list[LabelSpec], seconds: int) -> DataFrame:
    """One row for each sample and spec: sample_key, name, status, reason_code, value, end_time (availability of the last bar consumed).

    samples comes from features.gathered(). The anchor is the bar exactly one interval before the window's close, the
    target the bar exactly horizon - 1 intervals after it; nothing stands in for either. A forward label
    needs those two, an excursion all bars up to the target; its reasons come in the order missing target,
    missing first bar, missing bar between. A bar off the grid, or an anchor price of 0, raises.
    """
    step = seconds * 1_000_000
    close = F.unix_micros("feature_window_close")
    anchor = F.get(F.filter("past", lambda x: F.unix_micros(x["event_time"]) == close - step), 0)
    place = lambda x: F.unix_micros(x["event_time"]) - close
    off = F.exists("future", lambda x: (place(x) < 0) | (place(x) % step != 0))
    rows = []
    for s in specs:
        if s.transform not in FORWARD + EXCURSION or s.horizon < 1:
            raise ValueError(f"{s.name}: unknown transform or horizon")
        rows.append(_one(s, step, close, anchor, place))
    safe = samples.withColumn("future", F.when(off, F.raise_error(F.lit("a label bar is off the grid")).cast(samples.schema["future"].dataType)).otherwise(F.col("future")))
    return safe.select("sample_key", F.inline(F.array(*rows)))


def _one(s: LabelSpec, step: int, close: Column, anchor: Column, place) -> Column:
    target = F.get(F.filter("future", lambda x: place(x) == (s.horizon - 1) * step), 0)
    window = F.filter("future", lambda x: place(x) < s.horizon * step)
    reason = F.when(anchor.isNull(), "MISSING_ANCHOR_ROW").when(target.isNull(), "MISSING_TARGET_ROW")
    if s.transform in EXCURSION:
        reason = reason.when(~F.exists(window, lambda x: place(x) == 0), "INSUFFICIENT_ROWS").when(F.size(window) != s.horizon, "NON_CONTIGUOUS_ROWS")
        consumed = F.array_max(F.transform(window, lambda x: x["market_available_at"]))
    else:
        consumed = target["market_available_at"]
    value = F.when(anchor["close"] == 0, F.raise_error(F.lit(f"{s.name}: the anchor's price is 0")).cast("double")).otherwise(positive_zero(_value(s.transform, anchor, target, window)))
    return F.struct(
        F.lit(s.name).alias("name"), F.when(reason.isNull(), "COMPLETE").otherwise("INCOMPLETE").alias("status"), reason.alias("reason_code"), F.when(reason.isNull(), value).alias("value"),
        F.when(anchor.isNotNull(), consumed).alias("end_time"),
    )


def sample_status(values: DataFrame) -> DataFrame:
    """label_status and actual_label_end_time, the latest availability over a sample's labels; kept for incomplete ones."""
    return values.groupBy("sample_key").agg(
        F.when(F.bool_and(F.col("status") == "COMPLETE"), "COMPLETE").otherwise("INCOMPLETE").alias("label_status"), F.max("end_time").alias("actual_label_end_time")
    )
