"""Features of samples: eight registered transforms over the last bars that a sample selected."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tapeloom.functions import market_time as mt
from tapeloom.functions.codes import finite
from tapeloom.guards import require_empty

BAR = ["event_time", "open", "high", "low", "close", "volume"]


@dataclass(frozen=True)
class Transform:
    """build gives the value over an array of bars, fault a condition under which it has none; least bounds the window.

    frame gives both over the last n rows of an ordered window; it is computed for every bar, so it must give null, not an
    error, where there is no value. A transform without it always goes by arrays.
    """

    build: Callable[[Column], Column]
    fault: Callable[[Column], Column]
    least: int
    fixed: bool = False
    frame: Callable[[WindowSpec, int], tuple[Column, Column]] | None = None


@dataclass(frozen=True)
class FeatureSpec:
    """A named output: a transform and its window in bars (None for a transform without one)."""

    name: str
    transform: str
    window_bars: int | None = None


def _mean(w: Column, field: str) -> Column:
    return F.aggregate(w, F.lit(0.0), lambda a, x: a + x[field]) / F.size(w)


def _deviation(w: Column) -> Column:
    """Population deviation in two passes."""
    mean = _mean(w, "close")
    return F.sqrt(F.aggregate(w, F.lit(0.0), lambda a, x: a + (x["close"] - mean) * (x["close"] - mean)) / F.size(w))


def _ends(w: Column) -> tuple[Column, Column]:
    return F.element_at(w, 1)["close"], F.element_at(w, -1)["close"]


def _earlier(w: Column) -> Column:
    return F.slice(w, 1, F.size(w) - 1)


def _never(_: Column) -> Column:
    return F.lit(False)


def _whole(c: Column, field: str, w: WindowSpec, n: int) -> Column:
    """c, if all n rows of the frame have the field; as a sum over an array, it is null otherwise."""
    return F.when(F.count(field).over(w) == n, c)


def _first_last(w: WindowSpec, n: int) -> tuple[Column, Column]:
    return F.lag("close", n - 1).over(w), F.col("close")


def _frame_ratio(w: WindowSpec, n: int) -> tuple[Column, Column]:
    before = w.rowsBetween(-(n - 1), -1)
    mean = _whole(F.avg("volume").over(before), "volume", before, n - 1)
    return F.try_divide(F.col("volume"), mean), mean <= 0


def _framed(c: Callable[[Column], Column], field: str):
    """A frame's aggregate that has no faults."""

    def over(w: WindowSpec, n: int) -> tuple[Column, Column]:
        own = w.rowsBetween(-(n - 1), 0)
        return _whole(c(F.col(field)).over(own), field, own, n), F.lit(False)

    return over


#: The registry. A user may add transforms; all of these are built-in expressions.
TRANSFORMS: dict[str, Transform] = {
    "simple_return": Transform(lambda w: _ends(w)[1] / _ends(w)[0] - 1, lambda w: _ends(w)[0] == 0, 2, frame=lambda w, n: (F.try_divide(*_first_last(w, n)[::-1]) - 1, _first_last(w, n)[0] == 0)),
    "log_return": Transform(lambda w: F.log(_ends(w)[1] / _ends(w)[0]), lambda w: (_ends(w)[0] <= 0) | (_ends(w)[1] <= 0), 2, frame=lambda w, n: (F.log(F.try_divide(*_first_last(w, n)[::-1])), (_first_last(w, n)[0] <= 0) | (_first_last(w, n)[1] <= 0))),
    "rolling_mean": Transform(lambda w: _mean(w, "close"), _never, 1, frame=_framed(F.avg, "close")),
    "rolling_std": Transform(_deviation, _never, 2, frame=_framed(F.stddev_pop, "close")),
    "rolling_volume_mean": Transform(lambda w: _mean(w, "volume"), _never, 1, frame=_framed(F.avg, "volume")),
    "volume_ratio": Transform(lambda w: F.element_at(w, -1)["volume"] / _mean(_earlier(w), "volume"), lambda w: _mean(_earlier(w), "volume") <= 0, 2, frame=_frame_ratio),
    "candle_range": Transform(lambda w: F.element_at(w, -1)["high"] - F.element_at(w, -1)["low"], lambda w: F.element_at(w, -1)["high"] < F.element_at(w, -1)["low"], 1, fixed=True, frame=lambda w, n: (F.col("high") - F.col("low"), F.col("high") < F.col("low"))),
    "candle_body": Transform(lambda w: F.element_at(w, -1)["close"] - F.element_at(w, -1)["open"], _never, 1, fixed=True, frame=lambda w, n: (F.col("close") - F.col("open"), F.lit(False))),
}


def with_bars(assoc: DataFrame, bars: DataFrame) -> DataFrame:
    """Associations with the values of their bar versions, joined where they do not carry them; a version without its bar is lost, so compare counts."""
    if set(BAR) <= set(assoc.columns):
        return assoc
    return assoc.join(bars.select("canonical_row_version_id", *BAR[1:]), "canonical_row_version_id")


def require_row_contract(resolved: DataFrame, reqs: DataFrame) -> None:
    """Every feature row lies in its sample's code and window and was known to the market at the close; positions run from 0."""
    rows = resolved.filter("role = 'FEATURE'").select("sample_key", "position", F.col("code").alias("_code"), "event_time", "market_available_at")
    r = rows.join(reqs.select("sample_key", "code", "feature_window_start", F.col("feature_window_close").alias("_close")), "sample_key", "left")
    bad = (
        F.col("code").isNull()
        | (F.col("code") != F.col("_code"))
        | (F.col("event_time") < F.col("feature_window_start"))
        | (F.col("event_time") >= F.col("_close"))
        | (F.col("market_available_at") > F.col("_close"))
    )
    require_empty(r.filter(bad).select("sample_key", "event_time"), "a feature row breaks its sample's contract")
    require_empty(rows.groupBy("sample_key").agg((F.max("position") + 1 - F.count_distinct("position")).alias("n")).filter("n <> 0"), "positions of a sample have gaps")


def gathered(resolved: DataFrame, reqs: DataFrame | None = None) -> DataFrame:
    """sample_key, anchor date, close of the window, and the sample's bars by role in the order of position. Both arrays are bounded by the windows of the request.

    With reqs there is a row for each request, also for one that no bar serves; its arrays are empty.
    """
    bar = F.struct("position", *BAR, "market_calendar_date", "market_available_at", "canonical_row_version_id")
    side = lambda role: F.array_sort(F.collect_list(F.when(F.col("role") == role, bar)))
    if reqs is not None:
        own = resolved.groupBy("sample_key").agg(side("FEATURE").alias("past"), side("LABEL").alias("future"))
        none = F.array().cast(own.schema["past"].dataType)
        every = reqs.select("sample_key", "code", F.col("anchor_market_calendar_date").alias("anchor"), "feature_window_close")
        return every.join(own, "sample_key", "left").withColumns({"past": F.coalesce("past", none), "future": F.coalesce("future", none)})
    return resolved.groupBy("sample_key").agg(
        F.first("code").alias("code"), F.first("anchor_market_calendar_date").alias("anchor"), F.first("feature_window_close").alias("feature_window_close"), side("FEATURE").alias("past"), side("LABEL").alias("future")
    )


def apart(w: Column, seconds: int) -> Column:
    """Some neighbours of w are not exactly one interval apart."""
    pairs = F.zip_with(_earlier(w), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.unix_micros(b["event_time"]) - F.unix_micros(a["event_time"]))
    return (F.size(w) > 1) & F.exists(pairs, lambda d: d != seconds * 1_000_000)


def positive_zero(x: Column) -> Column:
    return F.when(x == 0, F.lit(0.0)).otherwise(x)


def execute(samples: DataFrame, specs: list[FeatureSpec], seconds: int) -> DataFrame:
    """One row for each sample and spec: sample_key, name, status, reason_code, value, consumed (bar versions).

    samples comes from gathered(). Too few bars, then a bar off the anchor's date, then a distance that is not the
    interval exclude a sample; a value that arithmetic forbids, or that is not finite, raises. -0.0 is returned as 0.0.
    """
    rows = []
    for s in specs:
        t, n = TRANSFORMS[s.transform], _spec_window(s)
        w = F.slice("past", F.greatest(F.size("past") - (n - 1), F.lit(1)), n)
        reason = (
            F.when(F.size("past") < n, "INSUFFICIENT_ROWS")
            .when(F.exists(w, lambda x: ~x["market_calendar_date"].eqNullSafe(F.col("anchor"))), "CROSS_MARKET_DATE")
            .when(apart(w, seconds), "NON_CONTIGUOUS_ROWS")
        )
        own = t.build(w)
        value = F.when(t.fault(w) | ~finite(own), F.raise_error(F.lit(f"{s.name}: no value for this window")).cast("double")).otherwise(positive_zero(own))
        rows.append(
            F.struct(
                F.lit(s.name).alias("name"), F.when(reason.isNull(), "COMPLETE").otherwise("EXCLUDED").alias("status"), reason.alias("reason_code"), F.when(reason.isNull(), value).alias("value"),
                F.when(F.size("past") >= n, F.transform(w, lambda x: x["canonical_row_version_id"])).otherwise(F.array().cast("array<string>")).alias("consumed"),
            )
        )
    return samples.select("sample_key", F.inline(F.array(*rows)))


def _spec_window(s: FeatureSpec) -> int:
    t = TRANSFORMS[s.transform]
    n = 1 if t.fixed else s.window_bars
    if n is None or n < t.least:
        raise ValueError(f"{s.name}: {s.transform} needs a window of {t.least} bars or more")
    return n


#: A series of bars within a day; frames never leave it.
_DAY = ["code", "interval", "adjustment", "requested_session", "market_calendar_date"]


def sliding(bars: DataFrame, reqs: DataFrame, assoc: DataFrame, specs: list[FeatureSpec], seconds: int, as_of=None, stored: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """What execute() returns for every request, with n_consumed instead of the list of versions, without copying each bar into every window that holds it.

    Aggregates over row frames are computed once for each bar, by code and day, and joined to the request whose window ends
    with that bar. They stand only where they say what the selected rows would say: the bar is the window's last, the frame lies in the window and on the
    anchor's date, its bars are one interval apart, and all of them were known to the market at the close and, with as_of,
    to the archive. All other requests, also those whose features are EXCLUDED, go by the rows that they selected, through
    gathered(). stored, where given, keeps the joined table, which is read twice.
    """
    if any(TRANSFORMS[s.transform].frame is None for s in specs):
        return execute(gathered(assoc, reqs), specs, seconds).withColumn("n_consumed", F.size("consumed").cast("long")).drop("consumed")
    w, t = Window.partitionBy(*_DAY).orderBy("event_time"), F.col("event_time")
    known = F.lit(True) if as_of is None else F.coalesce(F.col("archive_available_at") <= F.lit(as_of).cast("timestamp"), F.lit(False))
    rows = bars.withColumns({"_step": F.unix_micros(t) - F.unix_micros(F.lag(t).over(w)), "_known": known, "_after": F.lead(t).over(w)})
    values, sizes = [], sorted({_spec_window(s) for s in specs})
    for n in sizes:
        own = w.rowsBetween(-(n - 1), 0)
        even = F.lit(True) if n == 1 else F.coalesce(F.count_if(F.col("_step") == seconds * 1_000_000).over(w.rowsBetween(-(n - 2), 0)) == n - 1, F.lit(False))
        whole = (F.count("*").over(own) == n) & even & F.min("_known").over(own)
        values.append(F.struct(whole.alias("whole"), F.lag(t, n - 1).over(w).alias("first"), F.max("market_available_at").over(own).alias("available")).alias(f"_w{n}"))
    for i, s in enumerate(specs):
        value, fault = TRANSFORMS[s.transform].frame(w, _spec_window(s))
        values.append(F.struct(value.alias("value"), F.coalesce(fault, F.lit(False)).alias("fault")).alias(f"_v{i}"))
    scope = _DAY[:-1]
    framed = rows.select(*scope, t.alias("_last"), F.col("market_calendar_date").alias("_date"), "_after", *values)
    asked = reqs.select("sample_key", *scope, F.col("anchor_market_calendar_date").alias("anchor"), "feature_window_start", "feature_window_close")
    asked = asked.withColumn("_last", F.col("feature_window_close") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds)))
    close = F.col("feature_window_close")
    last = (F.col("_date") == F.col("anchor")) & (F.col("_after").isNull() | (F.col("_after") >= close)) & (mt.market_date(close - F.expr("interval 1 microsecond")) == F.col("anchor"))
    for n in sizes:
        at = F.col(f"_w{n}")
        last = last & at["whole"] & (at["first"] >= F.col("feature_window_start")) & (at["available"].isNull() | (at["available"] <= close))
    joined = asked.join(framed, [*scope, "_last"], "left").withColumn("_whole", F.coalesce(last, F.lit(False)))
    joined = joined if stored is None else stored(joined, "frames")
    out = []
    for i, s in enumerate(specs):
        own = F.col(f"_v{i}")
        value = F.when(own["fault"] | ~finite(own["value"]), F.raise_error(F.lit(f"{s.name}: no value for this window")).cast("double")).otherwise(positive_zero(own["value"]))
        out.append(F.struct(F.lit(s.name).alias("name"), F.lit("COMPLETE").alias("status"), F.lit(None).cast("string").alias("reason_code"), value.alias("value"), F.lit(_spec_window(s)).cast("long").alias("n_consumed")))
    quick = joined.filter("_whole").select("sample_key", F.inline(F.array(*out)))
    others = joined.filter("not _whole").select("sample_key")
    rest = gathered(assoc.join(others, "sample_key", "left_semi"), reqs.join(others, "sample_key", "left_semi"))
    slow = execute(rest, specs, seconds).withColumn("n_consumed", F.size("consumed").cast("long")).drop("consumed")
    return quick.unionByName(slow)


def sample_status(values: DataFrame) -> DataFrame:
    """A sample is COMPLETE if all its features are."""
    return values.groupBy("sample_key").agg(F.when(F.bool_and(F.col("status") == "COMPLETE"), "COMPLETE").otherwise("EXCLUDED").alias("feature_status"))
