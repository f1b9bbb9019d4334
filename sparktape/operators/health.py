"""Feed health as aggregates over frames, ticks and the write log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import long_div
from ..functions.timeargs import NS_PER_SECOND
from ..schema import FEED

# Upper bounds of the write-latency histogram in seconds.
LATENCY_BOUNDS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]

# Feed age in seconds from which it is shown yellow and red.
STALE_YELLOW_S, STALE_RED_S = 30, 120


# -- counters ----------------------------------------------------------------------------------


def received(frames: DataFrame) -> DataFrame:
    return frames.groupBy(F.col("source").alias("exchange")).agg(F.count("*").alias("n_frames"))


def parsed(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy(*FEED).agg(F.count("*").alias("n_ticks"))


def parse_errors(decoded: DataFrame) -> DataFrame:
    """Failed frames per exchange; an exchange without failures shows 0."""
    failed = F.count_if(F.col("status") == "error")
    return decoded.groupBy(F.col("source").alias("exchange")).agg(failed.alias("n_errors"))


def frame_outcomes(decoded: DataFrame) -> DataFrame:
    """Frames per exchange and outcome; the outcomes add up to the frames received."""
    return decoded.groupBy(F.col("source").alias("exchange"), "status").agg(
        F.count("*").alias("n_frames"), F.sum(F.size("trades").cast("long")).alias("n_ticks")
    )


def written(write_log: DataFrame) -> DataFrame:
    return write_log.groupBy(*FEED).agg(F.sum("n_ticks").alias("n_ticks"))


def totals(decoded: DataFrame, write_log: DataFrame) -> DataFrame:
    """One row per counter over everything seen so far."""
    frames = decoded.agg(
        F.count("*").alias("received"), F.count_if(F.col("status") == "error").alias("parse_errors")
    ).selectExpr("stack(2, 'received', received, 'parse_errors', parse_errors) AS (counter, total)")
    writes = write_log.agg(F.coalesce(F.sum("n_ticks"), F.lit(0)).alias("total"))
    return frames.unionByName(writes.select(F.lit("written").alias("counter"), "total"))


# -- latency histogram ---------------------------------------------------------------------------


def _cumulative(value: Column, bounds: list[float]) -> Column:
    """Array of counts at or below each bound, the last one counting everything."""
    return F.array(*(F.count_if(value <= F.lit(b)) for b in bounds), F.count(value))


def latency_histogram(write_log: DataFrame, *keys: str) -> DataFrame:
    """Cumulative buckets with count and sum, from one aggregate of fixed width."""
    value = F.col("latency_s")
    labels = F.array(*(F.lit(f"{bound:g}") for bound in LATENCY_BOUNDS), F.lit("+Inf"))
    summary = write_log.groupBy(*keys).agg(
        _cumulative(value, LATENCY_BOUNDS).alias("counts"),
        F.count(value).alias("n_writes"),
        F.sum(value).alias("total_s"),
    )
    bucket = F.explode(F.arrays_zip(labels.alias("le"), F.col("counts")))
    return summary.select(*keys, bucket.alias("b"), "n_writes", "total_s").select(
        *keys, F.col("b.le"), F.col("b.counts").alias("cumulative"), "n_writes", "total_s"
    )


def bucket_quantile(counts: Column, bounds: list[float], q: float) -> Column:
    """Quantile estimated from cumulative buckets by linear interpolation inside one.

    The first bucket starts at zero; a rank beyond the last bound gives that bound.
    NULL without observations.
    """
    last = len(bounds)
    edges = F.array(*(F.lit(float(b)) for b in bounds))
    rank = F.lit(float(q)) * F.element_at(counts, last + 1)
    at = F.array_position(F.transform(counts, lambda c: c >= rank), True).cast("int")
    upper = F.get(edges, at - 1)
    lower = F.when(at > 1, F.get(edges, at - 2)).otherwise(0.0)
    below = F.when(at > 1, F.get(counts, at - 2)).otherwise(0)
    inside = F.get(counts, at - 1) - below
    return (
        F.when(F.element_at(counts, last + 1) == 0, F.lit(None))
        .when(at > last, F.lit(float(bounds[-1])))
        .when(inside == 0, lower)
        .otherwise(lower + (upper - lower) * (rank - below) / inside)
    )


QUANTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


def latency_quantiles(write_log: DataFrame, window_s: int | None = None) -> DataFrame:
    """p50, p95 and p99 write latency: overall, or per window of `window_s` seconds."""
    keys, rows = [], write_log
    if window_s is not None:
        width = window_s * NS_PER_SECOND
        rows = rows.withColumn("window_start_ns", long_div(F.col("at_ns"), width) * width)
        keys = ["window_start_ns"]
    counts = rows.groupBy(*keys).agg(_cumulative(F.col("latency_s"), LATENCY_BOUNDS).alias("c"))
    return counts.select(
        *keys,
        *(bucket_quantile(F.col("c"), LATENCY_BOUNDS, q).alias(n) for n, q in QUANTILES.items()),
    )


def latency_quantiles_of_values(
    write_log: DataFrame, *keys: str, accuracy: int | None = None
) -> DataFrame:
    """p50, p95 and p99 of the write latencies themselves, per group.

    Exact, by linear interpolation, with state that grows with the values; or with an
    `accuracy` from a sketch of bounded size: a value whose rank is off by at most one part
    in `accuracy`.
    """
    value, wanted = F.col("latency_s"), list(QUANTILES.values())
    q = F.percentile(value, wanted) if accuracy is None else F.percentile_approx(value, wanted, accuracy)
    found = write_log.groupBy(*keys).agg(F.count(value).alias("n_writes"), q.alias("q"))
    return found.withColumns({name: F.get("q", F.lit(i)) for i, name in enumerate(QUANTILES)}).drop("q")


# -- quantile sketches that merge ------------------------------------------------------------

# Size of a KLL sketch, and the greatest error of a rank that is to be expected of it (99 % of
# the time, as the authors of the sketch state it); merging does not add to the error.
SKETCH_K, SKETCH_RANK_ERROR = 800, 0.006


def latency_sketches(
    rows: DataFrame, seconds: Column, time: str, *keys: str, pane_s: int = 60, k: int = SKETCH_K
) -> DataFrame:
    """One sketch of a latency per group and pane of `pane_s` seconds.

    A sketch has a few kilobytes whatever it has seen, so panes can be stored and the
    quantiles of any range of them asked for later.
    """
    width = pane_s * NS_PER_SECOND
    pane = (long_div(F.col(time), width) * F.lit(width).cast("long")).alias("pane_start_ns")
    sketch = F.kll_sketch_agg_double(seconds, F.lit(k)).alias("sketch")
    return rows.groupBy(*keys, pane).agg(F.count(seconds).alias("n"), sketch)


def sketch_quantiles(
    sketches: DataFrame, *keys: str, start_ns: int | None = None, end_ns: int | None = None
) -> DataFrame:
    """p50, p95 and p99 per group over the panes that begin in `[start_ns, end_ns)`.

    Each value has a rank within `SKETCH_RANK_ERROR` of the quantile's.
    """
    for bound, within in ((start_ns, F.col("pane_start_ns") >= start_ns), (end_ns, F.col("pane_start_ns") < end_ns)):
        if bound is not None:
            sketches = sketches.where(within)
    merged = sketches.where("n > 0").groupBy(*keys).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    quantiles = {
        name: F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for name, q in QUANTILES.items()
    }
    return merged.withColumns(quantiles).drop("sketch")


def feed_latency(ticks: DataFrame, *, exact: bool = False, accuracy: int = 10_000) -> DataFrame:
    """Receipt minus trade time per feed: extremes, mean, skewed clocks and quantiles.

    Quantiles are of the values themselves, whatever their sign and size. By default they
    come from a sketch of bounded size: a value whose rank is off by at most one part in
    `accuracy`. `exact` interpolates between all values, with state that grows with them.
    """
    lag_ns = F.col("received_ns") - F.col("timestamp_ns")
    rows = ticks.select(*FEED, lag_ns.alias("lag_ns"), (lag_ns / F.lit(1e9)).alias("lag_s"))
    lag_s = F.col("lag_s")
    # Milliseconds and their rest add up as integers: exact in any order, and far from overflow.
    whole = F.sum(long_div(F.col("lag_ns"), 1_000_000)).cast("double")
    rest = F.sum(F.col("lag_ns") % F.lit(1_000_000)).cast("double")
    summary = rows.groupBy(*FEED).agg(
        F.count("*").alias("n_ticks"),
        F.count_if(lag_s < 0).alias("n_negative"),
        F.min(lag_s).alias("min_s"),
        F.max(lag_s).alias("max_s"),
        ((whole * 1e6 + rest) / F.count("*") / 1e9).alias("mean_s"),
        (
            F.percentile(lag_s, list(QUANTILES.values()))
            if exact
            else F.percentile_approx(lag_s, list(QUANTILES.values()), accuracy)
        ).alias("q"),
    )
    quantiles = {name: F.get("q", F.lit(i)) for i, name in enumerate(QUANTILES)}
    return summary.withColumns(quantiles).drop("q")


# -- staleness -----------------------------------------------------------------------------------


def staleness(ticks: DataFrame, as_of_ns: int) -> DataFrame:
    """Seconds since the last message of each feed, seen from `as_of_ns`."""
    age = (F.lit(as_of_ns).cast("long") - F.max("received_ns")) / F.lit(1e9)
    return ticks.groupBy(*FEED).agg(age.alias("age_s"))


def staleness_level(ticks: DataFrame, as_of_ns: int) -> DataFrame:
    level = (
        F.when(F.col("age_s") >= STALE_RED_S, "red")
        .when(F.col("age_s") >= STALE_YELLOW_S, "yellow")
        .otherwise("green")
    )
    return staleness(ticks, as_of_ns).withColumn("level", level)


# -- rates ---------------------------------------------------------------------------------------


def rate(
    rows: DataFrame,
    keys: list[str],
    time: str,
    window_s: int = 60,
    slide_s: int | None = None,
    amount: Column | None = None,
) -> DataFrame:
    """Events per second in windows of `window_s`, sliding by `slide_s` if given.

    Rows are first added up per slide, and only those sums are copied into the windows that
    overlap them, so sliding does not multiply the rows.
    """
    slide_s = slide_s or window_s
    if window_s % slide_s:
        raise ValueError("window_s must be a multiple of slide_s")
    slide = slide_s * NS_PER_SECOND
    value = F.count("*") if amount is None else F.sum(amount)
    start = long_div(F.col(time), slide) * F.lit(slide).cast("long")
    panes = rows.groupBy(*keys, start.alias("window_start_ns")).agg(value.alias("n"))
    if slide_s != window_s:
        earlier = F.array(
            *(
                F.col("window_start_ns") - F.lit(step * slide).cast("long")
                for step in range(window_s // slide_s)
            )
        )
        panes = (
            panes.withColumn("window_start_ns", F.explode(earlier))
            .groupBy(*keys, "window_start_ns")
            .agg(F.sum("n").alias("n"))
        )
    return panes.withColumn("per_second", F.col("n") / F.lit(float(window_s)))


def summary(frames: DataFrame, interval_s: int = 10) -> DataFrame:
    """Frames per second and exchange in each reporting interval, to one decimal."""
    per = rate(
        frames.withColumnRenamed("source", "exchange"), ["exchange"], "received_ns", interval_s
    )
    return per.select(
        "exchange", "window_start_ns", F.round("per_second", 1).alias("msgs_per_sec")
    )
