"""Model evaluation and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftglass.operators.quantiles import FEW, quantiles

THRESHOLDS_M = (50, 100, 200)


def _percent(hit: Column) -> Column:
    return F.round(F.avg(F.when(hit, 1.0).otherwise(0.0)) * 100, 1)


def error_summary(df: DataFrame, by: list[str], err: str = "err", actual: str = "actual", few: int = FEW) -> DataFrame:
    """Mean, median, p90, hit rates (a hit is at most the threshold) and relative accuracy: 1 - median of ratios."""
    ratio = F.col(err) / F.greatest(F.col(actual), F.lit(1e-9))
    tails = quantiles(df, by, {"_err": F.col(err), "_ratio": ratio}, [0.5, 0.9], few)
    sums = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.round(F.avg(err), 1).alias("mean_m"),
        *(_percent(F.col(err) <= t).alias(f"hit_{t}m_pct") for t in THRESHOLDS_M),
    )
    out = sums.join(F.broadcast(tails), by) if by else sums.crossJoin(tails)  # a row per group
    return out.select(
        *by, "n", "mean_m",
        F.round(F.get("_err", F.lit(0)), 1).alias("p50_m"),
        F.round(F.get("_err", F.lit(1)), 1).alias("p90_m"),
        *(f"hit_{t}m_pct" for t in THRESHOLDS_M),
        F.round((1 - F.get("_ratio", F.lit(0))) * 100, 1).alias("relative_accuracy_pct"),
    )


def hit_rate(df: DataFrame, by: list[str], threshold: float, err: str = "err") -> DataFrame:
    return df.groupBy(*by).agg(_percent(F.col(err) <= threshold).alias("hit_pct"))


def decile_edges(df: DataFrame, value: str, few: int = FEW) -> DataFrame:
    """Distinct inner decile edges; the outer bins are open."""
    edges = quantiles(df.where(F.col(value).isNotNull()), [], {"q": F.col(value)}, [k / 10 for k in range(11)], few)
    edges = edges.select(F.array_distinct("q").alias("q"))
    return edges.select(F.slice("q", F.lit(2), F.greatest(F.size("q") - 2, F.lit(0))).alias("edges"))


def bin_of(value: Column, edges: Column) -> Column:
    """Left-closed bins: the number of inner edges at or below the value."""
    return F.size(F.filter(edges, lambda e: e <= value))


def psi(reference: DataFrame, live: DataFrame, value: str, least: int = 20) -> DataFrame:
    """Population stability index of ``live`` against ``reference``'s deciles; null below ``least`` live values.

    The edges are one row of at most eleven numbers, the histograms at most ten rows each.
    """
    edges = decile_edges(reference, value)

    def shares(df: DataFrame, name: str) -> DataFrame:
        rows = df.where(F.col(value).isNotNull()).withColumn("_edges", edges.scalar())
        rows = rows.withColumn("bin", bin_of(F.col(value), F.col("_edges")))
        return rows.groupBy("bin").agg(F.count("*").alias(name))

    bins = edges.select(F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin"))
    joined = bins.join(shares(reference, "r"), "bin", "left").join(shares(live, "l"), "bin", "left").fillna(0, ["r", "l"])
    totals = joined.agg(F.sum("r").alias("nr"), F.sum("l").alias("nl"), F.collect_list(F.struct("r", "l")).alias("b"))
    clip = lambda n, of: F.greatest(F.lit(1e-4), n / F.col(of))
    terms = F.transform("b", lambda x: (clip(x["l"], "nl") - clip(x["r"], "nr")) * F.ln(clip(x["l"], "nl") / clip(x["r"], "nr")))
    score = F.round(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), 4)
    return totals.select(F.when(F.col("nl") >= least, score).alias("psi"), F.col("nl").alias("n_live"))


def per_object_median(df: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*(F.median(v).alias(v) for v in values))


def drift_verdict(reference: DataFrame, live: DataFrame, values: list[str], least_objects: int = 200, shifted: float = 0.25) -> DataFrame:
    """Verdict over per-object medians: insufficient below ``least_objects``, else by the worst feature."""
    out = live.select(F.countDistinct("icao24").alias("aircraft"))
    out = out.withColumns({f"psi_{v}": psi(reference, live, v).select("psi").scalar() for v in values})
    worst = F.greatest(*(F.coalesce(f"psi_{v}", F.lit(-1.0)) for v in values)) if len(values) > 1 else F.coalesce(f"psi_{values[0]}", F.lit(-1.0))
    status = F.when((F.col("aircraft") < least_objects) | (worst < 0), "insufficient").when(worst >= shifted, "shifted").otherwise("stable")
    return out.withColumn("status", status)


def gate(candidate: Column, baseline: Column, champion: Column) -> dict[str, Column]:
    """Promotion: strictly better than the baseline and than the champion, if there is one."""
    base, champ = candidate > baseline, champion.isNull() | (candidate > champion)
    reason = F.when(~base, "not above baseline").when(~champ, "not above champion").when(champion.isNull(), "first champion").otherwise("above both")
    return {"promoted": base & champ, "reason": reason}


def pooled(df: DataFrame, by: list[str], rate: str, n: str) -> DataFrame:
    """Rates weighted by their counts."""
    return df.groupBy(*by).agg((F.sum(F.col(rate) * F.col(n)) / F.sum(n)).alias("pooled"))


def improvement_pct(base: Column, value: Column) -> Column:
    return F.try_divide((base - value) * 100, base)


def best_flags(df: DataFrame, best: dict[str, str]) -> DataFrame:
    """Add best_<metric>: whether a row has the best value of it (``best``: metric to 'max' or 'min').

    The best values are one row, so nothing is gathered.
    """
    top = df.agg(*((F.max if way == "max" else F.min)(m).alias(m) for m, way in best.items()))
    return df.withColumns({f"best_{m}": F.col(m) == top.select(m).scalar() for m in best})


def recent(df: DataFrame, at: str, as_of: Column, span_s: float) -> DataFrame:
    """Rows of the ``span_s`` seconds up to ``as_of``: the rolling input of the drift verdict."""
    return df.where((F.col(at) <= as_of) & (as_of - F.col(at) <= span_s))


def rolling_drift(reference: DataFrame, windows: DataFrame, values: list[str], as_of: Column, span_s: float = 21_600, least_objects: int = 200, shifted: float = 0.25) -> DataFrame:
    """Verdict over each object's median of its window medians of the last ``span_s`` seconds.

    ``windows`` has window_end, icao24 and the values, a row per object and closed window (``window_medians``).
    """
    live = per_object_median(recent(windows, "window_end", as_of, span_s), ["icao24"], values)
    return drift_verdict(reference, live, values, least_objects, shifted)


def window_medians(origins: DataFrame, at: str, width_s: int, values: list[str]) -> DataFrame:
    """(window_end, icao24, values): per-object medians of every tumbling window."""
    end = (F.floor(F.col(at) / width_s) + 1) * width_s
    return per_object_median(origins.withColumn("window_end", end), ["window_end", "icao24"], values)


def close_windows(scored: DataFrame, at: str, width_s: int, few: int = FEW) -> DataFrame:
    """A row per tumbling window with predictions: how many were made, scored and given up, and the error summaries of the
    model and of the baseline. ``scored`` has state (scored, giveup or keep), err_model, err_dr and moved."""
    rows = scored.withColumn("window_start", F.floor(F.col(at) / width_s) * width_s)
    is_state = lambda s: F.count_if(F.col("state") == s)
    out = rows.groupBy("window_start").agg(F.count("*").alias("predictions"), is_state("scored").alias("scored"), is_state("giveup").alias("unscorable"))
    done = rows.where("state = 'scored'")
    for side, err in (("model", "err_model"), ("baseline", "err_dr")):
        s = error_summary(done, ["window_start"], err, "moved", few).drop("n")
        out = out.join(s.select("window_start", *(F.col(c).alias(f"{side}_{c}") for c in s.columns if c != "window_start")), "window_start", "left")
    return out


def metric_rows(df: DataFrame, method: str, metrics: list[str]) -> DataFrame:
    """Wide metrics to (method/metric, value) rows."""
    long = df.unpivot([method], [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    return long.select(F.concat_ws("/", method, "metric").alias("name"), "value")
