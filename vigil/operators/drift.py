"""Population stability index and drift reports.

Plan: the two values beside each quantile of every feature are found together
by exact selection (``select.values_at``, the same method at every size); the
edges (features x 11 numbers, a proven small size) become literals. A second single pass finds each value's bin by
halving them and counts per feature, bin and optional groups (e.g. an
hourly window) - no row is shuffled, only partial counts. A value's bin is the number of edges at or below it, so
repeated edges yield empty bins exactly like a histogram over non-decreasing edges. PSI per
feature is an aggregate over the unpivoted (feature, bin) rows.

Semantics: edges are the linear-interpolated percentiles 0,10,...,100 of the
reference with both ends replaced by -inf/+inf; shares are clipped at 1e-6
without renormalising; PSI = sum (a - e) * ln(a / e). Nulls and NaN are
dropped per column. ``edge_decimals`` rounds edges where two engines' results
are compared; by default they are not rounded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.config import (
    DRIFT_TOP_K, FLAG_THRESHOLD, MIN_SIGNIFICANT_FEATURES, PSI_BINS, PSI_FLOOR,
    PSI_MODERATE, PSI_SIGNIFICANT,
)
from vigil.functions.columns import psi_band
from vigil.operators.joins import kept
from vigil.operators.select import values_at


def _clean(col: str):
    c = F.col(col).cast("double")
    return F.when(~F.isnan(c), c)


def usable_features(reference: DataFrame, current: DataFrame, features) -> list[str]:
    """Features present on both sides, in the given order."""
    return [f for f in features if f in reference.columns and f in current.columns]


def quantile_edges(reference: DataFrame, features, bins: int = PSI_BINS,
                   edge_decimals: int | None = None) -> dict[str, list[float]]:
    """Inner edges (bins - 1 per feature), linear between the two values
    beside each quantile. The values are found by exact selection, the same at
    every size: no table is sorted and nothing but edges reaches the driver.
    Features with no values on the reference side are left out."""
    features = list(features)
    if not features:
        return {}
    clean = reference.select(*[_clean(f).alias(f"x{i}") for i, f in enumerate(features)])
    counts = clean.agg(*[F.count(c).alias(c) for c in clean.columns]).first()
    places = {}
    for i, f in enumerate(features):
        n = counts[f"x{i}"]
        if n:
            places[f] = (F.col(f"x{i}"), n, [(n - 1) * (k / bins) for k in range(1, bins)])
    found = values_at(clean, {f: (x, n, [r for at in own for r in (int(at), min(int(at) + 1, n - 1))])
                              for f, (x, n, own) in places.items()})
    out = {}
    for f, (_, n, own) in places.items():
        v = found[f]
        edges = [v[int(at)] + (v[min(int(at) + 1, n - 1)] - v[int(at)]) * (at - int(at)) for at in own]
        out[f] = [round(e, edge_decimals) for e in edges] if edge_decimals is not None else edges
    return out


def _binned(df: DataFrame, edges: dict[str, list[float]], keep) -> DataFrame:
    """One narrow row per feature value: the kept columns, feature, bin. A
    value's bin is the number of inner edges at or below it, found by halving
    the edges in a literal array. (A tree of comparisons per feature is too large
    a method for the JVM to compile.)"""
    sizes = [len(es) for es in edges.values()]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    cuts = F.array(*[F.lit(float(e)) for es in edges.values() for e in es]).cast("array<double>")
    of = F.col("_feature")
    rows = (df.select(*keep, F.posexplode(F.array(*[_clean(f) for f in edges])).alias("_feature", "_value")).where("_value is not null")
            .withColumns({"_lo": F.lit(0), "_hi": F.get(F.array(*map(F.lit, sizes)), of), "_start": F.get(F.array(*map(F.lit, starts)), of)}))
    for _ in range(max(sizes).bit_length()):
        mid = F.shiftright(F.col("_lo") + F.col("_hi"), 1)
        rows = rows.withColumn("_mid", mid).withColumn("_less", F.col("_value") < F.get(cuts, F.col("_start") + F.col("_mid")))
        left = F.col("_lo") < F.col("_hi")
        rows = rows.withColumns({"_lo": F.when(left & ~F.col("_less"), F.col("_mid") + 1).otherwise(F.col("_lo")),
                                 "_hi": F.when(left & F.col("_less"), F.col("_mid")).otherwise(F.col("_hi"))})
    return rows.select(*keep, F.get(F.array(*map(F.lit, edges)), of).alias("feature"), F.col("_lo").alias("bin"))


def bin_counts(df: DataFrame, edges: dict[str, list[float]], groups=()) -> DataFrame:
    """Rows (groups..., feature, bin, cnt, n), empty bins included. Only
    partial counts of (groups, feature, bin) are shuffled."""
    groups = list(groups)
    counted = _binned(df, edges, groups).groupBy(*groups, "feature", "bin").agg(F.count(F.lit(1)).alias("cnt"))
    sizes = F.create_map(*[x for f, es in edges.items() for x in (F.lit(f), F.lit(len(es)))])
    # bins of one group and feature: at most the number of edges + 1
    by_bin = counted.groupBy(*groups, "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "cnt"))).alias("_m"), F.sum("cnt").alias("n"))
    return by_bin.select(*groups, "feature", "n", "_m", F.explode(F.sequence(F.lit(0), sizes[F.col("feature")])).alias("bin")).select(
        *groups, "feature", "bin", F.coalesce(F.col("_m")[F.col("bin")], F.lit(0)).alias("cnt"), "n")


def psi_from_counts(ref_bins: DataFrame, cur_bins: DataFrame, groups=(), floor: float = PSI_FLOOR) -> DataFrame:
    """PSI per (groups..., feature). The reference bins are one row per
    (feature, bin) - bounded by features x bins - so they are broadcast."""
    groups = list(groups)
    r = ref_bins.select("feature", "bin", F.col("cnt").alias("rc"), F.col("n").alias("rn"))
    j = cur_bins.join(F.broadcast(r), ["feature", "bin"], "inner").where((F.col("n") > 0) & (F.col("rn") > 0))
    e = F.greatest(F.col("rc") / F.col("rn"), F.lit(floor))
    a = F.greatest(F.col("cnt") / F.col("n"), F.lit(floor))
    return j.groupBy(*groups, "feature").agg(F.sum((a - e) * F.log(a / e)).alias("psi"))


def effective_bins(edges: dict[str, list[float]]) -> dict[str, int]:
    """Bins that can hold values: intervals with a strictly larger upper edge
    (the blind spot of a mostly-constant feature shows up as 1)."""
    out = {}
    for f, es in edges.items():
        full = [float("-inf")] + list(es) + [float("inf")]
        out[f] = sum(1 for lo, hi in zip(full, full[1:]) if hi > lo)
    return out


def drift_psi(reference: DataFrame, current: DataFrame, features, groups=(), bins: int = PSI_BINS,
              edge_decimals: int | None = None) -> tuple[DataFrame, dict]:
    feats = usable_features(reference, current, features)
    edges = quantile_edges(reference, feats, bins, edge_decimals)
    if not edges:
        schema = ", ".join([f"`{g}` string" for g in groups] + ["feature string", "psi double"])
        return reference.sparkSession.createDataFrame([], schema), edges
    ref_bins = bin_counts(reference, edges)
    cur_bins = bin_counts(current, edges, groups)
    return psi_from_counts(ref_bins, cur_bins, groups), edges


def feature_drift_report(reference: DataFrame, current: DataFrame, features, groups=(),
                         moderate: float = PSI_MODERATE, significant: float = PSI_SIGNIFICANT,
                         edge_decimals: int | None = None) -> DataFrame:
    """(groups..., feature, psi rounded to 4, status from the unrounded
    psi, n_effective_bins)."""
    profile = fit_profile(reference, usable_features(reference, current, features), edge_decimals=edge_decimals)
    return profile_drift(profile, current, groups, moderate, significant)[0]


def prediction_drift(reference: DataFrame, current: DataFrame, score: str = "score", groups=(),
                     flag_threshold: float = FLAG_THRESHOLD, edge_decimals: int | None = None) -> DataFrame:
    """Score PSI, mean scores and flagged rates (at 0.5 by default)."""
    profile = fit_profile(reference, [], score, flag_threshold, edge_decimals)
    return profile_drift(profile, current, groups)[1]


# --------------------------------------------------------------------------
# stored reference profile
# --------------------------------------------------------------------------
@dataclass
class DriftProfile:
    """What drift cycles need of the reference: inner edges and bin counts of
    every feature and of the score (features x bins numbers), the score's mean
    and flagged rate. Fitted once, saved under a version, and read back without
    the reference."""
    edges: dict[str, list[float]]
    counts: dict[str, list[int]]
    score: str | None
    flag_threshold: float
    mean_score: float | None = None
    flagged_rate: float | None = None
    version: str = "1"

    FIELDS = ("version string, feature string, is_score boolean, edges array<double>, counts array<long>, "
              "flag_threshold double, mean_score double, flagged_rate double")

    def bins(self, spark: SparkSession) -> DataFrame:
        rows = [(f, b, c, sum(own)) for f, own in self.counts.items() for b, c in enumerate(own)]
        return spark.createDataFrame(rows, "feature string, bin int, cnt long, n long")

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per feature under ``version=``; a version is overwritten as a whole."""
        rows = [(self.version, f, f == self.score, e, self.counts[f], self.flag_threshold, self.mean_score, self.flagged_rate)
                for f, e in self.edges.items()]
        (spark.createDataFrame(rows, self.FIELDS).drop("version").coalesce(1)  # features x bins numbers
         .write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={self.version}"))

    @staticmethod
    def load(spark: SparkSession, path: str, version: str = "1") -> "DriftProfile":
        rows = spark.read.parquet(f"{path.rstrip('/')}/version={version}").collect()
        score = next((r.feature for r in rows if r.is_score), None)
        one = rows[0]
        return DriftProfile({r.feature: list(r.edges) for r in rows}, {r.feature: list(r.counts) for r in rows}, score,
                            one.flag_threshold, one.mean_score, one.flagged_rate, version)


def _score_means(score: str | None, flag_threshold: float) -> list:
    if score is None:
        return []
    return [F.avg(score).alias("_mean"), F.avg((F.col(score) >= flag_threshold).cast("double")).alias("_flagged")]


def fit_profile(reference: DataFrame, features, score: str | None = None, flag_threshold: float = FLAG_THRESHOLD,
                edge_decimals: int | None = None, bins: int = PSI_BINS, version: str = "1") -> DriftProfile:
    """The reference's profile: edges of all features and the score from one
    exact selection, counts and means from one more pass. Features absent from
    the reference, or without a value there, are left out."""
    names = [*dict.fromkeys([*[f for f in features if f in reference.columns], *([score] if score else [])])]
    edges = quantile_edges(reference, names, bins, edge_decimals)
    counts = {f: [0] * (len(es) + 1) for f, es in edges.items()}
    means = reference.agg(*_score_means(score, flag_threshold)).first() if score else (None, None)
    if edges:
        for r in _binned(reference, edges, []).groupBy("feature", "bin").count().collect():  # features x bins rows
            counts[r["feature"]][r["bin"]] = r["count"]
    return DriftProfile(edges, counts, score, flag_threshold, means[0], means[1], version)


def profile_drift(profile: DriftProfile, current: DataFrame, groups=(), moderate: float = PSI_MODERATE,
                  significant: float = PSI_SIGNIFICANT) -> tuple[DataFrame, DataFrame | None]:
    """(feature report, score drift or None) of ``current`` against a profile,
    per group, from one count over (group, feature, bin). Features that ``current``
    lacks are skipped."""
    spark, groups, score = current.sparkSession, list(groups), profile.score
    edges = {f: e for f, e in profile.edges.items() if f in current.columns}
    score = score if score in current.columns else None
    if edges:
        psi = psi_from_counts(profile.bins(spark), bin_counts(current, edges, groups), groups)
        if score and len(edges) > 1:  # the report and the score's drift read it: all values are counted once
            psi = kept(psi)
    else:
        kinds = [f"`{g}` {current.schema[g].dataType.simpleString()}" for g in groups]
        psi = spark.createDataFrame([], ", ".join([*kinds, "feature string, psi double"]))
    eff = effective_bins(edges)
    eff_col = F.element_at(F.create_map(*[x for f, n in eff.items() for x in (F.lit(f), F.lit(n))]), F.col("feature")) if eff else F.lit(None)
    band = psi_band("psi", moderate, significant)
    report = psi.where(F.col("feature") != F.lit(score or "")) if score else psi
    report = report.select(*groups, "feature", F.round("psi", 4).alias("psi"), band.alias("status"),
                           eff_col.cast("int").alias("n_effective_bins"))
    if not score:
        return report, None
    means = current.groupBy(*groups).agg(*_score_means(score, profile.flag_threshold))
    scored = psi.where(F.col("feature") == score)
    if groups:
        means = means.withColumnsRenamed({g: f"_g{i}" for i, g in enumerate(groups)})
        on = F.lit(True)
        for i, g in enumerate(groups):
            on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
        joined = scored.join(means, on)
    else:
        joined = scored.crossJoin(means)  # one row each
    drift = joined.select(
        *groups, F.round("psi", 4).alias("score_psi"),
        F.lit(profile.mean_score).alias("reference_mean_score"), F.col("_mean").alias("current_mean_score"),
        F.lit(profile.flagged_rate).alias("reference_flagged_rate"), F.col("_flagged").alias("current_flagged_rate"),
        psi_band("psi").alias("status"))
    return report, drift


def profile_cycle(profile: DriftProfile, current: DataFrame, groups=(), min_significant: int = MIN_SIGNIFICANT_FEATURES,
                  top_k: int = DRIFT_TOP_K) -> DataFrame:
    """X9 against a profile: one record per group."""
    report, drift = profile_drift(profile, current, groups)
    return drift_cycle(report, drift, groups, min_significant, top_k)


def drift_cycle(report: DataFrame, score_drift: DataFrame | None, groups=(),
                min_significant: int = MIN_SIGNIFICANT_FEATURES, top_k: int = DRIFT_TOP_K) -> DataFrame:
    """One record per group: features checked, significant features
    (sorted names), the top-k features by psi, score status, and
    drift_alert = (#significant >= 3) or score significant. The lists are
    bounded by the number of features."""
    groups = list(groups)
    if not groups:
        sd = score_drift.withColumn("_all", F.lit(0)) if score_drift is not None else None
        return drift_cycle(report.withColumn("_all", F.lit(0)), sd, ["_all"],
                           min_significant, top_k).drop("_all")
    sig = F.col("status") == "significant_shift"
    top = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("psi")).alias("k"), F.col("feature"),
                                                       F.col("psi")))), 1, top_k)
    rec = report.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_features_checked"),
        F.count_if(sig).alias("n_significant_features"),
        F.array_sort(F.collect_list(F.when(sig, F.col("feature")))).alias("significant_features"),
        top.alias("_top"))
    rec = rec.withColumn("top_feature_psi", F.transform("_top", lambda s: F.struct(
        s["feature"].alias("feature"), s["psi"].alias("psi")))).drop("_top")
    if score_drift is not None:
        sd = score_drift.select(*groups, F.col("score_psi"), F.col("status").alias("score_status"))
        rec = rec.join(sd, groups, "left")
        score_sig = F.coalesce(F.col("score_status") == "significant_shift", F.lit(False))
    else:
        rec = rec.withColumn("score_psi", F.lit(None).cast("double")).withColumn(
            "score_status", F.lit(None).cast("string"))
        score_sig = F.lit(False)
    return rec.withColumn("drift_alert", (F.col("n_significant_features") >= min_significant) | score_sig)
