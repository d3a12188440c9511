"""Latency summary over a request/score log.

Nearest-rank percentiles, max, throughput and error share. The p-th
percentile of n sorted values is the one whose 0-based place is the share p of
the way from first to last, to the nearest place (a half goes to the even
one). The ranked values come from the exact selection (no single-task sort)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.operators.select import keys_at


def latency_summary(log: DataFrame, latency: str, ok: str, ts: str, tie: str,
                    percentiles=(50, 95, 99)) -> DataFrame:
    spark = log.sparkSession
    last = F.count_if(F.col(ok)) - 1
    places = F.array(*[F.bround(last * F.lit(p) / 100).cast("long") for p in percentiles])
    tot = log.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(ok)).alias("n_ok"), places.alias("places"),
                  F.max(F.when(F.col(ok), F.col(latency))).alias("mx"),
                  ((F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp")))
                   / 1e6).alias("wall")).first()
    n_ok = tot["n_ok"]
    good = log.where(F.col(ok)).select(latency, tie)
    idx = dict(zip(percentiles, tot["places"])) if n_ok else {}
    vals = keys_at(good, [latency, tie], list(idx.values())) if n_ok else {}
    row = {
        "n_requests": tot["n"], "n_ok": n_ok, "n_errors": tot["n"] - n_ok,
        "error_pct": (tot["n"] - n_ok) / tot["n"] * 100 if tot["n"] else 0.0,
        "wall_s": tot["wall"], "rps": n_ok / tot["wall"] if tot["wall"] else None,
        "latency_max": tot["mx"],
    }
    for p in percentiles:
        row[f"p{p}"] = vals[idx[p]][0] if n_ok else None
    cols = list(row)
    schema = ("n_requests long, n_ok long, n_errors long, error_pct double, wall_s double, rps double, "
              "latency_max double, " + ", ".join(f"p{p} double" for p in percentiles))
    return spark.createDataFrame([tuple(row[c] for c in cols)], schema)
