"""Hand-computed and brute-force checks of the subtle semantics."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vigil.operators import drift as dr
from vigil.operators import ranking as rk
from vigil.operators.fingerprint import fingerprint
from vigil.operators.latency import latency_summary
from vigil.operators.order import with_global_index, with_running_sums
from vigil.operators.smote import smote
from vigil.operators.split import split_cuts


def test_python_float_cuts():
    assert split_cuts(90) == (62, 76)
    assert split_cuts(10000) == (7000, 8500)


def test_mostly_zero_binary_collapses_to_one_bin(spark):
    ref = spark.createDataFrame([(0.0,)] * 95 + [(1.0,)] * 5, "x double")
    cur = spark.createDataFrame([(0.0,)] * 50 + [(1.0,)] * 50, "x double")
    rep = dr.feature_drift_report(ref, cur, ["x"]).first()
    assert rep["psi"] == 0.0 and rep["n_effective_bins"] == 2


def _ref_threshold(y, p):
    """The reference's tuning, restated with numpy: one point per distinct
    score (descending cumulative counts), first argmax in ascending order."""
    order = np.argsort(-p, kind="mergesort")
    ps, ys = p[order], y[order]
    distinct = np.r_[np.where(np.diff(ps))[0], len(ps) - 1]
    tps = np.cumsum(ys)[distinct]
    fps = 1 + distinct - tps
    prec = tps / (tps + fps)
    rec = tps / tps[-1]
    thr = ps[distinct]
    prec, rec, thr = prec[::-1], rec[::-1], thr[::-1]
    f1 = 2 * prec * rec / (prec + rec + 1e-12)
    i = int(np.argmax(f1))
    ap = float(np.sum(np.diff(np.r_[0, rec[::-1]]) * prec[::-1]))
    return thr[i], f1[i], ap


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_threshold_and_ap_match_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    y = (rng.uniform(size=3000) < 0.05).astype(np.int32)
    p = np.round(np.clip(y * 0.3 + rng.uniform(0, 0.7, 3000), 0, 1), 2)   # many ties
    df = spark.createDataFrame(pd.DataFrame({"score": p, "label": y}))
    cv = rk.curve(df, "score", "label")
    b = rk.best_threshold(rk.pr_curve(cv)).first()
    t, f1, ap = _ref_threshold(y, p)
    assert b["best_threshold"] == pytest.approx(t) and b["best_f1"] == pytest.approx(f1)
    assert rk.ranking_summary(cv).first()["pr_auc"] == pytest.approx(ap, rel=1e-12)
    pos, neg = p[y == 1], p[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert rk.ranking_summary(cv).first()["roc_auc"] == pytest.approx(auc, rel=1e-12)


def test_grouped_curve_equals_per_group(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 2000), "score": np.round(rng.uniform(size=2000), 2),
                        "label": (rng.uniform(size=2000) < 0.2).astype(np.int32)})
    df = spark.createDataFrame(pdf)
    grouped = {r["g"]: r for r in rk.ranking_summary(rk.curve(df, "score", "label", ["g"]), ["g"]).collect()}
    for g in range(3):
        one = rk.ranking_summary(rk.curve(df.where(F.col("g") == g), "score", "label")).first()
        assert grouped[g]["pr_auc"] == pytest.approx(one["pr_auc"], rel=1e-12)
        assert grouped[g]["roc_auc"] == pytest.approx(one["roc_auc"], rel=1e-12)


def test_global_index_and_running_sums(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "ts", "value")
    idx = with_global_index(ev, ["ts", "event_id"], n_blocks=5).toPandas()
    exp = ev.toPandas().sort_values(["ts", "event_id"]).reset_index(drop=True)
    got = idx.set_index("event_id").loc[exp["event_id"], "_gidx"].to_numpy()
    assert (got == np.arange(len(exp))).all()
    rs = with_running_sums(ev, ["ts", "event_id"], {"cum": F.col("value")}, n_blocks=5).toPandas()
    got = rs.set_index("event_id").loc[exp["event_id"], "cum"].to_numpy()
    assert np.allclose(got, np.cumsum(exp["value"].to_numpy()))


@pytest.mark.parametrize("kind", ["string", "long"])
def test_fingerprint_matches_hashlib_and_is_order_free(spark, kind):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select(
        F.concat(F.lit("TXN_" if kind == "string" else ""), F.col("event_id")).cast(kind).alias("transaction_id"), "ts")
    sha = lambda parts: hashlib.sha256("\n".join(parts).encode()).hexdigest()
    levels = {}
    for (key,) in ev.select(F.col("transaction_id").cast("string")).collect():
        levels.setdefault(hashlib.md5(key.encode()).hexdigest()[:3], []).append(key)
    groups = {}
    for bucket in sorted(levels):
        groups.setdefault(bucket[:2], []).append(sha(sorted(levels[bucket])))
    want = sha([sha(groups[g]) for g in sorted(groups)])
    assert fingerprint(ev).first()["content_sha256"] == want
    assert fingerprint(ev.orderBy(F.rand(3)).repartition(7)).first()["content_sha256"] == want
    none = fingerprint(ev.limit(0)).first()
    assert (none["n_rows"], none["content_sha256"]) == (0, sha([]))


def test_latency_percentiles(spark):
    rng = np.random.default_rng(4)
    lat = np.round(rng.gamma(2, 10, 999), 3)
    pdf = pd.DataFrame({"id": np.arange(999), "ms": lat, "ok": True,
                        "ts": pd.date_range("2024-01-01", periods=999, freq="s")})
    out = latency_summary(spark.createDataFrame(pdf), "ms", "ok", "ts", "id").first()
    s = sorted(lat)
    for p in (50, 95, 99):
        # 998 steps from first to last: places 499, 948.1 and 988.02
        assert out[f"p{p}"] == s[{50: 499, 95: 948, 99: 988}[p]]
    assert out["latency_max"] == s[-1]


def test_smote_invariants(spark):
    rng = np.random.default_rng(0)
    n = 2000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n),
                        "label": (rng.uniform(size=n) < 0.03).astype(np.int32)})
    df = spark.createDataFrame(pdf)
    out, info = smote(df, ["a", "b"], "label", ratio=0.10, k=5, seed=1)
    res = out.toPandas()
    n_pos, n_neg = int(pdf.label.sum()), int((pdf.label == 0).sum())
    assert info["desired_pos"] == int(n_neg * 0.10)
    assert (res.synthetic == 1).sum() == info["desired_pos"] - n_pos
    assert (res.label == 1).sum() == info["desired_pos"]
    mino = pdf[pdf.label == 1][["a", "b"]].to_numpy()
    syn = res[res.synthetic == 1][["a", "b"]].to_numpy()
    # every synthetic point lies on a segment between a minority point and one of its 5 nearest minority points
    d = ((mino[:, None, :] - mino[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    nn = np.argsort(d, axis=1)[:, :5]
    for z in syn[:50]:
        ok = False
        for i in range(len(mino)):
            for j in nn[i]:
                v = mino[j] - mino[i]
                u = np.dot(z - mino[i], v) / np.dot(v, v)
                if -1e-9 <= u <= 1 + 1e-9 and np.allclose(mino[i] + u * v, z, atol=1e-9):
                    ok = True
                    break
            if ok:
                break
        assert ok


@pytest.mark.parametrize("kind,tile,group", [("spread", 40, 3), ("clusters", 40, 1), ("copies", 25, 4), ("one", 5000, None)])
def test_neighbours_by_brute_force(spark, kind, tile, group):
    from vigil.operators import neighbours
    rng = np.random.default_rng(5)
    n, names = 900, ["a", "b", "c"]
    x = rng.normal(size=(n, 3))
    if kind == "clusters":
        x = x * 0.01 + rng.integers(0, 30, (n, 1)) * [5.0, 1.0, 0.0]
    if kind == "copies":
        x[:300] = x[0]  # a third of the rows are one
    df = spark.createDataFrame(pd.DataFrame(x, columns=names)).repartition(5)
    placed = neighbours.indexed(df, names, n).cache()
    got = neighbours.nearest(placed, names, 5, n, tile, group).toPandas().sort_values(["_mi", "_rank"])
    x = placed.toPandas().sort_values("_mi")[names].to_numpy()
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=-1)
    np.fill_diagonal(d, np.inf)
    assert (got["_mi"].to_numpy() == np.repeat(np.arange(n), 5)).all() and (got["_rank"].to_numpy() == np.tile(np.arange(5), n)).all()
    assert np.allclose(got["_d"].to_numpy().reshape(n, 5), np.sort(d, axis=1)[:, :5], rtol=1e-12, atol=1e-15)
    assert np.allclose(d[got["_mi"], got["_nn"]], got["_d"], rtol=1e-12, atol=1e-15)
    assert got.groupby("_mi")["_nn"].nunique().eq(5).all()
    tiles = neighbours._tiles(placed, names, 5, tile)
    pairs = [(e["q"], r.r) for r in neighbours._pairs(tiles, -(-n // tile), 3, 3, tile).collect() for e in r.need]
    if kind == "clusters":
        assert len(pairs) < 0.6 * (-(-n // tile)) ** 2
    if kind == "copies":  # copies find each other in their own tile
        same = {r.tile for r in tiles.collect() if np.frombuffer(r.balls)[3] == 0}
        assert len(same) > 9 and all(q == r for q, r in pairs if q in same)


@pytest.mark.parametrize("table", ["events", "orders"])
def test_exact_selection_by_narrowing(spark, table):
    """keys_at narrows with approximate quantiles and still returns the exact
    row at each position, also inside runs of equal timestamps."""
    from vigil.operators.select import keys_at
    from vigil.plans.q_features import events_tx, orders_tx
    tx = (events_tx if table == "events" else orders_tx)(spark, SF_SMALL)
    pdf = tx.select("ts", "transaction_id").toPandas().sort_values(["ts", "transaction_id"]).reset_index(drop=True)
    n = len(pdf)
    idx = [0, 1, n // 3, int(n * 0.7), int(n * 0.85), n - 1]
    got = keys_at(tx, ["ts", "transaction_id"], idx, max_candidates=20, margin=0.04)
    for i in idx:
        assert got[i] == (pdf.ts[i].to_pydatetime(), int(pdf.transaction_id[i]))


def test_selection_over_ties_moves_values_only(spark):
    """One shared key, and cuts on the border of two runs, are settled by
    counting; ranks inside a run are found by the second column."""
    from vigil.operators.select import keys_at, values_at
    rows = spark.range(60_000).select(F.lit(7.0).alias("same"), F.floor(F.col("id") / 30_000).alias("two"),
                                      ((F.col("id") * 7919) % 60_000).alias("id"))
    assert keys_at(rows, ["same"], [0, 30_000, 59_999], max_candidates=100) == {i: (7.0,) for i in (0, 30_000, 59_999)}
    got = keys_at(rows.select("same", "id"), ["same", "id"], [0, 41_234, 59_999], max_candidates=100, margin=0.02)
    assert got == {i: (7.0, i) for i in (0, 41_234, 59_999)}
    assert keys_at(rows, ["two"], [29_999, 30_000], max_candidates=100) == {29_999: (0,), 30_000: (1,)}
    x = F.col("id").cast("double")
    assert values_at(rows, {"x": (x, 60_000, [5, 59_998])}, 50, 0.02) == {"x": {5: 5.0, 59_998: 59_998.0}}


def test_selection_with_null_keys(spark):
    from vigil.operators.select import keys_at
    rows = spark.createDataFrame([(None, 5), (2, 1), (None, 3), (1, 9)], "p long, s long")
    assert keys_at(rows, ["p", "s"], range(5)) == {0: (1, 9), 1: (2, 1), 2: (None, 3), 3: (None, 5)}


@pytest.mark.parametrize("limit", [5, 20_000])
def test_string_positions_inside_a_run_of_ties(spark, limit):
    """Ids of several lengths and alphabets, one a beginning of others, null
    ids last; most rows share a timestamp."""
    from vigil.operators.select import keys_at
    ids = [f"TXN_{i:05d}" for i in range(3000)] + ["", "T", "TXN", "TXN_0", "TXN_00001\x00", "é", "日本", "zz" * 40, "zz" * 40 + "a"] + [None]
    rows = spark.createDataFrame([(7 if k % 10 else k, i) for k, i in enumerate(ids)], "ts long, id string")
    want = sorted(((t, i) for t, i in ((7 if k % 10 else k, i) for k, i in enumerate(ids))),
                  key=lambda r: (r[0], r[1] is None, (r[1] or "").encode()))
    at = [0, 1, 2, 3, 4, 700, 1500, 2700, 2701, 2702, 2703, 2704, 2705, len(ids) - 1]
    assert keys_at(rows, ["ts", "id"], at, max_candidates=limit) == {i: want[i] for i in at}


def test_ranking_metrics_beyond_the_range_of_an_int(spark):
    """60,000 positives times 60,000 negatives is more than an int holds."""
    df = spark.range(120_000).select((F.col("id") % 4 / 4.0).alias("score"), F.when(F.col("id") % 8 < 4, 1).otherwise(0).alias("label"))
    cv = rk.curve(df, "score", "label")
    assert {f.name: f.dataType.simpleString() for f in cv.schema if f.name in ("p_total", "n_total", "tp", "fp")} == dict.fromkeys(
        ("p_total", "n_total", "tp", "fp"), "bigint")
    got = rk.ranking_summary(cv).first()
    assert got["roc_auc"] == pytest.approx(0.5) and got["pr_auc"] == pytest.approx(0.5)
