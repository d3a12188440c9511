"""DuckDB SQL fragments shared by the oracles. They restate each adapter and
operator independently (regex instead of JSON for the merchant key,
ROW_NUMBER over the whole table for splits, correlated self-joins for
windows), so an oracle match is evidence, not a tautology."""

# Canonical transactions from events.
TX_EVENTS = r"""
tx AS (
  SELECT event_id AS transaction_id,
         user_id AS customer_id,
         CAST(regexp_extract(props, '"k":\s*([0-9]+)', 1) AS BIGINT) AS merchant_id,
         CAST(CAST(regexp_extract(props, '"k":\s*([0-9]+)', 1) AS BIGINT) % 10 AS VARCHAR) AS merchant_category,
         'DEV_' || CAST(CAST(regexp_extract(props, '"k":\s*([0-9]+)', 1) AS BIGINT) // 5 AS VARCHAR) AS device_id,
         ts,
         value AS amount,
         CAST(event_type = 'error' AND value > 60 AS INTEGER) AS label,
         epoch_us(ts) AS us
  FROM events
  WHERE value IS NOT NULL AND NOT isnan(value)
)"""

TX_ORDERS = r"""
tx AS (
  SELECT o_orderkey AS transaction_id,
         o_custkey AS customer_id,
         CAST(NULL AS BIGINT) AS merchant_id,
         o_orderpriority AS merchant_category,
         o_orderstatus AS device_id,
         o_orderdate AS ts,
         o_totalprice AS amount,
         CAST(NULL AS INTEGER) AS label,
         epoch_us(o_orderdate) AS us
  FROM orders
  WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
)"""

# Chronological split with Python-float cut points.
SPLIT = r"""
ranked AS (
  SELECT *, row_number() OVER (ORDER BY us, transaction_id) - 1 AS idx, count(*) OVER () AS n_all
  FROM tx
),
stx AS (
  SELECT * EXCLUDE (idx, n_all),
         CASE WHEN idx < CAST(floor(n_all * CAST(0.7 AS DOUBLE)) AS BIGINT) THEN 'train'
              WHEN idx < CAST(floor(n_all * (CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE))) AS BIGINT) THEN 'val'
              ELSE 'test' END AS split
  FROM ranked
)"""

# Risk maps fit on the train split (requires stx).
RISK = r"""
g AS (SELECT avg(label) AS gm FROM stx WHERE split = 'train'),
mrisk AS (
  SELECT merchant_id,
         (avg(label) * count(label) + (SELECT gm FROM g) * 20.0) / (count(label) + 20.0) AS merchant_risk_score
  FROM stx WHERE split = 'train' GROUP BY merchant_id
),
crisk AS (
  SELECT merchant_category, avg(label) AS merchant_category_risk_score
  FROM stx WHERE split = 'train' GROUP BY merchant_category
)"""


def velocity_sql(windows_minutes, key="customer_id", partition_extra=""):
    """Correlated self-join: for each row, earlier rows of the same key in
    (t - w, t] where 'earlier' breaks timestamp ties on transaction_id."""
    w_max = max(windows_minutes) * 60_000_000
    cols = []
    for w in windows_minutes:
        wus = w * 60_000_000
        cols.append(f"count(b.transaction_id) FILTER (WHERE b.us > a.us - {wus}) AS velocity_count_{w}m")
        cols.append(f"round(coalesce(sum(b.amount) FILTER (WHERE b.us > a.us - {wus}), 0), 2) AS velocity_amount_{w}m")
    extra = "".join(f" AND a.{p} = b.{p}" for p in partition_extra.split(",") if p)
    return f"""
vel AS (
  SELECT a.transaction_id, {', '.join(cols)}
  FROM stx a LEFT JOIN stx b
    ON a.{key} = b.{key}{extra}
   AND b.us > a.us - {w_max}
   AND (b.us < a.us OR (b.us = a.us AND b.transaction_id < a.transaction_id))
  GROUP BY a.transaction_id
)"""


def psi_sql(ref: str, cur: str, features, group_col: str | None = None, prefix: str = "") -> str:
    """CTEs {prefix}rl, cl, edges, rb, cb, rn, cn, rc, cc, grid, shares, psi
    for the PSI of ``features`` between relations ``ref`` and ``cur``
    (optionally per ``group_col`` of cur). Each value's bin is found by
    counting the inner edges <= x."""
    p = prefix
    cols = ", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in features)
    on = ", ".join(features)
    g_sel = f"{group_col}, " if group_col else ""
    probs = ", ".join(str(i / 10) for i in range(1, 10))
    g_shares = f"g.{group_col}, " if group_col else ""
    g_join = f"AND c.{group_col} = g.{group_col}" if group_col else ""
    return f"""
{p}rl AS (UNPIVOT (SELECT {cols} FROM {ref}) ON {on} INTO NAME feature VALUE x),
{p}cl AS (UNPIVOT (SELECT {g_sel}{cols} FROM {cur}) ON {on} INTO NAME feature VALUE x),
{p}edges AS (SELECT feature, list_transform(quantile_cont(x, [{probs}]), lambda e: round(e, 9)) AS q
          FROM {p}rl WHERE NOT isnan(x) GROUP BY feature),
{p}rb AS (SELECT r.feature, len(list_filter(e.q, lambda v: v <= r.x)) AS bin
          FROM {p}rl r JOIN {p}edges e USING (feature) WHERE NOT isnan(r.x)),
{p}cb AS (SELECT {g_sel}c.feature, len(list_filter(e.q, lambda v: v <= c.x)) AS bin
          FROM {p}cl c JOIN {p}edges e USING (feature) WHERE NOT isnan(c.x)),
{p}rn AS (SELECT feature, count(*) AS n FROM {p}rb GROUP BY feature),
{p}cn AS (SELECT {g_sel}feature, count(*) AS n FROM {p}cb GROUP BY {g_sel}feature),
{p}rc AS (SELECT feature, bin, count(*) AS c FROM {p}rb GROUP BY feature, bin),
{p}cc AS (SELECT {g_sel}feature, bin, count(*) AS c FROM {p}cb GROUP BY {g_sel}feature, bin),
{p}grid AS (SELECT {g_sel}cn.feature, b.bin, cn.n AS n_cur, rn.n AS n_ref
         FROM {p}cn cn JOIN {p}rn rn USING (feature) CROSS JOIN (SELECT range AS bin FROM range(10)) b),
{p}shares AS (SELECT {g_shares}g.feature, g.bin,
                  greatest(coalesce(r.c, 0) / g.n_ref, 1e-6) AS e,
                  greatest(coalesce(c.c, 0) / g.n_cur, 1e-6) AS a
           FROM {p}grid g LEFT JOIN {p}rc r ON r.feature = g.feature AND r.bin = g.bin
           LEFT JOIN {p}cc c ON c.feature = g.feature AND c.bin = g.bin {g_join}),
{p}psi AS (SELECT {g_sel}feature, sum((a - e) * ln(a / e)) AS psi FROM {p}shares GROUP BY {g_sel}feature)"""
