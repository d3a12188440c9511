"""Exact order statistics without sorting the table.

``keys_at(df, [primary, secondary], indices)`` returns the (primary,
secondary) key of the rows at given 0-based positions of the
(primary, secondary) order, ``values_at`` the values at positions of several
columns' own orders. Rows are not range-partitioned or sorted; each position
is found by narrowing an open interval of values:

1. one mergeable quantile sketch per column and interval (KLL, partially
   aggregated; no row is shuffled) brackets all positions that lie in it:
   neighbouring positions share a pair of values,
2. one counting pass tells whether a position falls on one of the two values
   (a run of ties, however long, is settled here), between them, below or
   above. Both values leave the interval in every case, so each round makes
   progress whatever the sketch returned,
3. when at most ``max_candidates`` rows remain, one aggregate sorts them and
   returns only the wanted values.

Strings have no quantile sketch: among the rows of a run, ``_solve_strings``
narrows the byte prefix that holds the position, two bytes at a time from where
the run's least and greatest string part.

Nothing but values at wanted positions (and per round at most 65,537 counts for
a string) reaches the driver. All positions are narrowed together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_CANDIDATES = 20_000
#: size of a KLL sketch; its rank error is about 2.3 / size**0.9
SKETCH_SIZE = 8192
#: ranks on both sides of a position, as a share, that the pair of values spans
MARGIN = 0.001


def _numeric(df: DataFrame, col: str) -> tuple[Column, bool]:
    t = df.schema[col].dataType
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp")), True
    return F.col(col), False


def _quantiles(x: Column, kind: T.DataType, at: list[float]) -> Column:
    """Values near the given shares of ``x`` from one sketch."""
    shares = F.array(*[F.lit(a) for a in at])
    name = "bigint" if isinstance(kind, T.IntegralType) else "double" if isinstance(kind, T.FractionalType) and not isinstance(
        kind, T.DecimalType) else None
    if name is None:  # decimals and dates
        return F.percentile_approx(x, shares, SKETCH_SIZE)
    sketch = F.call_function(f"kll_sketch_agg_{name}", x.cast(name), F.lit(SKETCH_SIZE))
    return F.call_function(f"kll_sketch_get_quantile_{name}", sketch, shares)


class _Search:
    """One wanted rank ``t`` among the ``m`` rows with ``rows`` true and lo < x < hi."""

    def __init__(self, x: Column, rows: Column, t: int, m: int):
        self.x, self.rows, self.t, self.m = x, rows, t, m
        self.lo = self.hi = self.value = None
        self.done = False

    def inside(self) -> Column:
        c = self.rows
        if self.lo is not None:
            c = c & (self.x > F.lit(self.lo))
        if self.hi is not None:
            c = c & (self.x < F.lit(self.hi))
        return c

    def interval(self) -> tuple:
        return id(self.x), id(self.rows), self.lo, self.hi

    def narrow(self, a, b, counts) -> None:
        below_a, to_a, below_b, to_b = counts
        if below_a <= self.t < to_a or below_b <= self.t < to_b:
            self.value, self.done = (a if self.t < to_a else b), True
        elif self.t < below_a:
            self.hi, self.m = a, below_a
        elif self.t >= to_b:
            self.lo, self.t, self.m = b, self.t - to_b, self.m - to_b
        else:
            self.lo, self.hi, self.t, self.m = a, b, self.t - to_a, below_b - to_a


def _aggregate(df: DataFrame, columns: list[Column]) -> list:
    return list(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def cuts_below(x: Column, cuts: list) -> Column:
    """Number of ascending ``cuts`` at or below ``x`` (they may repeat), by a
    tree of comparisons."""
    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x < F.lit(cuts[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))
    return tree(0, len(cuts))


def _counts(df: DataFrame, pairs: list[tuple[list[_Search], object, object]]) -> list[tuple[int, int, int, int]]:
    """For each pair (a, b) the rows of its interval below a, up to a, below b
    and up to b: one grouped count over the codes of all intervals' cuts."""
    cuts: dict[tuple, set] = {}
    of: dict[tuple, _Search] = {}
    for run, a, b in pairs:
        key = run[0].interval()
        of.setdefault(key, run[0])
        cuts.setdefault(key, set()).update((a, b))
    order = {key: sorted(v) for key, v in cuts.items()}
    own = list(order.items())
    coded = df.select(*[F.when(of[key].inside(), of[key].x).alias(f"x{g}") for g, (key, _) in enumerate(own)])
    coded = coded.select(*[F.col(f"x{g}") for g in range(len(own))],
                         *[F.when(F.col(f"x{g}").isNotNull(), cuts_below(F.col(f"x{g}"), v)).alias(f"n{g}") for g, (_, v) in enumerate(own)])
    # 2i between the cuts i - 1 and i, 2i + 1 on cut i
    codes = [F.struct(F.lit(g).alias("g"), (2 * F.col(f"n{g}") - F.coalesce(
        F.get(F.array(*map(F.lit, v)), F.col(f"n{g}") - 1) == F.col(f"x{g}"), F.lit(False)).cast("int")).alias("code"))
        for g, (_, v) in enumerate(own)]
    found = coded.select(F.inline(F.array(*codes))).where("code is not null").groupBy("g", "code").count().collect()  # 2 per cut
    at = {key: g for g, key in enumerate(order)}
    rows: dict[int, dict[int, int]] = {}
    for r in found:
        rows.setdefault(r["g"], {})[r["code"]] = r["count"]

    def upto(key, code):
        return sum(n for c, n in rows.get(at[key], {}).items() if c <= code)

    out = []
    for run, a, b in pairs:
        key = run[0].interval()
        i, j = order[key].index(a), order[key].index(b)
        out.append((upto(key, 2 * i), upto(key, 2 * i + 1), upto(key, 2 * j), upto(key, 2 * j + 1)))
    return out


def _by(searches: list[_Search], key) -> dict:
    out: dict = {}
    for s in sorted(searches, key=lambda s: s.t):
        out.setdefault(key(s), []).append(s)
    return out


def _brackets(df: DataFrame, wide: list[_Search], margin: float) -> list[tuple[list[_Search], object, object]]:
    """(searches that share them, lower value, upper value)."""
    groups = list(_by(wide, _Search.interval).values())
    clusters = []
    for own in groups:
        runs = [[own[0]]]
        for s in own[1:]:
            if s.t - runs[-1][-1].t <= margin * s.m:
                runs[-1].append(s)
            else:
                runs.append([s])
        clusters.append(runs)
    kinds = [df.select(own[0].x).schema[0].dataType for own in groups]
    at = [[min(1.0, max(0.0, (s.t + 0.5) / s.m + d)) for run in runs for s, d in ((run[0], -margin), (run[-1], margin))]
          for runs in clusters]
    near = _aggregate(df, [_quantiles(F.when(own[0].inside(), own[0].x), kind, a) for own, kind, a in zip(groups, kinds, at)])
    return [(run, values[2 * k], values[2 * k + 1]) for runs, values in zip(clusters, near) for k, run in enumerate(runs)]


def _solve(df: DataFrame, searches: list[_Search], max_candidates: int, margin: float) -> None:
    while True:
        wide = [s for s in searches if not s.done and s.m > max_candidates]
        if not wide:
            break
        pairs = _brackets(df, wide, margin)
        for (run, a, b), counts in zip(pairs, _counts(df, pairs)):
            for s in run:
                s.narrow(a, b, counts)
    left = list(_by([s for s in searches if not s.done], _Search.interval).values())
    if left:
        lists = [F.sort_array(F.collect_list(F.when(own[0].inside(), own[0].x))) for own in left]
        found = _aggregate(df, [F.array(*[F.get(v, F.lit(s.t)) for s in own]) for own, v in zip(left, lists)])
        for own, values in zip(left, found):
            for s, value in zip(own, values):
                s.value, s.done = value, True


def _solve_strings(df: DataFrame, searches: list[_Search], max_candidates: int) -> None:
    """Each search by radix: rows that begin with ``prefix`` (hex digits of the
    bytes, whose order is that of the strings) hold the position."""
    for s in searches:
        own = df.where(s.rows).select(F.hex(F.col(s.name).cast("binary")).alias("h"))
        prefix = ""
        while s.m > max_candidates:
            least, most = _aggregate(own, [F.min("h"), F.max("h")])
            if least == most:
                break
            same = next((i for i, (a, b) in enumerate(zip(least, most)) if a != b), min(len(least), len(most)))
            prefix = least[:same - same % 2]
            part = F.substring("h", len(prefix) + 1, 4)
            for key, n in sorted(own.groupBy(part.alias("p")).count().collect()):  # at most 65,793 prefixes
                if s.t < n:
                    break
                s.t -= n
            s.m, prefix = n, prefix + key
            # a string that ends here is no beginning of the others
            own = own.where((F.col("h") == prefix) if len(key) < 4 else F.col("h").startswith(prefix))
        if s.m > max_candidates:
            value = least
        else:
            value = _aggregate(own, [F.get(F.sort_array(F.collect_list("h")), F.lit(s.t))])[0]
        s.value, s.done = bytes.fromhex(value).decode(), True


def values_at(df: DataFrame, wanted: dict[str, tuple[Column, int, list[int]]], max_candidates: int = MAX_CANDIDATES,
              margin: float = MARGIN) -> dict[str, dict[int, object]]:
    """For each name, (column, number of its non-null rows, positions among
    them): the values at the positions."""
    found = {}
    for name, (x, n, ranks) in wanted.items():
        rows = x.isNotNull()
        found[name] = {r: _Search(x, rows, r, n) for r in set(ranks)}
    _solve(df, [s for own in found.values() for s in own.values()], max_candidates, margin)
    return {name: {r: s.value for r, s in own.items()} for name, own in found.items()}


def keys_at(df: DataFrame, order_cols, indices, max_candidates: int = MAX_CANDIDATES,
            margin: float = MARGIN) -> dict[int, tuple]:
    """Key tuples (in the columns' own types) of the rows at the given
    positions of the order (1 or 2 columns, the last one unique when ranks
    must identify single rows). Null keys come last. The second column may be
    a string, in the order of its UTF-8 bytes."""
    wanted = sorted({int(i) for i in indices if i is not None and i >= 0})
    cols = list(order_cols)
    if not 1 <= len(cols) <= 2:
        raise ValueError("keys_at orders by one or two columns")
    if not wanted:
        return {}
    p, p_is_ts = _numeric(df, cols[0])
    s, s_is_ts = _numeric(df, cols[1]) if len(cols) == 2 else (None, False)
    base = df.select(*cols)
    n, full = _aggregate(base, [F.count(F.lit(1)), F.count(p)])
    ranks = [r for r in wanted if r < n]
    known = p.isNotNull()
    first = {r: _Search(p, known, r, full) for r in ranks if r < full}
    _solve(base, list(first.values()), max_candidates, margin)
    values = {r: first[r].value if r in first else None for r in ranks}
    if s is None or not ranks:
        return {r: (_typed(values[r], p_is_ts),) for r in ranks}
    # the secondary among the rows with the same primary value
    run = {r: p.isNull() if values[r] is None else p == F.lit(values[r]) for r in ranks}
    sizes = _aggregate(base, [F.array(F.count_if(F.lit(False)) + full if values[r] is None else F.count_if(p < F.lit(values[r])),
                                      F.count(F.when(run[r], s))) for r in ranks])
    second = {r: _Search(s, run[r] & s.isNotNull(), r - below, m) for r, (below, m) in zip(ranks, sizes) if r - below < m}
    if isinstance(base.schema[cols[1]].dataType, T.StringType):
        for q in second.values():
            q.name = cols[1]
        _solve_strings(base, list(second.values()), max_candidates)
    else:
        _solve(base, list(second.values()), max_candidates, margin)
    return {r: (_typed(values[r], p_is_ts), _typed(second[r].value, s_is_ts) if r in second else None) for r in ranks}


def _typed(value, is_ts: bool):
    return _from_micros(value) if is_ts and value is not None else value


def _from_micros(us: int):
    import datetime as dt
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(us))
