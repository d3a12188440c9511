"""Global order without a single-partition window (the M0 primitive).

A window with ORDER BY and no PARTITION BY runs in one task. Instead:

1. ``repartitionByRange`` splits the rows into contiguous key ranges of
   similar size (bounds come from a sample, so a hot key value cannot make
   one range much larger than the rest, unless a single value repeats),
2. rows are sorted inside each range and tagged with
   ``monotonically_increasing_id``, whose high bits are the range (block)
   number and low bits the position inside it,
3. the tagged frame is checkpointed to the shared checkpoint folder, which
   fixes the block assignment (the range sample is random) and cuts lineage,
4. per-block totals (one row per block, so the size is bounded by the
   partition count) give exclusive prefix offsets that are broadcast back.

Running sums inside a block use a window partitioned by the block id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

BLOCK = "_blk"
POS = "_pos"
_LOW_BITS = (1 << 33) - 1
ROWS_PER_BLOCK = 2_000_000     # narrow rows per range block (one task's window input)


def range_blocks(df: DataFrame, order_cols, n_blocks: int | None = None) -> DataFrame:
    """Checkpointed copy of ``df`` with block id and in-block position.
    ``order_cols`` must give a total order (end with a unique column) when
    positions are used as ranks. Without ``n_blocks`` the block count grows
    with the input (at most ROWS_PER_BLOCK rows per block, at least the
    shuffle partition count); the input is persisted so counting it and
    range-partitioning it read it once."""
    from pyspark import StorageLevel
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cached = None
    if not n_blocks:
        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        rows = cached.count()
        n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_BLOCK), 1)
        df = cached
    tagged = (df.repartitionByRange(n_blocks, *order_cols)
                .sortWithinPartitions(*order_cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = tagged.checkpoint(eager=True)
    if cached is not None:
        cached.unpersist()
    return (tagged.withColumn(BLOCK, F.shiftright("_mid", 33).cast("int"))
                  .withColumn(POS, F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
                  .drop("_mid"))


def block_offsets(blocked: DataFrame, sums: dict[str, Column] | None = None) -> DataFrame:
    """One row per block: ``_n`` rows before the block, plus the exclusive
    prefix of every named sum. The window here orders at most a few thousand
    rows (one per block)."""
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    names = list((sums or {}).keys())
    aggs += [F.sum(c).alias(f"_t_{k}") for k, c in (sums or {}).items()]
    totals = blocked.groupBy(BLOCK).agg(*aggs)
    prior = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    out = totals.withColumn("_n_before", F.coalesce(F.sum("_cnt").over(prior), F.lit(0)))
    for k in names:
        out = out.withColumn(f"_before_{k}", F.coalesce(F.sum(f"_t_{k}").over(prior), F.lit(0)))
    return out.select(BLOCK, "_n_before", *[f"_before_{k}" for k in names])


def with_global_index(df: DataFrame, order_cols, index_col: str = "_gidx",
                      n_blocks: int | None = None) -> DataFrame:
    """0-based global row number in ``order_cols`` order (a total order)."""
    blocked = range_blocks(df, order_cols, n_blocks)
    offs = block_offsets(blocked)
    return (blocked.join(F.broadcast(offs), BLOCK)
                   .withColumn(index_col, F.col("_n_before") + F.col(POS))
                   .drop(BLOCK, POS, "_n_before"))


def with_running_sums(df: DataFrame, order_cols, sums: dict[str, Column],
                      inclusive: bool = True, n_blocks: int | None = None) -> DataFrame:
    """Global running sums of each expression along ``order_cols``; output
    column ``name`` holds the sum up to (and, if inclusive, including) the row."""
    blocked = range_blocks(df.withColumns(sums), order_cols, n_blocks)
    offs = block_offsets(blocked, {k: F.col(k) for k in sums})
    end = Window.currentRow if inclusive else -1
    inblock = Window.partitionBy(BLOCK).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, end)
    out = blocked.join(F.broadcast(offs), BLOCK)
    for k in sums:
        out = out.withColumn(
            k, F.col(f"_before_{k}") + F.coalesce(F.sum(k).over(inblock), F.lit(0)))
    return out.drop(BLOCK, POS, "_n_before", *[f"_before_{k}" for k in sums])
