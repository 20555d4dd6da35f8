"""Positional index and look-back windows that never put a whole series in one task.

A window ``partitionBy(symbol).orderBy(date)`` sends every row of a symbol to
one task; if one symbol holds a third of the data, that task holds a third of
the data. The two helpers below give exactly the same answers as the simple
window while bounding the rows any single window partition sees:

* ``series_index`` -- a dense 0-based position per series (two-level rank):
  count rows per ``(symbol, bucket)`` (map-side combined), running-sum those
  small counts into offsets, then ``row_number`` inside each bucket.
* ``with_lookback`` -- look-back windows over ``idx`` (halo blocks): rows are
  cut into blocks of ``block_rows`` consecutive positions, and the last ``k``
  rows of each block are also emitted into the next block, so a window that
  looks back at most ``k`` rows is complete inside one block. Halo copies
  are dropped afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DEFAULT_BLOCK_ROWS = 8192


def month_bucket(order_col: str) -> Column:
    """Default bucket: calendar month of the ordering column (monotone in it)."""
    return F.year(order_col) * 12 + F.month(order_col)


def bucket_offsets(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "date",
    bucket: Column | None = None,
) -> DataFrame:
    """Per ``(keys, _bkt)``: row count ``_n`` and the number of earlier rows ``_off``.

    The result has one row per series and bucket (e.g. per symbol and month),
    so the running sum is a window over a table that is tiny next to the data.
    """
    b = F.col("_bkt") if "_bkt" in df.columns else (bucket if bucket is not None else month_bucket(order_col))
    counts = df.select(*keys, b.alias("_bkt")).groupBy(*keys, "_bkt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("long"))


#: Rows that a bucket made from the data should hold, and the most buckets of one series.
BUCKET_ROWS = 1 << 20
MOST_BUCKETS = 4096
_FAN = 64  # children of a node of the search tree over the cuts


def as_number(df: DataFrame, col: str) -> Column:
    """An ordering column as a number that keeps its order (days, microseconds or the number itself)."""
    kind = df.schema[col].dataType.typeName()
    c = F.col(f"`{col}`")
    if kind == "date":
        return F.unix_date(c)
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp"))
    if kind in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        return c
    raise TypeError(f"buckets from the data need a date, a time or a number, not {kind}: pass a bucket column")


def data_buckets(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "date",
    rows: int = BUCKET_ROWS,
    most: int = MOST_BUCKETS,
) -> DataFrame:
    """Add ``_bkt``, a bucket that rises with ``order_col`` and whose bounds come from the data.

    One aggregate per series (its count and a mergeable quantile sketch of the
    ordering column, combined before the shuffle) gives ``most - 1`` cuts;
    a series keeps every n-th of them, so that its buckets hold about ``rows``
    rows (within a quarter; a series of more than ``rows * most`` rows has
    ``most`` buckets), wherever its rows lie: a series with all rows in one
    month or one second is cut as finely as one spread over years. Equal values
    share a bucket. The cuts (about one per ``rows`` rows) are broadcast, so no
    row moves before it has a bucket, however few the series; a row finds its
    bucket in a search tree over the cuts of its series. The result is
    partitioned by ``(keys, _bkt)``; the input is read twice.
    """
    x = as_number(df, order_col)
    near = max(10_000, 10 * int(most))
    tag = uuid.uuid4().hex[:8]  # no column of the input can have these names
    n, cut, number, node = (f"_{c}_{tag}" for c in ("n", "cut", "x", "node"))
    cuts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(n),
        F.percentile_approx(x, [i / most for i in range(1, most)], near).alias(cut),
    )
    each = F.greatest(F.ceil(F.lit(int(rows)) * F.lit(int(most)) / F.col(n)), F.lit(1)).cast("int")
    cuts = cuts.withColumn(n, each).withColumn(cut, F.expr(f"array_distinct(filter({cut}, (c, i) -> (i + 1) % {n} = 0))"))
    # Node 1 is the root, node v has the children _FAN * v + 0, 1, ...; a node holds the cuts between its children. Many small
    # nodes, as a join hands every row a copy of what it found; and shuffled by the series, few series would fill as few tasks.
    depth = 1
    while _FAN**depth < most:
        depth += 1
    nodes = F.expr("concat(" + ", ".join(_tree_level(cut, level, _FAN ** (depth - 1 - level)) for level in range(depth)) + ")")
    tree = cuts.select(*keys, F.explode(nodes).alias(node)).select(*keys, f"{node}.*")
    d = df.withColumn(number, x).withColumn(node, F.lit(1))
    for level in range(depth):
        own = {k: f"_k{i}_{level}_{tag}" for i, k in enumerate([*keys, "node", "cuts"])}
        found = F.broadcast(tree.select(*[F.col(k).alias(v) for k, v in own.items()]))
        same = [F.col(k).eqNullSafe(F.col(own[k])) for k in keys] + [F.col(node) == F.col(own["node"])]
        d = d.join(found, same, "left").withColumn(node, F.expr(f"{_FAN} * {node} + {_children_before(own['cuts'], number)}"))
    bucket = F.when(F.col(number).isNotNull(), F.col(node) - F.lit(_FAN**depth)).cast("int")
    return d.select(*[F.col(f"`{c}`") for c in df.columns], bucket.alias("_bkt")).repartition(*keys, "_bkt")


def _tree_level(cut: str, level: int, span: int) -> str:
    """SQL: the nodes of one level that hold a cut, as ``array<struct<node, cuts>>``; ``span`` buckets lie under a child."""
    cuts = f"transform(sequence(0, {_FAN - 2}), i -> get({cut}, {_FAN * span} * a + {span} * (i + 1) - 1))"
    nodes = f"transform(sequence(0, cast((size({cut}) - {span}) div {_FAN * span} as int)), a -> struct({_FAN**level} + a as node, {cuts} as cuts))"
    return f"if(size({cut}) >= {span}, {nodes}, array())"


def _children_before(cuts: str, number: str) -> str:
    """SQL: how many cuts of a node are <= ``number`` (none where it is null), by binary search; get() beyond the last is null."""
    steps = ", ".join(str(1 << b) for b in reversed(range((_FAN - 1).bit_length())))
    return f"aggregate(array({steps}), 0, (at, step) -> if(get({cuts}, at + step - 1) <= {number}, at + step, at))"


def series_index(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "date",
    idx_col: str = "idx",
    bucket: Column | None = None,
    offsets: DataFrame | None = None,
    constant: Sequence[str] = (),
) -> DataFrame:
    """Add a dense 0-based position ``idx_col`` per series, ordered by ``order_col``.

    ``(keys, order_col)`` must be unique (dedupe first), otherwise ties are
    broken arbitrarily, as ``row_number`` would. A ``_bkt`` column already on
    ``df`` (e.g. from ``data_buckets`` or ``partition_by_bucket``) is used as the bucket. Rows
    with a NULL key or NULL ordering value have no position and are left out.
    """
    # One exchange by (keys, bucket) feeds the counts and the row numbers. If the input is an
    # aggregate whose value columns the counts prune, write it first (see fixtures.daily_series).
    d = df if "_bkt" in df.columns else partition_by_bucket(df, keys, order_col, bucket, constant)
    # Stated once for both branches: the join would otherwise infer these
    # filters for the offsets branch only, and the two branches would no
    # longer share their upstream shuffle (the upstream would run twice).
    valid = F.col("_bkt").isNotNull()
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    d = d.filter(valid)
    offs = offsets if offsets is not None else bucket_offsets(d, keys, order_col)
    # Numbered before the join: the window's sort serves the join by (keys, bucket), too.
    rn = F.row_number().over(Window.partitionBy(*keys, "_bkt").orderBy(order_col))
    # Every bucket has an offset; a left join keeps the plan free of extra
    # inferred filters on this side.
    return (
        d.withColumn("_rn", rn)
        .join(offs.select(*keys, "_bkt", "_off"), [*keys, "_bkt"], "left")
        .withColumn(idx_col, F.col("_off") + F.col("_rn") - F.lit(1))
        .drop("_bkt", "_off", "_rn")
    )


def partition_by_bucket(
    df: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order_col: str = "date",
    bucket: Column | None = None,
    constant: Sequence[str] = (),
) -> DataFrame:
    """Hash-partition rows by ``(keys, bucket)`` and keep it as ``_bkt``.

    One exchange then serves everything keyed by a finer key that contains
    it: a dedupe on ``(symbol, _bkt, date)``, the bucket counts and the
    row numbers of ``series_index``. A hot symbol still spreads over its
    buckets. The default bucket is the calendar month (at most 31 rows per
    symbol for daily data); for intraday series use ``data_buckets`` or pass a
    finer monotone bucket (e.g. ``floor(unix_seconds / 3600)``).

    ``constant`` names the keys that the caller has fixed to one literal: such
    a key separates nothing, and Catalyst drops it from window keys, so it is
    left out of the hash keys, too, and the windows downstream still find
    their partitioning.
    """
    b = bucket if bucket is not None else month_bucket(order_col)
    return df.withColumn("_bkt", b).repartition(*[k for k in keys if k not in constant], "_bkt")


def with_lookback(
    df: DataFrame,
    build: Callable[[DataFrame, WindowSpec], DataFrame],
    k: int,
    keys: Sequence[str] = ("symbol",),
    idx_col: str = "idx",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Run ``build(frame, window)`` where ``window`` is ordered by ``idx_col``
    and any frame the caller puts on it looks back at most ``k`` rows.

    ``build`` gets a frame with the halo rows included and must only add
    columns. The result has exactly the rows of ``df``.
    """
    c = max(int(block_rows), int(k), 1)
    idx = F.col(idx_col)
    blk = F.floor(idx / F.lit(c)).cast("long")
    if k > 0:
        blocks = F.when((idx % F.lit(c)) >= F.lit(c - k), F.array(blk, blk + F.lit(1))).otherwise(F.array(blk))
    else:
        blocks = F.array(blk)
    expanded = df.select("*", F.posexplode(blocks).alias("_halo", "_blk"))
    w = Window.partitionBy(*keys, "_blk").orderBy(idx_col)
    out = build(expanded, w)
    return out.filter(F.col("_halo") == 0).drop("_halo", "_blk")
