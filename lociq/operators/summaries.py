"""Summaries at several resolutions: signal levels that answer a range from a few blocks, and pixel grids of points."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociq.operators.intervals import _covering, _highest, binned

WIDTH, FACTOR, LEVELS = 4096, 8, 6  # bases of a block of the lowest level, how much wider each level is, and how many there are


def block(level: int) -> int:
    return WIDTH * FACTOR**level


def levels(signal: DataFrame, value: str) -> DataFrame:
    """Blocks of each level that intervals touch: chrom, level, block, top (largest value), total (value times bases) and bases (by interval).

    Intervals fold into the lowest level, and that, small as it is, into all others; sums and maxima merge, so a table of new intervals can be added by a union.
    """
    first, last = F.floor(F.col("start_pos") / WIDTH), F.floor((F.col("end_pos") - 1) / WIDTH)
    cut = signal.where("end_pos > start_pos").withColumn("_block", F.explode(F.sequence(first, last)))
    inside = F.least("end_pos", (F.col("_block") + 1) * WIDTH) - F.greatest("start_pos", F.col("_block") * WIDTH)
    low = cut.groupBy("chrom", "_block").agg(F.max(value).alias("top"), F.sum(F.col(value) * inside).alias("total"), F.sum(inside).alias("bases"))
    wide = low.select("chrom", F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.floor(F.col("_block") / FACTOR**k).alias("block")) for k in range(LEVELS)))).alias("x"), "top", "total", "bases")
    return wide.groupBy("chrom", "x.level", "x.block").agg(F.max("top").alias("top"), F.sum("total").alias("total"), F.sum("bases").alias("bases"))


def blocks_of(start: Column, end: Column) -> Column:
    """The whole blocks that a range is made of, each of the highest level that fits: at most 2 (FACTOR - 1) for each level below the highest."""
    low = [F.ceil(start / block(k)) for k in range(LEVELS)]
    high = [F.floor(end / block(k)) for k in range(LEVELS)]
    none = F.array().cast("array<bigint>")
    run = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(none)
    of_level = lambda k: lambda b: F.struct(F.lit(k).alias("level"), b.alias("block"))
    out = []
    for k in range(LEVELS):
        if k + 1 < LEVELS:
            inner = low[k + 1] < high[k + 1]  # else nothing of this range is left to the level above
            own = F.when(inner, F.concat(run(low[k], low[k + 1] * FACTOR), run(high[k + 1] * FACTOR, high[k]))).otherwise(run(low[k], high[k]))
        else:
            own = run(low[k], high[k])
        out.append(F.transform(own, of_level(k)))
    return F.concat(*out)


def edges_of(start: Column, end: Column) -> Column:
    """What of a range lies outside whole blocks of the lowest level: two stretches at most, each shorter than a block, or one shorter than two."""
    low, high = F.ceil(start / WIDTH) * WIDTH, F.floor(end / WIDTH) * WIDTH
    one = lambda a, b: F.struct(a.cast("long").alias("s"), b.cast("long").alias("e"))
    return F.filter(F.when(low < high, F.array(one(start, low), one(high, end))).otherwise(F.array(one(start, end))), lambda x: x["s"] < x["e"])


def _within(key: str, value: str):
    """Summaries of pieces of a block of the lowest level from its bases: the largest value at each, and running sums of values and of intervals."""

    def run(of, pieces, rows):
        import pyarrow as pa

        low = of[1].as_py() * WIDTH
        place = lambda t, c: np.clip(t[c].to_numpy() - low, 0, WIDTH)
        begin, end, some = place(rows, "start_pos"), place(rows, "end_pos"), rows[value].is_valid().to_numpy()
        values, rank = np.unique(rows[value].drop_null().to_numpy(), return_inverse=True)
        best = _covering(begin[some], end[some], rank.reshape(-1), 0, WIDTH)
        weight = rows[value].fill_null(0).to_numpy()
        weight = weight.astype(np.float64 if weight.dtype.kind == "f" else np.int64)

        def sums(of_row: np.ndarray) -> np.ndarray:
            step = np.zeros(WIDTH + 1, of_row.dtype)
            np.add.at(step, begin, of_row)
            np.subtract.at(step, end, of_row)
            return np.append(step[:1] * 0, np.cumsum(np.cumsum(step)[:-1]))

        first, last = place(pieces, "start_pos"), place(pieces, "end_pos")
        bases, total = (x[last] - x[first] for x in (sums(np.ones(len(begin), np.int64)), sums(weight)))
        met = bases > 0
        top = _highest(best, first[met], last[met])
        own = pa.array(values[np.maximum(top, 0)] if len(values) else np.zeros(len(top), weight.dtype), mask=top < 0)
        return pa.table({key: pieces[key].filter(pa.array(met)), "top": own, "total": pa.array(total[met], mask=top < 0), "bases": bases[met]})

    return run


def range_summaries(regions: DataFrame, key: str, signal: DataFrame, value: str, blocks: DataFrame | None = None) -> DataFrame:
    """Largest value, value times bases and bases of the intervals of ``signal`` within each region: ``key``, top, total, bases; regions that touch none have no row.
    Empty intervals and regions count for nothing. ``value`` is a whole number or a float.

    The whole blocks that regions are made of, many of them the same ones, are looked up once for each first and last block, by a number of rows that grows with the logarithm of the
    width. Edges are answered from the bases of their block, so no pair is made. ``blocks`` are the signal's ``levels``, if they are stored.
    """
    signal = signal.where("end_pos > start_pos and chrom is not null").select("chrom", "start_pos", "end_pos", value)
    blocks = levels(signal, value) if blocks is None else blocks
    asked = regions.where("end_pos > start_pos and chrom is not null").select(F.col(key), "chrom", "start_pos", "end_pos")
    run_ = ["chrom", "_low", "_high"]
    wide = asked.select(key, "chrom", F.ceil(F.col("start_pos") / WIDTH).alias("_low"), F.floor(F.col("end_pos") / WIDTH).alias("_high")).where("_low < _high")
    whole = wide.select(*run_).distinct().select(*run_, F.explode(blocks_of(F.col("_low") * WIDTH, F.col("_high") * WIDTH)).alias("x")).select(*run_, "x.level", "x.block")
    # rows grow where ranges become blocks, which Spark's estimate of a side doesn't see: it would send them all through the driver
    middle = whole.hint("merge").join(blocks, ["chrom", "level", "block"]).groupBy(*run_).agg(F.max("top").alias("top"), F.sum("total").alias("total"), F.sum("bases").alias("bases"))
    inner = wide.hint("merge").join(middle, run_).select(key, "top", "total", "bases")
    rim = asked.select(key, "chrom", F.explode(edges_of(F.col("start_pos"), F.col("end_pos"))).alias("x")).select(key, "chrom", F.col("x.s").alias("start_pos"), F.col("x.e").alias("end_pos"))
    of, many = dict(regions.dtypes)[key], dict(signal.dtypes)[value]
    kind = f"`{key}` {of}, top {many}, total {'double' if many in ('float', 'double') else 'bigint'}, bases bigint"
    outer = binned(rim, WIDTH).groupBy("chrom", "bin").cogroup(binned(signal, WIDTH).groupBy("chrom", "bin")).applyInArrow(_within(key, value), kind)
    return inner.unionByName(outer).groupBy(key).agg(F.max("top").alias("top"), F.sum("total").alias("total"), F.sum("bases").alias("bases"))


def raster(points: DataFrame, x: str, y: str, box: tuple[float, float, float, float], size: tuple[int, int], kind: str, halvings: int = 3) -> DataFrame:
    """Counts of points by pixel and ``kind``, at the resolution of ``size`` and ``halvings`` coarser ones: level, px, py, kind, n.

    ``box`` is x from, x to, y from, y to, half open; points outside, and those without a place, are left out. The finest grid is counted once, the coarser ones are
    made of its pixels; grids of parts of the data add up.
    """
    x0, x1, y0, y1 = box
    px, py = (F.floor((F.col(c).cast("double") - a) / (b - a) * n).cast("long") for c, a, b, n in ((x, x0, x1, size[0]), (y, y0, y1, size[1])))
    inside = (F.col(x) >= x0) & (F.col(x) < x1) & (F.col(y) >= y0) & (F.col(y) < y1)
    fine = points.where(inside).groupBy(px.alias("px"), py.alias("py"), F.col(kind).alias("kind")).agg(F.count("*").alias("n"))
    step = F.array(*(F.struct(F.lit(k).alias("level"), F.floor(F.col("px") / 2**k).alias("px"), F.floor(F.col("py") / 2**k).alias("py")) for k in range(halvings + 1)))
    return fine.select(F.explode(step).alias("x"), "kind", "n").groupBy("x.level", "x.px", "x.py", "kind").agg(F.sum("n").alias("n"))
