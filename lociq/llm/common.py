"""Shared helpers: staging tables in the cluster's shared folder, UTF-8 views, connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.functions.staging import release, shared_path

ROUNDS = 64  # of components; each at least halves what is left of a chain

U64 = np.uint64
TEXT_BLOCK = 1 << 17  # bytes of text whose words are hashed at once: bounds the arrays of a worker and keeps them in its cache


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts lineage, survives lost executors. ``release`` deletes it.

    ``batch_rows`` bounds the rows of an Arrow batch of this write, for rows that hold whole texts or sets.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    try:
        if batch_rows:
            spark.conf.set(setting, str(batch_rows))
        df.write.option("compression", "zstd").option("parquet.block.size.row.check.min", "4").parquet(path)  # rows may hold megabytes
    finally:
        spark.conf.set(setting, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first, last = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return buf[first:last], offsets - first


def fitting(sizes: list[tuple], most: int) -> list:
    """Keys of (key, size), in order, of those that fit into ``most`` together; what doesn't fit is passed over."""
    out, total = [], 0
    for key, size in sizes:
        if total + size <= most:
            out.append(key)
            total += size
    return out


def row_blocks(offsets: np.ndarray, limit: int):
    """Row ranges (i, j) of at most ``limit`` bytes each, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on unsigned 64-bit values."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class WordHasher:
    """64-bit hashes of the words of whole texts, words being runs of bytes that aren't separators.

    A word's hash sums its blocks of eight bytes, each mixed with its place by a finalizer that isn't linear, and is mixed again with the word's length: words of regular
    patterns, which collide under polynomials modulo 2^64, are as far apart as any.
    """

    STEP = U64(0x9E3779B97F4A7C15)
    KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)  # masks of the first bytes of a block

    def __init__(self, lower: np.ndarray, separator: np.ndarray):
        self.lower, self.separator = lower, separator

    def hashes(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from ``start`` to ``end`` (not empty)."""
        blocks = (end - start + 7) >> 3
        first = np.cumsum(blocks) - blocks
        number = np.arange(int(blocks.sum())) - np.repeat(first, blocks)
        at = np.repeat(start, blocks) + 8 * number
        padded = np.concatenate([self.lower[buf], np.zeros(8, np.uint8)])
        value = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)[at]).view("<u8")[:, 0]
        value = value & self.KEEP[np.minimum(np.repeat(end, blocks) - at, 8)]
        value = mix64(value + mix64((number + 1).astype(U64) * self.STEP))
        return mix64(np.add.reduceat(value, first) + (end - start).astype(U64) * self.STEP)

    def words(self, buf: np.ndarray, offsets: np.ndarray, head: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each word: row, first byte, end byte, hash; with ``head``, the hash is that of the word's first ``head`` bytes."""
        n = len(buf)
        part = ~self.separator[buf]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = part[:-1], part[1:]
        start = np.flatnonzero(part & (~before | edge[:n]))
        end = np.flatnonzero(part & (~after | edge[1:])) + 1
        if not len(start):
            empty = np.zeros(0, np.int64)
            return empty, empty, empty, np.zeros(0, U64)
        until = np.minimum(end, start + head) if head else end
        return np.searchsorted(offsets, start, side="right") - 1, start, end, self.hashes(buf, start, until)


def ascii_lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def ascii_space() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[0x20, *range(0x09, 0x0E)]] = True
    return out


def _contract(batches):
    """Replace the links of a partition by stars (node, smallest id that the partition links it with)."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = root[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    nodes = np.array([x for x in root if find(x) != x], np.int64)
    for at in range(0, len(nodes), 65536):
        part = nodes[at : at + 65536]
        yield pa.RecordBatch.from_pydict({"hi": pa.array(part), "lo": pa.array([find(x) for x in part.tolist()], pa.int64())})


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links of long ids: rows (id, component), component the smallest id reachable.

    Each round contracts the links within partitions, then takes a large-star and a small-star step and writes the links to the shared
    folder; all state stays distributed. A star's hub never gathers its neighbours in one task: only minima are
    aggregated, with partial aggregation. Rounds grow with the logarithm of the longest chain. Links of nulls and loops are
    ignored; without links there are no rows.
    """
    few = max(8, shuffle_partitions(links.sparkSession) // 8)
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi <> lo")
    edges = staged(edges.coalesce(few).mapInArrow(_contract, "hi long, lo long"), "edges")
    before = None
    for _ in range(ROUNDS):
        both = edges.union(edges.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(least, "hi")
        small = joined.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").union(least)
        last, edges = edges, staged(small.coalesce(few).mapInArrow(_contract, "hi long, lo long"), "edges")
        release(last)
        # settled once each node has one star and no hub stands in another star
        hubs = edges.select("lo").distinct().join(edges.select(F.col("hi").alias("lo")), "lo", "left_semi").limit(1).count()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before or not now[0] or (not hubs and edges.select("hi").distinct().count() == now[0]):
            break
        before = now
    else:
        raise RuntimeError(f"links not settled after {ROUNDS} rounds")
    ends = edges.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return ends.union(roots)
