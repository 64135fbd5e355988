"""Embedding near-duplicates by collision-counting projections.

Windows along single projections can't serve as candidates: at cosine 0.9 a window that holds most partners of a vector also holds about a
quarter of all vectors, on every projection. So nothing is sorted along a projection. The signs of a bundle of projections are hashed into a key,
in several tables, and only vectors of equal keys meet; these then count query-centred window collisions: in how many
of WINDOWS further projections the pair differs by at most ``width``. The least count is calibrated from the collision probability at
the cosine limit, so that a pair at the limit falls below it with probability ``miss``. What passes is verified by its cosine in
double precision. The length of a bundle grows with the logarithm of the number of vectors, which keeps the vectors of a key few at
every size, and the number of tables follows from the recall wanted of pairs at the limit; pairs above it are found more surely.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociq.llm.common import U64, components, mix64, release, shuffle_partitions, staged

WINDOWS = 32
SPARE = 3  # signs of a bundle beyond the logarithm of the number of vectors: 2 ** -SPARE unrelated vectors of equal key a table
BLOCK = 512  # vectors of a block


def layout(vectors: int, cosine: float, missed: float) -> tuple[int, int]:
    """Signs of a bundle, and tables: a pair at ``cosine`` lies together in none of the tables with probability ``missed`` at most."""
    bundle = max(4, math.ceil(math.log2(max(2, vectors))) + SPARE)
    together = (1 - math.acos(cosine) / math.pi) ** bundle
    return bundle, math.ceil(math.log(missed) / math.log1p(-together))


@functools.cache
def directions(dim: int, bundle: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    """Random directions of the bundles, and of the windows."""
    r = np.random.Generator(np.random.PCG64(7 + dim))
    windows = r.normal(size=(dim, WINDOWS))
    return r.normal(size=(dim, tables * bundle)), windows


def window(cosine: float, miss: float) -> tuple[float, int]:
    """Half width of the windows and least number of collisions of WINDOWS."""
    spread = math.sqrt(2 - 2 * cosine)
    width = 1.35 * spread
    p = math.erf(1.35 / math.sqrt(2))
    below, least = 0.0, 0
    while least < WINDOWS:
        below += math.comb(WINDOWS, least) * p**least * (1 - p) ** (WINDOWS - least)
        if below > miss:
            break
        least += 1
    return width, least


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def table_keys(u: np.ndarray, bundle: int, tables: int) -> np.ndarray:
    """64-bit key of each vector in each table: the table and the signs of its bundle."""
    sign = (u @ directions(u.shape[1], bundle, tables)[0] > 0).reshape(len(u), tables, bundle)
    h = np.broadcast_to(mix64(np.arange(1, tables + 1, dtype=U64) + (U64(u.shape[1]) << U64(32))), (len(u), tables)).copy()
    for at in range(0, bundle, 32):
        part = sign[:, :, at : at + 32]
        h = mix64(h + (part @ (U64(1) << np.arange(part.shape[2], dtype=U64))))
    return h


def packed(column: pa.Array) -> pa.Array:
    """Vectors as little-endian bytes of their own precision."""
    kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
    size = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]).astype(np.int64) * np.dtype(kind).itemsize
    flat = np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False), kind)
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def unpacked(column: pa.Array, kind):
    """Rows and matrix of each dimension."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if len(column) else np.zeros(0, np.uint8)
    size = np.diff(off)
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield rows, data[off[rows][:, None] + np.arange(n)].view(kind).astype(np.float64)


def _packed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("size"), packed(batch.column("embedding"))], ["vec_id", "size", "embedding"])


def _cells(kind, bundle: int, tables: int):
    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id").to_numpy()
            for rows, x in unpacked(batch.column("embedding"), kind):
                for at in range(0, len(rows), 512):
                    keys = table_keys(unit(x[at : at + 512]), bundle, tables)
                    yield pa.RecordBatch.from_pydict({"bucket": pa.array(keys.view(np.int64).ravel()), "tab": pa.array(np.tile(np.arange(tables, dtype=np.int32), len(keys))), "vec_id": pa.array(np.repeat(ids[rows[at : at + len(keys)]], tables))})

    return run


def _pairs(first: np.ndarray, size: np.ndarray, most: int):
    """All index pairs i < j within groups of rows (first row, size), in chunks of about ``most``."""
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(row)) + np.repeat(first - (np.cumsum(size) - size), size)
    after = first[row] + size[row] - 1 - at  # partners behind each row
    ends = np.cumsum(after)
    begin = 0
    while begin < len(at):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + most, side="right")))
        n = after[begin:end]
        i = np.repeat(at[begin:end], n)
        yield i, i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin = end


def _linked(kind, cosine: float, width: float, least: int, bundle: int, tables: int):
    """Links within the blocks of a partition sorted by block: counts by vector, and links that join components.

    A pair counts in the first table that it meets in. In a block of two parts, only pairs across them count.
    """

    def of_dimension(ids, size, tab, part, across, group, x):
        u = unit(x)
        at = (u @ directions(u.shape[1], bundle, tables)[1]).astype(np.float32)
        start = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        count, root = np.zeros(len(ids), np.int64), {}
        links = []

        def find(v):
            while (up := root.setdefault(v, v)) != v:
                root[v] = v = root[up]
            return v

        for i, j in _pairs(start, np.diff(np.append(start, len(ids))), 100_000):
            ok = ~across[i] | (part[i] != part[j])
            i, j = i[ok], j[ok]
            ok = (np.abs(at[i] - at[j]) <= width).sum(axis=1) >= least
            i, j = i[ok], j[ok]
            ok = np.einsum("ij,ij->i", u[i], u[j]) >= cosine
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            mine, place = np.unique(np.concatenate([i, j]), return_inverse=True)
            keys = table_keys(u[mine], bundle, tables)  # of linked vectors only
            ok = np.concatenate([(keys[place[k : min(k + 4096, len(i))]] == keys[place[len(i) + k : len(i) + min(k + 4096, len(i))]]).argmax(axis=1) for k in range(0, len(i), 4096)]) == tab[i]
            i, j = i[ok], j[ok]
            np.add.at(count, i, size[j])
            np.add.at(count, j, size[i])
            for a, b in zip(ids[i].tolist(), ids[j].tolist(), strict=True):
                ra, rb = find(a), find(b)
                if ra != rb:
                    root[max(ra, rb)] = min(ra, rb)
                    links.append((a, b))
        found = np.flatnonzero(count)
        a, b = (np.array(v, np.int64) for v in zip(*links, strict=True)) if links else (np.zeros(0, np.int64),) * 2
        return pa.RecordBatch.from_pydict({"a": pa.array(np.append(ids[found], a)), "b": pa.array(np.append(ids[found], b)), "n": pa.array(np.append(count[found], np.zeros(len(a), np.int64)))})

    def of_rows(table):
        t = table.combine_chunks().to_batches()[0] if table.num_rows else None
        if t is None:
            return
        block = t.column("block").to_pylist()
        name = list(zip(t.column("bucket").to_pylist(), block, strict=True))
        group = np.cumsum([0] + [x != y for x, y in zip(name[1:], name[:-1], strict=True)])
        across = np.array([len(set(b.split("/"))) > 1 for b in block])
        ids, size, tab, part = (t.column(c).to_numpy() for c in ("vec_id", "size", "tab", "part"))
        for rows, x in unpacked(t.column("embedding"), kind):
            yield of_dimension(ids[rows], size[rows], tab[rows], part[rows], across[rows], group[rows], x)

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            last = tuple(table.column(c)[table.num_rows - 1].as_py() for c in ("bucket", "block")) if table.num_rows else None
            n = table.num_rows
            while n and tuple(table.column(c)[n - 1].as_py() for c in ("bucket", "block")) == last:
                n -= 1
            yield from of_rows(table.slice(0, n))
            held = table.slice(n)
        if held is not None:
            yield from of_rows(held)

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.9, miss: float = 1e-4, missed: float = 0.005) -> DataFrame:
    """Links of ``vectors`` (vec_id, embedding, any more columns) with cosine >= ``cosine``: vec_id, n_links, component_id, kept.

    A pair at ``cosine`` is missed with probability ``missed`` for lying together in no table, and ``miss`` for too few collisions.
    Equal vectors fold into one first and count with their number. Ids are grouped by key; vectors go to cells of two or more. Cells of more than BLOCK vectors are cut into
    parts, and each pair of parts is a block of its own, so no cell is ever gathered in one task nor emitted as pairs: blocks return counts by
    vector and the links that join components. Embeddings that are null, empty, zero, or hold null or non-finite components link with
    nothing, vectors of different dimensions don't link. Repeated rows of a vec_id are vectors of their own with one component.
    A row of null vec_id counts as no vector: n_links 0 and a null component. An empty table gives no rows.
    """
    fine = "vec_id is not null and size(embedding) > 0 and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(embedding, x -> x <> 0)"
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = np.float32 if single else np.float64
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding") if single else F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.withColumn("fine", F.coalesce(F.expr(fine), F.lit(False)))
    good = rows.where("fine").select("vec_id", "embedding", F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    same = good.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.any_value("embedding").alias("embedding"))
    same = staged(same, "vectors")
    one = same.select(F.col("rep").alias("vec_id"), "size", "embedding").mapInArrow(_packed, "vec_id long, size long, embedding binary")
    bundle, tables = layout(same.count(), cosine, missed)
    together = Window.partitionBy("bucket")
    cells = one.select("vec_id", "embedding").mapInArrow(_cells(kind, bundle, tables), "bucket long, tab int, vec_id long")
    cells = staged(cells.withColumn("n", F.count("*").over(together)).where("n > 1"), "cells")
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    member = cells.withColumn("part", F.pmod(F.xxhash64("vec_id"), parts).cast("int"))
    pair = lambda j: F.concat_ws("/", F.least("part", j).cast("string"), F.greatest("part", j).cast("string"))
    member = member.withColumn("block", F.explode(F.transform(F.sequence(F.lit(0), parts - 1), pair)))
    width, least = window(cosine, miss)
    member = member.join(one, "vec_id").select("bucket", "block", "tab", "vec_id", "size", "part", "embedding")
    member = member.repartition(shuffle_partitions(vectors.sparkSession), "bucket", "block").sortWithinPartitions("bucket", "block")
    found = staged(member.mapInArrow(_linked(kind, cosine, width, least, bundle, tables), "a long, b long, n long"), "links")
    release(cells)
    counts = found.where("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("links"))
    comp = components(found.where("n = 0").select("a", "b"))
    one = same.select("h1", "h2", "rep", "size").join(counts, "rep", "left").join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    one = one.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = good.select("vec_id", "h1", "h2").join(one, ["h1", "h2"]).select("vec_id", F.col("links").cast("long").alias("n_links"), F.col("component").alias("component_id"))
    lone = rows.where("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(lone).withColumn("kept", F.col("component_id").eqNullSafe(F.col("vec_id")))
