"""Best-fit packing of token pieces into sequences: large items matched in pairs, small ones best-fit into the gaps.

Only the lengths decide, so the plan is made from the count of pieces by length (at most ``capacity`` rows, however many
pieces there are), and each piece finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociq.llm import tokens
from lociq.llm.common import mix64, staged

CAPACITY = 1024


def plan(count: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, list[tuple[int, int, int, int]]], int]:
    """Slots by length, in rank order, and the number of sequences.

    A slot (bins, each, first, offset) takes ``each`` pieces in each of the sequences first, first + 1, ... first + bins - 1, from ``offset`` on.
    Lengths above a third of the capacity are large: two at most share a sequence, each is matched greedily, the largest first,
    with the largest that fits. Then small lengths, the largest first, fill the smallest gap that holds them.
    """
    count = {s: n for s, n in count.items() if n}
    slots: dict[int, list] = defaultdict(list)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # ranges of sequences by gap
    used = 0
    large = sorted((s for s in count if 3 * s > capacity), reverse=True)
    left = {s: count[s] for s in large}
    for s in large:
        while left[s]:
            mate = next((t for t in large if t <= min(s, capacity - s) and left[t] > (t == s)), None)
            if mate is None:
                n = left[s]
            elif mate == s:
                n = left[s] // 2
            else:
                n = min(left[s], left[mate])
            if mate == s:
                slots[s].append((n, 2, used, 0))
                left[s] -= 2 * n
            else:
                slots[s].append((n, 1, used, 0))
                left[s] -= n
                if mate is not None:
                    slots[mate].append((n, 1, used, s))
                    left[mate] -= n
            gaps[capacity - s - (mate or 0)].append((used, n))
            used += n

    def fill(s: int, g: int, first: int, bins: int, n: int) -> int:
        """Put up to n pieces of length s into sequences of gap g; how many remain."""
        each = g // s
        whole = min(bins, n // each)
        rest = n - whole * each if whole < bins else 0
        if whole:
            slots[s].append((whole, each, first, capacity - g))
            gaps[g - each * s].append((first, whole))
        if rest:
            slots[s].append((1, rest, first + whole, capacity - g))
            gaps[g - rest * s].append((first + whole, 1))
        if whole + bool(rest) < bins:
            gaps[g].append((first + whole + bool(rest), bins - whole - bool(rest)))
        return n - whole * each - rest

    for s in sorted((s for s in count if 3 * s <= capacity), reverse=True):
        n = count[s]
        for g in range(s, capacity + 1):
            while n and gaps[g]:
                n = fill(s, g, *gaps[g].pop(), n)
            if not n:
                break
        if n:
            bins = -(-n // (capacity // s))
            fill(s, capacity, used, bins, n)
            used += bins
    return dict(slots), used


def _pieces(file: str, capacity: int, plain: bool):
    def run(batches):
        encode = tokens.encoder(file, plain).ids
        met = TaskContext.get().partitionId() << 40
        for batch in tokens.small(batches):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = tokens.with_end(encode(text or ""))
                ends = range(len(ids) % capacity or min(len(ids), capacity), len(ids) + 1, capacity)
                start = 0
                for k, end in enumerate(ends):
                    for name, v in zip(out, (doc_id, k, start, end - start, zlib.crc32(ids[start:end].tobytes())), strict=True):
                        out[name].append(v)
                    start = end
            n = len(out["doc_id"])
            salt = mix64(np.arange(met, met + n, dtype=np.uint64)).view(np.int64)
            met += n
            yield pa.RecordBatch.from_arrays([*(pa.array(v, pa.int32() if k == "piece" else pa.int64()) for k, v in out.items()), pa.array(salt)], [*out, "salt"])

    return run


def _place(slots: dict):
    index = {}
    for s, rows in slots.items():
        bins, each, first, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        index[s] = (np.cumsum(bins * each), each, first, offset, bins * each)

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, at = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for s in np.unique(length):
                mine = length == s
                ends, each, first, offset, total = index[int(s)]
                k = np.searchsorted(ends, rank[mine], side="right")
                inside = rank[mine] - (ends[k] - total[k])
                sequence[mine] = first[k] + inside // each[k]
                at[mine] = offset[k] + inside % each[k] * s
            cols = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(at)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def place(pieces: DataFrame, capacity: int = CAPACITY, rows_per_rank_group: int = 256, groups_per_block: int = 4096) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32, salt) of 1 to ``capacity`` tokens.

    Pieces of a length are ranked in groups of about ``rows_per_rank_group`` by their ``salt``, a stored random number of each, so neither equal
    lengths nor equal rows nor null ids meet in one task. Groups are counted in blocks of ``groups_per_block``: of a length that 10^10 pieces have, one task sums
    10^4 blocks, and each block its groups. Ties of the salt go by doc_id, piece and CRC; rows equal in all of these are interchangeable. No pieces give no rows.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most capacity rows
    slots, _ = plan(counts, capacity)
    groups = spark.createDataFrame([(s, max(1, -(-n // rows_per_rank_group))) for s, n in counts.items()], "length long, groups long")
    pieces = pieces.join(F.broadcast(groups), "length").withColumn("grp", F.pmod("salt", "groups")).drop("groups")  # at most capacity rows
    # what stands before a group: sums over the blocks before its own, and within its block
    block = F.floor(F.col("grp") / groups_per_block).alias("block")
    size = pieces.groupBy("length", "grp").agg(F.count("*").alias("n")).select("length", block, "grp", "n")
    sums = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = size.groupBy("length", "block").agg(F.sum("n").alias("n")).select("length", "block", sums(Window.partitionBy("length").orderBy("block"), "n").alias("ahead"))
    inner = size.select("length", "block", "grp", sums(Window.partitionBy("length", "block").orderBy("grp"), "n").alias("inner"))
    base = inner.join(ahead, ["length", "block"]).select("length", "grp", (F.col("ahead") + F.col("inner")).alias("base"))
    within = Window.partitionBy("length", "grp").orderBy("salt", "doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(base, ["length", "grp"]).withColumn("rank", F.col("rank") + F.col("base"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_place(slots), kind)


def pack(docs: DataFrame, file: str, capacity: int = CAPACITY, plain: bool = False) -> DataFrame:
    """Tokenize whole texts (doc_id, text, any more columns), append the end id, and pack all into sequences of at most ``capacity`` ids.

    Texts of more ids are cut into pieces of ``capacity``, the remainder first. Returns a row for each piece: doc_id, piece,
    start, length, ids_crc32, sequence_id (dense from 0) and offset. Null and empty texts are one end id. Repeated rows are
    packed each on its own; a null doc_id stays null. An empty table gives no rows. ``plain``: strings of special tokens are ordinary text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"
    return place(staged(docs.mapInArrow(_pieces(file, capacity, plain), kind), "pieces"), capacity)
