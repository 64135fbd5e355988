"""Exact repeated-substring removal by a sparse suffix array: sorted, front-coded suffix runs merged by LCP loser trees.

A window is any ``length`` consecutive bytes of one document. Within each window the smallest hash over its ``GRAM``-byte
substrings picks one position, its anchor: equal windows have their anchor at the same place. Suffixes are sorted at anchors
only (about one byte in 80), and an anchor stands for a contiguous range of windows, given by the bytes ``d`` that they reach to its
left. Two such windows are equal if the suffixes at their anchors share ``length - d`` bytes and the reversed prefixes
before them share ``d`` bytes; both come from the order of the sorted strings and the common prefixes of neighbours.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import U64, mix64, row_blocks, shuffle_partitions, staged, utf8

GRAM = 40
BASE = 0x5851F42D4C957F2D
BLOCK = 1 << 18
RUN_BYTES = 24 << 20
HOT = 50_000
HOT_BIT = 1 << 62
WINDOW = np.dtype([("hi", "<u8"), ("lo", "<u8"), ("weight", "<i8"), ("own", "<i8"), ("uid", "<i8"), ("begin", "<i8")])


def gram_hashes(buf: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` bytes from each position, by doubling of polynomial hashes."""
    power = (buf.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15)
    out, length, size = None, 0, 1
    while True:
        if k & 1:
            if out is None:
                out, length = power, size
            else:
                m = len(buf) - length - size + 1
                out, length = out[:m] * U64(pow(BASE, size, 1 << 64)) + power[length : length + m], length + size
        k >>= 1
        if not k:
            return mix64(out)
        m = len(power) - size
        power, size = power[:m] * U64(pow(BASE, size, 1 << 64)) + power[size : size + m], size * 2


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` consecutive values."""
    size, cur = 1, x
    while size * 2 <= w:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    rest = w - size
    return np.minimum(cur[: len(cur) - rest], cur[rest:]) if rest else cur


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of each anchor: row, hash of its gram, position in the row, least and largest left reach ``d`` of its windows.

    Long rows are cut into overlapping segments; an anchor met in two segments comes twice, with separate ranges.
    """
    parts = []
    for i, j in row_blocks(offsets, BLOCK):
        lo, hi = int(offsets[i]), int(offsets[j])
        for at in range(lo, max(lo + 1, hi - length + 1), BLOCK * 2):
            end = min(hi, at + BLOCK * 2 + length - 1)
            if end - at < length:
                continue
            h = gram_hashes(buf[at:end], GRAM)
            packed = (h & ~U64(0xFFFFFF)) | np.arange(len(h), dtype=U64)
            pick = (sliding_min(packed, length - GRAM + 1) & U64(0xFFFFFF)).astype(np.int64)
            p = np.arange(len(pick))
            row = np.searchsorted(offsets, p + at, side="right") - 1
            ok = p + at + length <= offsets[row + 1]
            p, row, pick = p[ok], row[ok], pick[ok]
            if not len(p):
                continue
            new = np.ones(len(p), bool)
            new[1:] = (pick[1:] != pick[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(p)) - 1
            a, r = pick[first], row[first]
            parts.append((r, h[a], a + at - offsets[r], a - p[last], a - p[first]))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, U64), none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are known and not compared again."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8 if x else n


def front_code(strings: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Common prefix with the string before, and the concatenated rests."""
    lcp, rest, last = np.zeros(len(strings), np.int32), [], b""
    for i, s in enumerate(strings):
        lcp[i] = n = common(last, s, 0)
        rest.append(s[n:])
        last = s
    return lcp, b"".join(rest)


def front_decode(lcp: np.ndarray, size: np.ndarray, rest: bytes) -> list[bytes]:
    out, last, at = [], b"", 0
    for n, m in zip(lcp.tolist(), size.tolist(), strict=True):
        last = last[:n] + rest[at : at + m - n]
        at += m - n
        out.append(last)
    return out


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[int], list[int], list[int]]:
    """Merge sorted runs (strings, common prefixes with the string before): run and index of each output, and its common prefix with the output before.

    A loser tree in which each contender carries its common prefix with the last output. Of two contenders the one with the
    longer prefix is smaller, without any comparison; at equal prefixes the comparison starts behind them.
    """
    k = max(1, len(runs))
    width = 1 << (k - 1).bit_length()
    key = [r[0][0] if r[0] else None for r in runs] + [None] * (width - len(runs))
    pre = [0 if x is not None else -1 for x in key]
    at = [0] * width
    tree = [0] * width

    def beats(i: int, j: int) -> bool:
        """Whether i comes before j; sets the loser's prefix to that with the winner."""
        if pre[i] != pre[j]:
            return pre[i] > pre[j]
        if pre[i] < 0:
            return i < j
        a, b, n = key[i], key[j], pre[i]
        m = common(a, b, n)
        first = m == len(a) and (m < len(b) or i < j) or (m < len(a) and m < len(b) and a[m] < b[m])
        pre[j if first else i] = m
        return first

    def build(node: int) -> int:
        if node >= width:
            return node - width
        a, b = build(2 * node), build(2 * node + 1)
        if beats(a, b):
            tree[node] = b
            return a
        tree[node] = a
        return b

    top = build(1)
    run, index, lcp = [], [], []
    while key[top] is not None:
        run.append(top)
        index.append(at[top])
        lcp.append(pre[top])
        at[top] += 1
        strings, prefixes = runs[top]
        if at[top] < len(strings):
            key[top], pre[top] = strings[at[top]], prefixes[at[top]]
        else:
            key[top], pre[top] = None, -1
        node = (top + width) >> 1
        while node:
            if beats(tree[node], top):
                tree[node], top = top, tree[node]
            node >>= 1
    return run, index, lcp


def classes(order: np.ndarray, lcp: np.ndarray, depth: int) -> np.ndarray:
    """Class of each string by its first ``depth`` bytes, from sorted order and common prefixes of neighbours."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(lcp < depth)
    return out


def repeated(order, lcp, left: list[bytes], low: np.ndarray, high: np.ndarray, weight: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest ``d`` (-1: none) of each record's windows that occur in another record, or in one of weight 2.

    order, lcp: of the suffixes; left: the reversed bytes before the anchors; low, high: range of d.
    """
    n = len(left)
    least, most = np.full(n, -1), np.full(n, -1)
    by_left = np.array(sorted(range(n), key=left.__getitem__), np.int64)
    shared = np.zeros(n, np.int64)
    for i in range(1, n):
        shared[i] = common(left[by_left[i - 1]], left[by_left[i]], 0)
    for d in range(int(low.min()), int(high.max()) + 1) if n else ():
        has = np.flatnonzero((low <= d) & (high >= d))
        if not len(has):
            continue
        pair = classes(order, lcp, length - d)[has] * (n + 1) + classes(by_left, shared, d)[has]
        _, inverse = np.unique(pair, return_inverse=True)
        twice = has[np.bincount(inverse, weights=weight[has])[inverse] > 1]
        most[twice] = d
        least[twice[least[twice] < 0]] = d
    return least, most


# ---------------------------------------------------------------------------------------------- Spark side


def _anchor_rows(length: int):
    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            row, h, a, low, high = anchors(buf, off, length)
            own, uid = batch.column("own").to_numpy(), batch.column("uid").to_numpy()
            yield pa.RecordBatch.from_pydict({"gram": pa.array(h.view(np.int64)), "own": pa.array(own[row]), "uid": pa.array(uid[row]), "place": pa.array((a << 16) | (low << 8) | high)})

    return run


def _pack(part: int, records: list[tuple]) -> bytes:
    """One run: front-coded suffixes, with reversed left contexts, ranges, weights, ids and positions."""
    strings = [r[0] for r in records]
    lcp, rest = front_code(strings)
    left = [r[1] for r in records]
    arrays = [lcp, np.array([len(s) for s in strings], np.int32), np.array([len(s) for s in left], np.int32)]
    arrays += [np.array([r[k] for r in records], np.int32) for k in (2, 3, 4)] + [np.array([r[k] for r in records], np.int64) for k in (5, 6, 7)]
    head = np.array([len(records), len(rest)], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head.tobytes(), *(x.tobytes() for x in arrays), rest, b"".join(left)]))


def _unpack(block: bytes):
    raw = zstandard.ZstdDecompressor().decompress(block)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    at, arrays = 16, []
    for dtype in (np.int32,) * 6 + (np.int64,) * 3:
        arrays.append(np.frombuffer(raw, dtype, n, at))
        at += arrays[-1].nbytes
    lcp, size, left_size, low, high, weight, own, uid, a = arrays
    strings = front_decode(lcp, size, raw[at : at + m])
    ends = np.cumsum(left_size) + at + m
    left = [raw[e - s : e] for s, e in zip(left_size.tolist(), ends.tolist(), strict=True)]
    return strings, lcp.tolist(), left, low, high, weight, own, uid, a


def fold(records: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Fold equal records into one nameless witness of weight 2: records that go on, and those folded."""
    records.sort()
    out, folded, i = [], [], 0
    while i < len(records):
        j = i + 1
        while j < len(records) and records[j][:4] == records[i][:4]:
            j += 1
        if j - i == 1:
            out.append((*records[i][:4], 1, *records[i][4:]))
        else:
            out.append((*records[i][:4], 2, 0, 0, -1))
            folded += records[i:j]
        i = j
    return out, folded


def window_rows(records: list[tuple], length: int) -> np.ndarray:
    """One row for each window of folded records, told apart by 128 bits of BLAKE2; a witness has no place (-1)."""
    digests, counts = [], []
    for right, left, low, high, *_ in records:
        text = left[::-1] + right
        digests += [hashlib.blake2b(text[i : i + length], digest_size=16).digest() for i in range(high - low + 1)]
        counts.append(high - low + 1)
    counts = np.array(counts, np.int64)
    rows = np.zeros(int(counts.sum()), WINDOW)
    rows["hi"], rows["lo"] = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2).T
    inner = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    high, weight, own, uid, a = (np.repeat(np.array([r[k] for r in records], np.int64), counts) for k in (3, 4, 5, 6, 7))
    rows["weight"], rows["own"], rows["uid"] = weight, own, uid
    rows["begin"] = np.where(a < 0, -1, a - high + inner)
    return rows


def fold_windows(rows: np.ndarray, length: int) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """Distinct windows, a repeated one as a witness, and the stretches (own, uid, begin, end) that repeated ones cover."""
    if not len(rows):
        return rows, (np.zeros(0, np.int64),) * 4
    rows = rows[np.lexsort((rows["lo"], rows["hi"]))]
    new = np.append(True, (rows["hi"][1:] != rows["hi"][:-1]) | (rows["lo"][1:] != rows["lo"][:-1]))
    at = np.flatnonzero(new)
    repeats = np.add.reduceat(rows["weight"], at) > 1
    found = rows[repeats[np.cumsum(new) - 1] & (rows["begin"] >= 0)]
    rest = rows[at]
    rest["weight"][repeats], rest["begin"][repeats], rest["own"][repeats], rest["uid"][repeats] = 2, -1, 0, 0
    found = found[np.lexsort((found["begin"], found["uid"], found["own"]))]
    own, uid, begin = found["own"], found["uid"], found["begin"]
    edge = np.append(True, (own[1:] != own[:-1]) | (uid[1:] != uid[:-1]) | (begin[1:] > begin[:-1] + length))[: len(found)]
    first = np.flatnonzero(edge)
    last = np.append(first[1:], len(found))[: len(first)] - 1
    return rest, (own[first], uid[first], begin[first], begin[last] + length)


def _runs(length: int, parts: int):
    """Sorted runs of the candidate suffixes by part; what repeats within the run is settled here and goes on once, as a nameless witness.

    Of hot grams, whose suffixes could outgrow a part, single windows go on, parted by their digests.
    """

    def flush(kept, hot):
        by_part: dict[int, list] = {}
        for r in kept:
            by_part.setdefault(r[0], []).append(r[1:])
        for part, records in by_part.items():
            out, folded = fold(records)
            yield found(part, folded) | {"run": _pack(part, out)}
        if hot:
            out, folded = fold(hot)
            yield found(0, folded)
            rest, (o, u, s, e) = fold_windows(window_rows(out, length), length)
            yield {"part": 0, "own": o, "uid": u, "begin": s, "end": e}
            rest = rest[np.argsort(rest["lo"] % U64(parts), kind="stable")]
            cuts = np.searchsorted(rest["lo"] % U64(parts), np.arange(parts + 1, dtype=U64))
            for part in np.flatnonzero(np.diff(cuts)).tolist():
                block = rest[cuts[part] : cuts[part + 1]].tobytes()
                yield found(part, []) | {"windows": zstandard.ZstdCompressor(level=3).compress(block)}

    def found(part, folded):
        settled = [(r[4], r[5], r[6] - r[3], r[6] - r[2] + length) for r in folded]
        o, u, s, e = (np.array(x, np.int64) for x in zip(*settled, strict=True)) if settled else (np.zeros(0, np.int64),) * 4
        return {"part": part, "own": o, "uid": u, "begin": s, "end": e}

    def run(batches):
        kept, hot, size = [], [], 0
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            raw, own, uid = buf.tobytes(), batch.column("own").to_pylist(), batch.column("uid").to_pylist()
            for i, places in enumerate(batch.column("places").to_pylist()):
                for place in sorted(set(places)):
                    a, low, high = (place & ~HOT_BIT) >> 16, (place >> 8) & 255, place & 255
                    at = int(off[i]) + a
                    right, left = raw[at : at + length - low], raw[at - high : at][::-1]
                    if place & HOT_BIT:
                        hot.append((right, left, low, high, own[i], uid[i], a))
                    else:
                        # the part comes from the gram alone, so that all suffixes that may match meet
                        part = int.from_bytes(hashlib.blake2b(right[:GRAM], digest_size=8).digest(), "little") % parts
                        kept.append((part, right, left, low, high, own[i], uid[i], a))
                    size += len(right) + len(left) + 200
                if size > RUN_BYTES:
                    yield from batches_of(flush(kept, hot))
                    kept, hot, size = [], [], 0
        if kept or hot:
            yield from batches_of(flush(kept, hot))

    return run


def batches_of(rows):
    kind = pa.schema([("part", pa.int64()), ("run", pa.binary()), ("windows", pa.binary()), ("own", pa.list_(pa.int64())), ("uid", pa.list_(pa.int64())), ("begin", pa.list_(pa.int64())), ("end", pa.list_(pa.int64()))])
    held = []
    for row in rows:
        held.append(row)
        if len(held) == 64:
            yield pa.RecordBatch.from_pylist(held, kind)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, kind)


def _merge(length: int):
    """Merge the runs of each part, which come together, and give the repeated stretch of each record or window."""

    def repeats(runs: list[bytes], windows: list[bytes]):
        if windows:
            rows = np.concatenate([np.frombuffer(zstandard.ZstdDecompressor().decompress(x), WINDOW) for x in windows])
            yield stretch(*fold_windows(rows, length)[1])
        if not runs:
            return
        blocks = [_unpack(b) for b in runs]
        which, index, lcp = merge_runs([(b[0], b[1]) for b in blocks])
        which, index = np.array(which, np.int64), np.array(index, np.int64)
        base = np.cumsum([0] + [len(b[0]) for b in blocks])
        left = [x for b in blocks for x in b[2]]
        low, high, weight, own, uid, a = (np.concatenate([b[k] for b in blocks]).astype(np.int64) for k in range(3, 9))
        least, most = repeated(base[which] + index, np.array(lcp), left, low, high, weight, length)
        ok = np.flatnonzero((most >= 0) & (a >= 0))
        if len(ok):
            yield stretch(own[ok], uid[ok], a[ok] - most[ok], a[ok] - least[ok] + length)

    def run(batches):
        part, runs, windows = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["uid"]:
                    yield stretch(row["own"], row["uid"], row["begin"], row["end"])
                if row["part"] != part:
                    yield from repeats(runs, windows)
                    runs, windows = [], []
                part = row["part"]
                if row["run"]:
                    runs.append(row["run"])
                if row["windows"]:
                    windows.append(row["windows"])
        yield from repeats(runs, windows)

    return run


def stretch(own, uid, begin, end):
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in (("own", own), ("uid", uid), ("begin", begin), ("end", end))})


def _cut(texts: bool):
    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            out = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans") + (("kept_text",) if texts else ())}
            lists = batch.column("stretches")
            for i in range(batch.num_rows):
                raw = buf[off[i] : off[i + 1]].tobytes()
                spans: list[list[int]] = []
                for x in sorted((x["begin"], x["end"]) for x in lists[i].as_py() or ()):
                    if spans and x[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x[1])
                    else:
                        spans.append(list(x))
                keep, at = [], 0
                for s, e in spans:
                    keep.append(raw[at:s])
                    at = e
                rest = b"".join([*keep, raw[at:]])
                row = (len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), spans, rest)
                for k, v in zip(out, row, strict=False):
                    out[k].append(v)
            cols = {"doc_id": batch.column("doc_id")} | {k: pa.array(out[k], pa.int64()) for k in ("n_bytes", "n_removed", "n_spans")}
            cols |= {"kept_sha256": pa.array(out["kept_sha256"], pa.string()), "spans": pa.array(out["spans"], pa.list_(pa.list_(pa.int64())))}
            if texts:
                cols["kept_text"] = pa.array(out["kept_text"], pa.binary())
            yield pa.RecordBatch.from_pydict(cols)

    return run


def remove_repeats(docs: DataFrame, length: int = 200, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """Remove each byte of ``docs`` (doc_id, text, any more columns) covered by a ``length``-byte string that also starts elsewhere.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed [begin, end) byte runs) and, if asked for,
    kept_text (binary: a cut may fall inside a character). One row for each input row. Null and empty texts have nothing to remove.
    Rows are told apart by doc_id and a 64-bit hash of doc_id and text (two hashes where doc_id is null): repeated rows are documents of their own whose
    texts repeat each other, and rows of one doc_id with different texts don't mix. An empty table gives no rows.

    Grams of anchors are counted with partial aggregation; only anchors whose gram occurs twice are extracted. Each task
    sorts its candidates into one run for each part, folding what is equal within the run, so that a passage that a third of the
    documents share reaches its part once a task and distinct context. ``length`` may be 50 to 250.
    """
    if not GRAM + 10 <= length <= 250:
        raise ValueError("length must lie between 50 and 250")
    parts = 4 * shuffle_partitions(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.select(F.coalesce("doc_id", F.xxhash64(F.lit(1), "text")).alias("own"), F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "text")
    found = docs.select("own", "uid", "text").mapInArrow(_anchor_rows(length), "gram long, own long, uid long, place long")
    # written first, so that the join has an exchange on either side, of which a frequent gram's is split at run time
    twice = staged(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram", (F.col("n") > hot).alias("hot")), "grams")
    place = F.when(F.col("hot"), F.col("place").bitwiseOR(F.lit(HOT_BIT))).otherwise(F.col("place"))
    places = found.join(twice, "gram").withColumn("place", place).groupBy("own", "uid").agg(F.collect_list("place").alias("places"))
    # all columns of docs, so that this join and the last one share one exchange of the texts
    runs = docs.join(places, ["own", "uid"]).mapInArrow(_runs(length, parts), "part long, run binary, windows binary, own array<long>, uid array<long>, begin array<long>, end array<long>")
    hits = runs.repartition(shuffle_partitions(docs.sparkSession), "part").sortWithinPartitions("part").mapInArrow(_merge(length), "own long, uid long, begin long, end long")
    hits = hits.groupBy("own", "uid").agg(F.collect_list(F.struct("begin", "end")).alias("stretches"))
    out = docs.join(hits, ["own", "uid"], "left").select("doc_id", "text", "stretches")
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return out.mapInArrow(_cut(with_text), kind + ", kept_text binary" * with_text)
