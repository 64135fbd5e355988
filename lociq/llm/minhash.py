"""MinHash near-duplicate detection with sequential Bayesian verification of banded candidates."""

from __future__ import annotations

import functools

import numpy as np

from lociq.llm.common import TEXT_BLOCK, U64, WordHasher, ascii_lower, ascii_space, mix64, row_blocks

SHINGLE = 5
N_HASH, ROWS = 128, 4
N_BAND = N_HASH // ROWS
TEXT_ROWS = 1000  # rows of an Arrow batch that holds whole texts or full sets


@functools.cache
def hasher() -> WordHasher:
    return WordHasher(ascii_lower(), ascii_space())


def shingle_sets(buf: np.ndarray, offsets: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word-shingle hashes of each row, sorted within the row, and their offsets by row.

    A row of fewer than ``k`` words has its whole word sequence as one shingle; a row without words has none.
    """
    n = len(offsets) - 1
    row, _, _, word = hasher().words(buf, offsets)
    size = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    first = np.cumsum(size) - size
    weight = mix64(np.arange(1, k + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
    m = max(0, len(word) - k + 1)
    full = np.zeros(m, U64)
    for j in range(k):
        full += word[j : j + m] * weight[j]
    inside = row[:m] == row[k - 1 :] if m else np.zeros(0, bool)
    rows, hashes = [row[:m][inside]], [mix64(full[inside])]
    short = np.flatnonzero((size > 0) & (size < k))
    if len(short):
        total = np.zeros(len(short), U64)
        for j in range(k - 1):
            has = size[short] > j
            total[has] += word[first[short][has] + j] * weight[j]
        rows.append(short)
        hashes.append(mix64(total + size[short].astype(U64) * U64(0xD6E8FEB86659FD93)))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    row, h = row[keep], h[keep]
    return h, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int64)


@functools.cache
def permutations() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(20240229))
    return r.integers(0, 1 << 32, N_HASH, dtype=np.uint64).astype(np.uint32) | np.uint32(1), r.integers(0, 1 << 32, N_HASH, dtype=np.uint64).astype(np.uint32)


def signatures(h: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MinHash signature (N_HASH unsigned 32-bit values) of each row; rows without shingles get all ones."""
    n = len(offsets) - 1
    out = np.full((n, N_HASH), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        x, (a, b) = (h >> U64(32)).astype(np.uint32), permutations()
        at = offsets[full]
        for j in range(N_HASH):
            out[full, j] = np.minimum.reduceat(x * a[j] + b[j], at)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """N_BAND 64-bit keys of each signature."""
    parts = sig.reshape(len(sig), N_BAND, ROWS).astype(U64)
    h = np.broadcast_to(mix64(np.arange(1, N_BAND + 1, dtype=U64)), (len(sig), N_BAND)).copy()
    for j in range(ROWS):
        h = mix64(h * U64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return h


def least_matches(threshold: float, miss: float, step: int = 16) -> np.ndarray:
    """Of the first ``step``, 2 * ``step``, ... hashes, how many must agree so that the pair is not pruned.

    Under a uniform prior the similarity given m agreements of n is Beta(m + 1, n - m + 1); a pair goes once
    the posterior probability of reaching ``threshold`` falls below ``miss``.
    """
    x = (np.arange(20000) + 0.5) / 20000
    out = []
    for n in range(step, N_HASH + 1, step):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(x) + (n - m) * np.log1p(-x)
        p = np.exp(log - log.max(axis=1, keepdims=True))
        tail = p[:, x >= threshold].sum(axis=1) / p.sum(axis=1)
        out.append(int(np.flatnonzero(tail >= miss)[0]))
    return np.array(out)


def plausible(a: np.ndarray, b: np.ndarray, least: np.ndarray, step: int = 16) -> np.ndarray:
    """Which rows of two signature matrices survive the sequential test; later batches are read for survivors only."""
    alive, agree = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, most in enumerate(least):
        part = slice(k * step, (k + 1) * step)
        agree[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[agree[alive] >= most]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test on two sorted distinct hash sets: 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


# ---------------------------------------------------------------------------------------------- Spark side


def slots(ids: np.ndarray, bits: int) -> np.ndarray:
    """Place of each id in a bitmap of ``bits`` (a power of two) bits."""
    return (mix64(ids.astype(np.int64).view(U64)) & U64(bits - 1)).astype(np.int64)


def _sketch(sets: bool, bitmap: bytes | None = None):
    """mapInArrow function over (doc_id, text); a bitmap lets only ids through whose bit is set."""
    import pyarrow as pa

    from lociq.llm.common import utf8

    def run(batches):
        for batch in batches:
            if bitmap is not None:
                at = slots(batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False), 8 * len(bitmap))
                batch = batch.filter(pa.array((np.frombuffer(bitmap, np.uint8)[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            buf, off = utf8(batch.column("text"))
            for i, j in row_blocks(off, TEXT_BLOCK):
                h, o = shingle_sets(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                sig = signatures(h, o)
                cols = {"doc_id": batch.column("doc_id").slice(i, j - i)}
                if sets:
                    cols["sig"] = fixed(sig)
                    cols["members"] = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer((o * 8).astype(np.int32)), pa.py_buffer(h)])
                else:
                    cols["n_shingles"] = pa.array(np.diff(o))
                    total = [np.zeros(len(h) + 1, U64) for _ in range(2)]
                    np.cumsum(h, out=total[0][1:])
                    np.cumsum(mix64(h), out=total[1][1:])
                    cols |= {f"s{k + 1}": pa.array((t[o[1:]] - t[o[:-1]]).view(np.int64)) for k, t in enumerate(total)}
                    cols["sig"] = fixed(sig)
                    cols["text_hash"] = batch.column("text_hash").slice(i, j - i)
                yield pa.RecordBatch.from_pydict(cols)

    return run


def fixed(sig: np.ndarray):
    """A signature matrix as a binary column."""
    import pyarrow as pa

    n, width = len(sig), sig.shape[1] * sig.itemsize
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(sig))])


def matrix(column, dtype, width: int) -> np.ndarray:
    """A binary column of equal lengths as a matrix."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]] if len(column) else np.zeros(0, np.uint8)
    return data.view(dtype).reshape(len(column), width)


def _bands(batches):
    import pyarrow as pa

    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            keys = band_keys(matrix(part.column("sig"), np.uint32, N_HASH))
            ids = part.column("id").to_numpy()
            yield pa.RecordBatch.from_pydict({"key": pa.array(keys.ravel().view(np.int64)), "id": pa.array(np.repeat(ids, N_BAND))})


def _pruned(least):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            keep = plausible(matrix(batch.column("sig_a"), np.uint32, N_HASH), matrix(batch.column("sig_b"), np.uint32, N_HASH), least)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def _verified(percent):
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            a, b = batch.column("set_a"), batch.column("set_b")
            keep = [similar(np.frombuffer(a[i].as_buffer(), U64), np.frombuffer(b[i].as_buffer(), U64), percent) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _block(least, percent):
    """Pairs of two chunks of a large bucket, but those already of one component and those that meet in an earlier band (a bucket of a shingle has none); the links that join components."""
    import pandas as pd

    def run(key, pdf):
        pdf = pdf.drop_duplicates("id").reset_index(drop=True)
        root = {c: c for c in pdf["comp"]}

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        sig = np.stack([np.frombuffer(x, np.uint32) for x in pdf["sig"]])
        sets = [np.frombuffer(x, U64) for x in pdf["members"]]
        ids, comp, chunk = pdf["id"].to_numpy(), pdf["comp"].to_numpy(), pdf["chunk"].to_numpy()
        keys = band_keys(sig).view(np.int64)
        at = int((keys[0] == key[0]).argmax())  # the bucket's band
        out = []
        for i in range(len(ids)):
            js = np.arange(i + 1, len(ids))
            js = js[(comp[js] != comp[i]) & ((chunk[js] != chunk[i]) | (key[1] == key[2]))]
            js = js[~(keys[js, :at] == keys[i, :at]).any(axis=1)]
            if not len(js):
                continue
            for j in js[plausible(np.broadcast_to(sig[i], (len(js), N_HASH)), sig[js], least)]:
                a, b = find(comp[i]), find(comp[j])
                if a != b and similar(sets[i], sets[j], percent):
                    root[a] = b
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return run


def _shingles(batches):
    """mapInArrow function over (id, comp, members): a row for each shingle of a set, with the set's size and a hash that tells sets of one id apart."""
    import pyarrow as pa

    for batch in batches:
        column = batch.column("members")
        off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        ids, comp = batch.column("id").to_numpy(), batch.column("comp").to_numpy()
        for i, j in row_blocks(off, TEXT_BLOCK):
            h = np.frombuffer(column.buffers()[2], U64, (off[j] - off[i]) // 8, off[i])
            size = np.diff(off[i : j + 1]) // 8
            total = np.zeros(len(h) + 1, U64)
            np.cumsum(mix64(h), out=total[1:])
            ends = np.cumsum(size)
            kind = (total[ends] - total[ends - size]).view(np.int64)
            yield pa.RecordBatch.from_pydict({"key": pa.array(h.view(np.int64)), **{n: pa.array(np.repeat(v, size)) for n, v in (("id", ids[i:j]), ("comp", comp[i:j]), ("size", size), ("kind", kind))}})


def _marks(bits: int):
    """mapInArrow function over ids: each partition's set bytes of the bitmap."""
    import pyarrow as pa

    def run(batches):
        bitmap = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            at = slots(batch.column(0).to_numpy(), bits)
            np.bitwise_or.at(bitmap, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
        words = bitmap.view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_pydict({"at": pa.array(at), "word": pa.array(words[at])})

    return run


def _sets(docs, ids, at_most: int, most_bits: int, fill: float):
    """Signatures and full sets of (at least) the documents of ``ids``, of which there are ``at_most``.

    A bitmap made from all ids lets the scan drop the other texts without a shuffle. It has 8 bits an id, ``most_bits`` at most,
    which bounds what the driver and the tasks hold. Where more than ``fill`` of its bits are set it would let too many
    texts through, and the texts are joined with the ids instead.
    """
    from pyspark.sql import functions as F

    from lociq.llm.common import staged

    kind = "doc_id long, sig binary, members binary"
    bits = min(most_bits, 1 << max(16, (8 * at_most).bit_length()))
    marks = ids.mapInArrow(_marks(bits), "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).collect()  # bits / 64 rows at most
    bitmap = np.zeros(bits >> 6, np.int64)
    if marks:
        at, word = zip(*marks, strict=True)
        bitmap[list(at)] = word
    if np.unpackbits(bitmap.view(np.uint8)).mean() <= fill:
        return staged(docs.where("doc_id is not null").mapInArrow(_sketch(True, bitmap.tobytes()), kind), "sets", batch_rows=TEXT_ROWS)
    return staged(docs.join(ids, "doc_id", "left_semi").mapInArrow(_sketch(True), kind), "sets", batch_rows=TEXT_ROWS)


def near_duplicates(docs, percent: int = 75, miss: float = 1e-6, all_pairs_up_to: int = 32, chunk: int = 256, chunk_bytes: int = 8 << 20, most_bits: int = 1 << 26, fill: float = 0.2, copies: int = 64):
    """Near-duplicate classes of ``docs`` (doc_id, text, any more columns): Jaccard of 5-word shingle sets >= percent / 100.

    Returns doc_id, n_shingles, component_id, kept, text_hash (xxhash64 of the text). MinHash signatures of 128 hashes are cut into 32 bands of 4 (a pair
    at the threshold misses all bands with probability 5e-6). Documents of equal shingle sets fold into one first.
    Within each band bucket every member is compared with the bucket's smallest one; buckets whose members still
    fall into several components then compare members across components: pair by pair where the bucket is small, and in blocks
    of two chunks of about ``chunk`` documents or ``chunk_bytes`` of sets where it is large, so no bucket is ever emitted as all its pairs.
    Where a bucket would repeat its documents more than ``copies`` times for its blocks, as one of many unrelated documents would, its documents are joined by their rarest
    shingles instead (prefix filter): two sets at the threshold share one of the first n - ceil(n * percent / 100) + 1 in order of rarity.
    Candidates pass the sequential Bayesian test (``miss``: posterior probability below which a pair is pruned), and the
    survivors are confirmed on full sets.
    Nulls, empty texts and texts without words have n_shingles 0 and stay alone. doc_id names a document:
    repeated rows come back each, with one component; rows of one doc_id with different texts each have their own component.
    An empty table gives no rows. A null doc_id is left out of linking and returned with a null component.
    """
    from pyspark.sql import functions as F

    from lociq.llm.common import components, release, staged

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    least = least_matches(percent / 100, miss)
    kind = "doc_id long, n_shingles long, s1 long, s2 long, sig binary, text_hash long"
    sketch = staged(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_sketch(False), kind), "sketch", batch_rows=TEXT_ROWS)
    real = sketch.where("n_shingles > 0 and doc_id is not null")
    rep = real.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    reps = real.select("doc_id", "s1", "s2", "sig").join(rep, (real.doc_id == rep.rep) & (real.s1 == rep.s1) & (real.s2 == rep.s2), "left_semi")
    band = staged(reps.select(F.col("doc_id").alias("id"), "sig").mapInArrow(_bands, "key long, id long"), "bands")
    buckets = band.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low")).where("n > 1")
    member = staged(band.join(buckets, "key"), "members")
    release(band)
    star = member.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct()
    star = staged(star, "star")
    ids = star.select(F.col("a").alias("doc_id")).union(star.select(F.col("b").alias("doc_id"))).distinct()
    # in a bucket every member stands in a star pair, so these are all documents that any comparison reads
    need = _sets(docs, ids, 2 * star.count(), most_bits, fill)

    def confirmed(pairs):
        a = need.select(F.col("doc_id").alias("a"), F.col("sig").alias("sig_a"))
        b = need.select(F.col("doc_id").alias("b"), F.col("sig").alias("sig_b"))
        left = pairs.join(b, "b").join(a, "a").select("a", "b", "sig_a", "sig_b").mapInArrow(_pruned(least), "a long, b long")
        left = staged(left, "pruned")  # so that no stage holds two Python workers a core
        a = need.select(F.col("doc_id").alias("a"), F.col("members").alias("set_a"))
        b = need.select(F.col("doc_id").alias("b"), F.col("members").alias("set_b"))
        out = staged(left.join(b, "b").join(a, "a").select("a", "b", "set_a", "set_b").mapInArrow(_verified(percent), "a long, b long"), "links", batch_rows=TEXT_ROWS)
        release(left)
        return out

    links = confirmed(star)
    comp = components(links)
    labelled = staged(member.select("key", "id", "n").join(comp, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("comp")), "labelled")
    open_ = labelled.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("key")
    open_ = staged(labelled.join(open_, "key", "left_semi"), "open")
    release(member)
    release(labelled)
    made = [star, need, open_]

    def by_pairs(buckets):
        small = buckets.where(F.col("n") <= all_pairs_up_to)
        other = small.select("key", F.col("id").alias("b"), F.col("comp").alias("comp_b"))
        pairs = small.select("key", F.col("id").alias("a"), F.col("comp").alias("comp_a")).join(other, "key").where("a < b and comp_a <> comp_b").select("a", "b").distinct()
        return confirmed(pairs.join(star, ["a", "b"], "left_anti"))

    def by_blocks(chunks):
        return staged(_blocks(chunks, need, _block(least, percent)), "links")

    found = links.union(by_pairs(open_))
    large = open_.where(F.col("n") > all_pairs_up_to)
    if not large.isEmpty():
        chunks = staged(_chunks(large, need, chunk, chunk_bytes), "chunks")
        dense = staged(_dense(chunks, copies), "dense")
        found = found.union(by_blocks(chunks.join(dense, "key", "left_anti")))
        made += [chunks, dense]
        if not dense.isEmpty():
            rare = staged(_rarest(chunks.join(dense, "key", "left_semi"), need, percent), "rarest")
            found = found.union(by_pairs(rare)).union(by_blocks(_chunks(rare.where(F.col("n") > all_pairs_up_to), need, chunk, chunk_bytes)))
            made.append(rare)
    comp = components(found)
    for done in made:
        release(done)
    rep_of = rep.join(comp, rep.rep == comp.id, "left").select("s1", "s2", F.coalesce("component", "rep").alias("component"))
    out = sketch.join(rep_of, (sketch.s1 == rep_of.s1) & (sketch.s2 == rep_of.s2) & (sketch.n_shingles > 0), "left")
    component = F.when(sketch.doc_id.isNotNull(), F.coalesce(rep_of.component, sketch.doc_id))
    return out.select(sketch.doc_id, sketch.n_shingles, component.alias("component_id"), component.eqNullSafe(sketch.doc_id).alias("kept"), "text_hash")


def _chunks(large, need, chunk, chunk_bytes):
    """Large buckets (key, id, comp) cut into chunks of about ``chunk`` documents or ``chunk_bytes`` of sets: key, part, comp, id, chunk."""
    from pyspark.sql import functions as F

    bytes_ = need.select(F.col("doc_id").alias("id"), F.octet_length("members").alias("bytes"))
    parts = lambda by: F.greatest(F.ceil(F.col(f"{by}_n") / chunk), F.ceil(F.col(f"{by}_bytes") / chunk_bytes))
    sums = lambda by: (F.count("*").alias(f"{by}_n"), F.sum("bytes").alias(f"{by}_bytes"))
    docs = large.select("key", "id", "comp").join(bytes_, "id")
    docs = docs.join(docs.groupBy("key", "comp").agg(*sums("own")), ["key", "comp"])
    docs = docs.withColumn("part", F.when(parts("own") > 1, F.col("comp")).otherwise(F.lit(-1)))  # a component that fills chunks has them to itself
    docs = docs.join(docs.groupBy("key", "part").agg(*sums("part")), ["key", "part"])
    return docs.select("key", "part", "comp", "id", F.concat_ws("/", "part", F.pmod(F.xxhash64("id"), parts("part"))).alias("chunk"))


def _dense(chunks, copies: int):
    """Keys of buckets whose blocks of two chunks repeat a document more than ``copies`` times on average."""
    from pyspark.sql import functions as F

    size = chunks.select("key", "part", "chunk").distinct().groupBy("key", "part").agg(F.count("*").alias("m"))
    apart = F.when(F.col("part") == -1, 0).otherwise(F.col("m") * F.col("m"))
    return size.groupBy("key").agg(F.sum("m").alias("n"), F.sum(apart).alias("apart")).where(F.expr(f"n * n - apart > {copies} * n")).select("key")


def _rarest(rows, need, percent: int):
    """Buckets (key, id, comp, n) by shingle: each document of ``rows`` stands in those of its rarest shingles; buckets of one component are left out.

    Shingles of one document come first in the order of rarity and need no bucket, so only shared ones are ranked.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from lociq.llm.common import staged

    sets = rows.select("id", "comp").distinct().join(need.select(F.col("doc_id").alias("id"), "members"), "id")
    shingle = staged(sets.select("id", "comp", "members").mapInArrow(_shingles, "key long, id long, comp long, size long, kind long"), "shingles", batch_rows=TEXT_ROWS)
    shared = shingle.groupBy("key").agg(F.count("*").alias("docs")).where("docs > 1")
    own = Window.partitionBy("id", "kind")
    place = F.row_number().over(own.orderBy("docs", "key")) + F.col("size") - F.count("*").over(own)
    first = shingle.join(shared, "key").withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * percent / 100) + 1)
    first = staged(first.select("key", "id", "comp").distinct(), "first")
    several = first.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("key", "n")
    return first.join(several, "key").select("key", "id", "comp", "n")


def _blocks(docs, need, block):
    """Links across components within chunked buckets, by blocks of two chunks of one bucket; a pair of several bands' buckets is compared in its first."""
    from pyspark.sql import functions as F

    chunks = docs.select("key", "part", "chunk").distinct()
    other = chunks.select("key", F.col("part").alias("part_b"), F.col("chunk").alias("chunk_b"))
    pairs = chunks.join(other, "key").where("chunk <= chunk_b and (part <> part_b or part = -1)").select("key", F.col("chunk").alias("c1"), F.col("chunk_b").alias("c2"))
    ends = pairs.select("key", "c1", "c2", F.explode(F.array_distinct(F.array("c1", "c2"))).alias("chunk"))
    rows = ends.join(docs, ["key", "chunk"]).join(need.withColumnRenamed("doc_id", "id"), "id").select("key", "c1", "c2", "chunk", "id", "comp", "sig", "members")
    return rows.groupBy("key", "c1", "c2").applyInPandas(block, "a long, b long")
