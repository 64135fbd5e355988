"""Token-id output: per-document zstandard frames under one shared dictionary, in shards with an offset index.

A shard is one byte string: MAGIC, dictionary hash (32 bytes), number of documents (u64), then by document doc_id (i64),
frame offset (u64), frame length (u32) and number of ids (u32), then the frames. All numbers are little-endian; a null doc_id is NO_ID. A frame holds
a document's ids as unsigned 32-bit values. A shard ends at ``shard_bytes`` of frames, or after the one document that is longer. Shards are rows of a table
in the shared folder, so that Spark's commit protocol keeps each exactly once when tasks are retried; each row tells its least and largest doc_id, by
which Parquet's statistics lead to a document.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm import tokens
from lociq.llm.common import fitting, staged

MAGIC = b"LQTOKEN1"
SHARD_BYTES = 4 << 20
NO_ID = -(1 << 63)  # stands for a null doc_id in an index, where it comes first
ENTRY = np.dtype([("doc_id", "<i8"), ("at", "<u8"), ("size", "<u4"), ("n", "<u4")])

SHARD = pa.schema([(k, pa.int64()) for k in ("part", "seq", "begin", "first_id", "last_id", "n_docs", "n_ids")] + [("content", pa.binary())])
SHARD_DDL = "part long, seq long, begin long, first_id long, last_id long, n_docs long, n_ids long, content binary"


def build(dictionary: bytes, rows: list[tuple[int, int, bytes]]) -> bytes:
    """A shard of (doc_id, number of ids, frame)."""
    index = np.zeros(len(rows), ENTRY)
    index["doc_id"], index["n"] = [r[0] for r in rows], [r[1] for r in rows]
    index["size"] = [len(r[2]) for r in rows]
    index["at"] = np.cumsum(index["size"], dtype=np.uint64) - index["size"]
    return b"".join([MAGIC, hashlib.sha256(dictionary).digest(), len(rows).to_bytes(8, "little"), index.tobytes(), *(r[2] for r in rows)])


class Shard:
    """Random access to the documents of a shard."""

    def __init__(self, content: bytes, dictionary: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token shard")
        if content[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("the shard was written with another dictionary")
        n = int.from_bytes(content[40:48], "little")
        self.index = np.frombuffer(content, ENTRY, n, 48)
        self.frames = memoryview(content)[48 + n * ENTRY.itemsize :]
        self.decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()

    def ids(self, k: int) -> np.ndarray:
        """Ids of the k-th document, without touching the others."""
        e = self.index[k]
        at, size = int(e["at"]), int(e["size"])
        return np.frombuffer(self.decoder.decompress(self.frames[at : at + size]), "<u4")

    def find(self, doc_id: int) -> np.ndarray:
        """Ids of the first document of that doc_id."""
        k = int(np.searchsorted(self.index["doc_id"], doc_id))
        if k == len(self.index) or self.index["doc_id"][k] != doc_id:
            raise KeyError(doc_id)
        return self.ids(k)


def train(samples: list[bytes], size: int) -> bytes:
    """A dictionary of about ``size`` bytes; empty where the samples are too few to train one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _ids(file: str, plain: bool):
    def run(batches):
        encode = tokens.encoder(file, plain).ids
        for batch in tokens.small(batches):
            yield pa.RecordBatch.from_pydict({"h": batch.column("h"), "ids": pa.array([tokens.with_end(encode(t or "")).tobytes() for t in batch.column("text").to_pylist()], pa.binary())})

    return run


def dictionary_of(docs: DataFrame, file: str, size: int, sample_docs: int, sample_bytes: int, plain: bool) -> bytes:
    """Train on whole documents: of the ``sample_docs`` of smallest hash of doc_id, in this order, those that fit into ``sample_bytes`` of text together; ids that are null serve none."""
    docs = docs.where("doc_id is not null")
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.join(F.broadcast(chosen), "doc_id").select("text", F.xxhash64("doc_id", "text").alias("h"), F.octet_length("text").alias("size"))  # at most sample_docs ids
    sizes = texts.select("h", "size").distinct().orderBy("h").limit(sample_docs).collect()
    fit = fitting([(r["h"], r["size"] or 0) for r in sizes], sample_bytes)
    rows = texts.where(F.col("h").isin(fit)).select("h", "text").dropDuplicates(["h"]).mapInArrow(_ids(file, plain), "h long, ids binary").collect() if fit else []
    return train([bytes(r["ids"]) for r in sorted(rows, key=lambda r: r["h"])], size)


def _shards(file: str, dictionary: bytes, plain: bool, shard_bytes: int):
    """Shards of a partition's documents, which come in order."""

    def run(batches):
        encode = tokens.encoder(file, plain).ids
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        part, seq, begin, size, rows = TaskContext.get().partitionId(), 0, 0, 0, []

        def flush():
            n = sum(r[1] for r in rows)
            row = {"part": part, "seq": seq, "begin": begin, "first_id": rows[0][0], "last_id": rows[-1][0], "n_docs": len(rows), "n_ids": n, "content": build(dictionary, rows)}
            return n, pa.RecordBatch.from_pylist([row], SHARD)

        for batch in tokens.small(batches):
            for doc_id, text in zip(batch.column("doc_id").fill_null(NO_ID).to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = tokens.with_end(encode(text or ""))
                rows.append((doc_id, len(ids), press.compress(ids.tobytes())))
                size += len(rows[-1][2]) + ENTRY.itemsize
                if size >= shard_bytes:
                    n, out = flush()
                    yield out
                    begin, seq, size, rows = begin + n, seq + 1, 0, []
        if rows:
            yield flush()[1]

    return run


def _read(dictionary: bytes, starts: np.ndarray):
    def run(batches):
        for batch in tokens.small(batches, 1):
            for part, begin, content in zip(batch.column("part").to_pylist(), batch.column("begin").to_pylist(), batch.column("content"), strict=True):
                shard = Shard(content.as_py(), dictionary)
                n = shard.index["n"].astype(np.int64)
                crc = [zlib.crc32(shard.ids(k).tobytes()) for k in range(len(n))]
                start = starts[part] + begin + np.cumsum(n) - n
                yield pa.RecordBatch.from_arrays([pa.array(shard.index["doc_id"].astype(np.int64), mask=shard.index["doc_id"] == NO_ID), pa.array(start), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write_tokens(docs: DataFrame, file: str, dictionary_bytes: int = 65536, sample_docs: int = 1000, sample_bytes: int = 16 << 20, plain: bool = False, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, bytes]:
    """Encode whole texts (doc_id, text, any more columns) and write shards in ascending doc_id order; the shard table and the dictionary.

    The dictionary is trained on at most ``sample_docs`` whole documents of at most ``sample_bytes`` of text together (see ``dictionary_of``); all documents
    are written. Documents are dealt by ranges of doc_id, then of the hash of the text and of a row number, so that even an id with a third of
    all rows spreads over many tasks. Null and empty texts are one end id. Rows of a null doc_id come first.
    Repeated rows stay, next to each other. An empty table gives no shards. ``plain``: strings of special tokens are ordinary text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dictionary = dictionary_of(docs, file, dictionary_bytes, sample_docs, sample_bytes, plain)
    order = ["doc_id", "of_text", "row"]
    dealt = docs.withColumns({"of_text": F.xxhash64("text"), "row": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(dealt.select("doc_id", "text").mapInArrow(_shards(file, dictionary, plain, shard_bytes), SHARD_DDL), "shards", batch_rows=1000), dictionary


def read_tokens(shards: DataFrame, dictionary: bytes) -> DataFrame:
    """Read the shards back: doc_id, start (ids before it), n_tokens and ids_crc32 of each document.

    Documents of null or empty text have their end id, repeated rows come back each, no shards give no rows.
    """
    total = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}  # a row for each task that wrote
    n = np.array([total.get(k, 0) for k in range(max(total, default=-1) + 1)], np.int64)
    return shards.select("part", "begin", "content").mapInArrow(_read(dictionary, np.cumsum(n) - n), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(shards: DataFrame, dictionary: bytes, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of a few documents: only shards whose range holds one are read, and only the frames that the offset index names.

    Repeated rows come back each; ids that no shard holds are left out.
    """
    holds = reduce(lambda x, y: x | y, [(F.col("first_id") <= i) & (F.col("last_id") >= i) for i in doc_ids], F.lit(False))

    def run(batches):
        for batch in tokens.small(batches, 1):
            for content in batch.column("content"):
                shard = Shard(content.as_py(), dictionary)
                found = np.flatnonzero(np.isin(shard.index["doc_id"], doc_ids))
                yield pa.RecordBatch.from_arrays([pa.array(shard.index["doc_id"][found].astype(np.int64)), pa.array([shard.ids(k).astype(np.int64) for k in found], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return shards.where(holds).select("content").mapInArrow(run, "doc_id long, ids array<long>")


def export(shards: DataFrame, dictionary: bytes, folder: str) -> None:
    """For a look at small outputs: write shards as files of a folder of the driver, one at a time."""
    import pathlib

    out = pathlib.Path(folder)
    out.mkdir(parents=True, exist_ok=True)
    (out / "dictionary.zdict").write_bytes(dictionary)
    for row in shards.toLocalIterator():
        (out / f"{row['part']:08d}-{row['seq']:05d}.lqtok").write_bytes(row["content"])
