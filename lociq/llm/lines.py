"""Line dedup: of each line that several documents hold, only the smallest document keeps it.

A scan turns every document into the 128-bit keys of its lines, one row for each distinct key of a document with all its places. The rows
are dealt by range of (key, document), so a line that a third of all documents hold spans several ranges, sorted, and streamed: the first
document of a key keeps its lines. What a range can't know, whether its first key began in an earlier one, is settled by a table of at most
two rows a range. Results are compressed bitmaps of the lines to keep; texts aren't shuffled until someone applies these.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lociq.llm.common import ascii_lower, release, staged

BLANK = b" \t\n\x0b\x0c\r"
SHORTEST = 10  # code points of a key that is judged
ROWS = 20_000  # rows of an Arrow batch that the scan hands on
KEYS = "hi long, lo long, no_id boolean, doc long, text_hash long, n_lines int, places array<int>"
ORDER = ("hi", "lo", "no_id", "doc")


def line_keys(shortest: int = SHORTEST):
    """mapInArrow function from (no_id, doc, text_hash, text) to a row for each document and distinct key of its lines."""
    lower = bytes(ascii_lower().tolist())
    inner = bytes(range(0x80, 0xC0))  # bytes within a code point

    def judged(text: str) -> tuple[int, dict[bytes, list[int]]]:
        found: dict[bytes, list[int]] = {}
        lines = text.encode().split(b"\n")
        for at, line in enumerate(lines):
            key = line.strip(BLANK)
            if len(key) >= shortest and (key.isascii() or len(key.translate(None, inner)) >= shortest):
                found.setdefault(key.translate(lower), []).append(at)
        return len(lines), found

    def block(rows: list[tuple]) -> pa.RecordBatch:
        digest = np.frombuffer(b"".join(r[0] for r in rows), np.int64).reshape(-1, 2)
        columns = [pa.array(digest[:, 0]), pa.array(digest[:, 1])]
        columns += [pa.array([r[k] for r in rows], kind) for k, kind in ((1, pa.bool_()), (2, pa.int64()), (3, pa.int64()), (4, pa.int32()), (5, pa.list_(pa.int32())))]
        return pa.RecordBatch.from_arrays(columns, ["hi", "lo", "no_id", "doc", "text_hash", "n_lines", "places"])

    def run(batches):
        rows: list[tuple] = []
        for batch in batches:
            for k in range(batch.num_rows):
                no_id, doc, text_hash, text = (batch.column(c)[k].as_py() for c in range(4))
                n, found = judged(text)
                rows += [(hashlib.blake2b(key, digest_size=16).digest(), no_id, doc, text_hash, n, places) for key, places in found.items()]
                if len(rows) >= ROWS:
                    yield block(rows)
                    rows = []
        if rows:
            yield block(rows)

    return run


def _later(batches):
    """Of a sorted range: rows of documents that aren't the first of their key (kind 0), rows that another range may still beat (1), heads of the first and last key (2)."""
    first = last = None  # key and first document of the leading and of the present run

    def head(run) -> dict:
        (hi, lo), (no_id, doc) = run
        return {"kind": 2, "hi": hi, "lo": lo, "no_id": no_id, "doc": doc}

    names = ["kind", "hi", "lo", "no_id", "doc", "text_hash", "n_lines", "places"]
    schema = pa.schema(list(zip(names, [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32())], strict=True)))
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo, no_id, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ORDER)
        start = np.ones(len(hi), bool)
        start[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        start[0] = last is None or last[0] != (int(hi[0]), int(lo[0]))
        at = np.maximum.accumulate(np.where(start, np.arange(len(hi)), -1))  # where the run began, -1 before this batch
        least_no, least = no_id[at], doc[at]
        if not start[0]:
            least_no[at < 0], least[at < 0] = last[1]
        if first is None:
            first = ((int(hi[0]), int(lo[0])), (bool(no_id[0]), int(doc[0])))
        later = (doc != least) | (no_id != least_no)
        leading = ~later & (hi == first[0][0]) & (lo == first[0][1])
        end = len(hi) - 1
        last = ((int(hi[end]), int(lo[end])), (bool(least_no[end]), int(least[end])))
        out = batch.append_column("kind", pa.array(np.where(later, 0, 1).astype(np.int32))).filter(pa.array(later | leading))
        yield out.select(names).cast(schema)
    if first is not None:
        yield pa.RecordBatch.from_pylist([head(first), head(last)], schema)


def _bitmaps(batches):
    """Compressed bitmaps, a set bit for each line to keep."""
    for batch in batches:
        keep = []
        for n, places in zip(batch.column("n_lines").to_pylist(), batch.column("places"), strict=True):
            bits = np.ones(n, bool)
            bits[places.values.to_numpy()] = False
            keep.append(zlib.compress(np.packbits(bits).tobytes()))
        yield batch.drop_columns(["places"]).append_column("keep", pa.array(keep, pa.binary()))


def row_key(docs: DataFrame) -> list:
    """Columns that name a document and its text."""
    return [F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_hash")]


def keep_bitmaps(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Of each document that loses a line: no_id, doc (its id, 0 if it has none), text_hash, n_lines, n_dropped, keep (a compressed bitmap of its lines).

    ``docs`` has doc_id and text. A line's key is the line without white space at its ends and with A-Z in lower case. A document loses the lines whose key
    has ``shortest`` code points or more and stands in a document of smaller id too. Rows of one doc_id are one document: none of them loses a line to another,
    and repeated ones have one bitmap. A null doc_id is one document, larger than all others. A null or empty text is one empty line. An empty table gives no rows.
    """
    texts = docs.select(*row_key(docs), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keys = staged(texts.mapInArrow(line_keys(shortest), KEYS), "line-keys")
    found = keys.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).mapInArrow(_later, "kind int, " + KEYS)
    found = staged(found, "later-lines")
    release(keys)
    heads = found.where("kind = 2").groupBy("hi", "lo").agg(F.min(F.struct("no_id", "doc")).alias("least"))
    beaten = found.where("kind = 1").join(F.broadcast(heads), ["hi", "lo"]).where("no_id <> least.no_id or doc <> least.doc")  # two heads a range
    row = ["no_id", "doc", "text_hash", "n_lines"]
    gone = found.where("kind = 0").select(*row, "places").union(beaten.select(*row, "places"))
    gone = gone.groupBy(*row).agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))  # no more than a document's lines
    return gone.select(*row, F.size("places").alias("n_dropped"), "places").mapInArrow(_bitmaps, "no_id boolean, doc long, text_hash long, n_lines int, n_dropped int, keep binary")


def _applied(text_at: int):
    """mapInArrow function over rows whose text stands at ``text_at`` and whose bitmap stands last; the bitmap gives way to the number of lines."""

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for text, keep in zip(batch.column(text_at).to_pylist(), batch.columns[-1].to_pylist(), strict=True):
                if keep is None:
                    texts.append(text)
                    counts.append(1 + (text or "").count("\n"))
                    continue
                lines = text.split("\n")
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
                texts.append("\n".join(x for x, kept in zip(lines, bits.tolist(), strict=True) if kept))
                counts.append(len(lines))
            columns = [*batch.columns[:text_at], pa.array(texts, pa.string()), *batch.columns[text_at + 1 : -1], pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return run


def without_repeated_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Documents with the kept lines as text, followed by the numbers of lines dropped and of all lines (n_dropped and n_lines, behind as many _ as no other name begins with).

    All columns of ``docs`` pass through, whatever their names. A null text stays null and has one line.
    """
    names, own = docs.columns, "_"
    while any(c.startswith(own) for c in names):
        own += "_"
    row, keep, dropped, lines = (own + c for c in ("row", "keep", "n_dropped", "n_lines"))
    texts = docs.withColumn("text", F.col("text").cast("string")).withColumn(row, F.struct(*row_key(docs)))
    found = bitmaps.select(F.struct("no_id", "doc", "text_hash").alias(row), F.col("keep").alias(keep), F.col("n_dropped").cast("long").alias(dropped))
    both = texts.join(found, row, "left").select(*(F.col(f"`{c}`") for c in names), F.coalesce(dropped, F.lit(0)).cast("long").alias(dropped), F.col(keep).alias(lines))
    schema = StructType([*both.schema.fields[:-1], StructField(lines, LongType())])
    return both.mapInArrow(_applied(names.index("text")), schema)


def dropped_lines(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Of each row of ``docs``: doc_id, n_lines, n_dropped and the SHA-256 of the text that is left (null texts as empty)."""
    kept = without_repeated_lines(docs.select("doc_id", "text"), keep_bitmaps(docs, shortest))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), digest.alias("kept_sha256"))
