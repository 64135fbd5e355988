"""Aligned reads in block-compressed binary files as a Spark data source, with splits, region filters by index, and a sorted, indexed writer.

``read(spark, path)`` and ``write(df, path, contigs)`` are the way in. Of a region's filters (chrom = x and start_pos < e and end_pos > s) only the blocks that the index names are read.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from lociq.sources.block_sources import BlockReader, BlockWriter, register, widened
from lociq.sources.blocks import Blocks, Index, Writer

# fixed values of the format: letters of packed bases and operations, types of tags, the fields before a record's name
BASES = "=ACMGRSVTWYHKDBN"
OPERATIONS = "MIDNSHP=X"
NUMBERS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
HEAD = np.dtype([("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("l_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_ops", "<u2"), ("flag", "<u2"), ("l_seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("length", "<i4")])
FIXED = struct.Struct("<iiBBHHHiiii")
INDEX_MAGIC = b"BAI\1"
SCHEMA = "name string, flag int, chrom string, mapq int, cigar string, next_chrom string, next_pos long, length long, seq string, qual string, tags map<string,string>, start_pos long, end_pos long"
ARROW = pa.schema([("name", pa.string()), ("flag", pa.int32()), ("chrom", pa.string()), ("mapq", pa.int32()), ("cigar", pa.string()), ("next_chrom", pa.string()), ("next_pos", pa.int64()), ("length", pa.int64()), ("seq", pa.string()), ("qual", pa.string()), ("tags", pa.map_(pa.string(), pa.string())), ("start_pos", pa.int64()), ("end_pos", pa.int64())])
LONGEST_RECORD = 1 << 28
ROWS = 20_000


# ------------------------------------------------------------------------------------------ decoding


def ragged(buf: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of many stretches one behind the other, and their offsets."""
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    return buf[np.repeat(begin - offsets[:-1], length) + np.arange(offsets[-1])], offsets


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def tags(raw: bytes) -> Iterator[tuple[str, str]]:
    """Tags with their values as they stand in alignment text."""
    at = 0
    while at < len(raw):
        name, kind = raw[at : at + 2].decode(), chr(raw[at + 2])
        at += 3
        if kind in "ZH":
            end = raw.index(b"\0", at)
            yield name, raw[at:end].decode()
            at = end + 1
        elif kind == "A":
            yield name, chr(raw[at])
            at += 1
        elif kind == "B":
            inner, n = chr(raw[at]), int.from_bytes(raw[at + 1 : at + 5], "little")
            form = struct.Struct(f"<{n}{NUMBERS[inner]}")
            yield name, ",".join([inner, *(f"{x:g}" if inner == "f" else str(x) for x in form.unpack_from(raw, at + 5))])
            at += 5 + form.size
        else:
            form = struct.Struct("<" + NUMBERS[kind])
            (x,) = form.unpack_from(raw, at)
            yield name, f"{x:g}" if kind == "f" else str(x)
            at += form.size


def heads(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buf, HEAD.itemsize)[starts]).view(HEAD)[:, 0]


def decoded(data: bytes, starts: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Records as columns; ``starts`` has one more, the end of the last. Of a tag that a record repeats the first counts."""
    buf = np.frombuffer(data, np.uint8)
    at, ends = starts[:-1], starts[1:]
    h = heads(buf, at)
    name_at = at + HEAD.itemsize
    n_ops, l_seq = h["n_ops"].astype(np.int64), h["l_seq"].astype(np.int64)
    ops_at = name_at + h["l_name"]
    seq_at = ops_at + 4 * n_ops
    qual_at = seq_at + (l_seq + 1) // 2
    raw, _ = ragged(buf, ops_at, 4 * n_ops)
    ops = np.ascontiguousarray(raw).view("<u4").astype(np.int64)
    record = np.repeat(np.arange(len(at)), n_ops)
    consumed = np.isin(ops & 15, [OPERATIONS.index(c) for c in "MDN=X"]) * (ops >> 4)
    reach = np.maximum(np.bincount(record, consumed, len(at)).astype(np.int64), 1)
    seen, which = np.unique(ops, return_inverse=True)
    words = [f"{x >> 4}{OPERATIONS[x & 15]}".encode() for x in seen.tolist()]
    size = np.array([len(w) for w in words], np.int64)
    text, ends_of = ragged(np.frombuffer(b"".join(words), np.uint8), (np.cumsum(size) - size)[which], size[which])
    cigar = strings(text, ends_of[np.concatenate([[0], np.cumsum(n_ops)])])
    offsets = np.concatenate([[0], np.cumsum(l_seq)])
    nibble = np.repeat(2 * seq_at - offsets[:-1], l_seq) + np.arange(offsets[-1])
    letters = np.frombuffer(BASES.encode(), np.uint8)[buf[nibble >> 1] >> (4 * (~nibble & 1)).astype(np.uint8) & 15]
    qual, _ = ragged(buf, qual_at, l_seq)
    unknown = (l_seq == 0) | (buf[np.minimum(qual_at, len(buf) - 1)] == 255)
    star = lambda absent, array: pc.if_else(pa.array(absent), "*", array)
    contig = lambda k: pa.array([*names, "*"]).take(pa.array(np.where(k < 0, len(names), k)))
    columns = {
        "name": strings(*ragged(buf, name_at, h["l_name"].astype(np.int64) - 1)),
        "flag": h["flag"].astype(np.int32),
        "chrom": contig(h["ref"]),
        "mapq": h["mapq"].astype(np.int32),
        "cigar": star(n_ops == 0, cigar),
        "next_chrom": pc.if_else(pa.array((h["next_ref"] == h["ref"]) & (h["ref"] >= 0)), "=", contig(h["next_ref"])),
        "next_pos": h["next_pos"].astype(np.int64) + 1,
        "length": h["length"].astype(np.int64),
        "seq": star(l_seq == 0, strings(letters, offsets)),
        "qual": star(unknown, strings(qual + np.uint8(33) if not unknown.any() else np.where(qual == 255, 42, qual + np.uint8(33)).astype(np.uint8), offsets)),
        "tags": pa.array([list(dict(reversed(list(tags(data[a:b])))).items()) for a, b in zip((qual_at + l_seq).tolist(), ends.tolist(), strict=True)], ARROW.field("tags").type),
        "start_pos": h["pos"].astype(np.int64),
        "end_pos": h["pos"] + reach,
    }
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], schema=ARROW)


def cut(data: bytes, at: int, limit: int) -> tuple[np.ndarray, int]:
    """See ``blocks.pieces``: each record tells its size."""
    starts, size = [], len(data)
    while at < limit and at + 4 <= size:
        end = at + 4 + int.from_bytes(data[at : at + 4], "little")
        if end > size:
            break
        starts.append(at)
        at = end
    return np.array(starts, np.int64), at


def plausible(data: bytes, contigs: int) -> np.ndarray:
    """Places where a record may begin: sizes fit together, contigs exist, the name ends in a zero."""
    buf = np.frombuffer(data, np.uint8)
    at = np.arange(max(0, len(buf) - HEAD.itemsize + 1))
    if not len(at):
        return at
    h = heads(buf, at)
    wide = {k: h[k].astype(np.int64) for k in ("size", "l_name", "n_ops", "l_seq")}
    least = HEAD.itemsize - 4 + wide["l_name"] + 4 * wide["n_ops"] + (wide["l_seq"] + 1) // 2 + wide["l_seq"]
    fits = (wide["l_seq"] >= 0) & (wide["l_name"] > 0) & (wide["size"] >= least) & (wide["size"] < LONGEST_RECORD)
    for c in ("ref", "next_ref"):
        fits &= (h[c] >= -1) & (h[c] < contigs)
    for c in ("pos", "next_pos"):
        fits &= h[c] >= -1
    at = at[fits]
    last = at + HEAD.itemsize + wide["l_name"][fits] - 1
    return at[(last >= len(buf)) | (buf[np.minimum(last, len(buf) - 1)] == 0)]


def first_record(data: bytes, contigs: int) -> int | None:
    """The first place from which records follow each other up to the end of the bytes; None if there is none, or too few bytes to tell."""
    places = plausible(data, contigs).tolist()
    known = set(places)
    for at in places:
        n = 0
        begin = at
        while at in known:
            at += 4 + int.from_bytes(data[at : at + 4], "little")
            n += 1
        if at >= len(data) - HEAD.itemsize and n > 1 or at == len(data):
            return begin
    return None


# ------------------------------------------------------------------------------------------ the source


class AlignmentReader(BlockReader):
    suffix, index_suffix, absent = ".bam", ".bai", "*"

    def header(self, blocks: Blocks) -> tuple[dict[str, int], int]:
        """Numbers of the contigs by name, and the virtual offset of the first record."""
        data, at, placed, offset = b"", 0, [], [0]

        def upto(n: int) -> None:
            nonlocal data, at
            while len(data) < n:
                placed.append(at)
                more, at = blocks.get(at)
                data += more
                offset.append(len(data))

        def number(k: int) -> int:
            upto(k + 4)
            return int.from_bytes(data[k : k + 4], "little")

        upto(8)
        if data[:4] != b"BAM\1":
            raise ValueError("not an alignment file")
        k = 8 + number(4)
        n, k = number(k), k + 4
        names = {}
        for _ in range(n):
            size = number(k)
            upto(k + 8 + size)
            names[data[k + 4 : k + 3 + size].decode()] = len(names)
            k += 8 + size
        block = int(np.searchsorted(offset, k, side="right")) - 1
        return names, (placed[block] << 16 | k - offset[block]) if block < len(placed) else at << 16

    def parsed(self, raw: bytes) -> Index:
        return Index.read(raw, len(INDEX_MAGIC))

    cut = staticmethod(cut)

    def resynchronised(self, blocks: Blocks, at: int, names: dict[str, int]) -> int:
        least = 1 << 18
        while True:
            data, places, offsets, next_ = blocks.stretch(at, blocks.size, least)
            if not data:
                return blocks.size << 16
            k = first_record(data, len(names))
            if k is not None:
                block = int(np.searchsorted(offsets, k, side="right")) - 1
                return int(places[block]) << 16 | k - int(offsets[block])
            if next_ >= blocks.size:
                return blocks.size << 16
            least *= 2

    def rows(self, data: bytes, starts: np.ndarray, names: dict[str, int]):
        for k in range(0, len(starts) - 1, ROWS):
            yield decoded(data, starts[k : k + ROWS + 1], list(names))


def packed_tags(found) -> bytes:
    """Tags from text: whole numbers as such, everything else as text."""
    out = b""
    for name, value in found or []:
        whole = re.fullmatch("-?[0-9]{1,9}", value)
        out += name.encode() + (b"i" + struct.pack("<i", int(value)) if whole else b"Z" + value.encode() + b"\0")
    return out


def encoded(row: dict, numbers: dict[str, int]) -> bytes:
    seq, qual = (row[c] if row[c] not in (None, "*") else "" for c in ("seq", "qual"))
    ops = [int(n) << 4 | OPERATIONS.index(o) for n, o in re.findall("([0-9]+)([MIDNSHP=X])", row["cigar"] or "")]
    ref = numbers.get(row["chrom"], -1)
    next_ref = ref if row["next_chrom"] == "=" else numbers.get(row["next_chrom"], -1)
    bases = [BASES.index(c) for c in seq] + [0] * (len(seq) % 2)
    name = row["name"].encode() + b"\0"
    body = FIXED.pack(ref, row["start_pos"], len(name), row["mapq"], 0, len(ops), row["flag"], len(seq), next_ref, (row["next_pos"] or 0) - 1, row["length"] or 0) + name
    body += struct.pack(f"<{len(ops)}I", *ops) + bytes(a << 4 | b for a, b in zip(bases[::2], bases[1::2], strict=True))
    body += (bytes(ord(c) - 33 for c in qual) if qual else b"\xff" * len(seq)) + packed_tags(row["tags"])
    return struct.pack("<i", len(body)) + body


class AlignmentWriter(BlockWriter):
    suffix, index_suffix = ".bam", ".bai"

    def __init__(self, options: dict, overwrite: bool):
        super().__init__(options, overwrite)
        self.contigs: dict[str, int] = json.loads(options["contigs"])

    def written(self, path: str, batches, where) -> dict:
        """Write the records of a sorted partition; the least start and greatest end of each contig."""
        out, numbers = Writer(where.open_output_stream(path, compression=None)), {c: k for k, c in enumerate(self.contigs)}
        lines = "@HD\tVN:1.6\tSO:coordinate\n" + "".join(f"@SQ\tSN:{c}\tLN:{n}\n" for c, n in self.contigs.items())
        refs = b"".join(struct.pack("<i", len(c.encode()) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in self.contigs.items())
        out.put(b"BAM\1" + struct.pack("<i", len(lines)) + lines.encode() + struct.pack("<i", len(numbers)) + refs)
        index, held, last = Index(len(numbers)), {}, (-1, -1)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                records = [encoded(r, numbers) for r in batch.slice(k, ROWS).to_pylist()]
                size = np.array([len(r) for r in records])
                data, starts = b"".join(records), np.concatenate([[0], np.cumsum(size)])
                table = decoded(data, starts, list(numbers))
                ref, start, end = heads(np.frombuffer(data, np.uint8), starts[:-1])["ref"], table["start_pos"].to_numpy(), table["end_pos"].to_numpy()
                place = [last, *zip(np.where(ref < 0, len(numbers), ref).tolist(), start.tolist(), strict=True)]
                if any(a > b for a, b in zip(place, place[1:], strict=False)):
                    raise ValueError("records don't come in order of contig and position")
                last = place[-1]
                offsets = out.records(data, starts[:-1])
                index.add(ref, start, end, offsets)
                for c, n in numbers.items():
                    if (mine := ref == n).any():
                        widened(held, c, int(start[mine].min()), int(end[mine].max()))
        out.close()
        with where.open_output_stream(path + self.index_suffix, compression=None) as f:
            f.write(INDEX_MAGIC + index.written())
        return held


class AlignmentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "aligned_reads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> AlignmentReader:
        return AlignmentReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> AlignmentWriter:
        return AlignmentWriter(dict(self.options), overwrite)


def read(spark: SparkSession, path: str, split_bytes: int = 64 << 20) -> DataFrame:
    """Records of the .bam files of a folder, or of one: the columns that ``readers.alignments`` gives of the same records as text, and end_pos.

    Files are read in splits of ``split_bytes``, of any size and with or without an index (.bai) beside them. An absent contig is '*', an absent position -1.
    """
    register(spark, AlignmentSource)
    return spark.read.format("aligned_reads").option("split_bytes", split_bytes).load(path)


def write(df: DataFrame, path: str, contigs: dict[str, int]) -> None:
    """Write records (the columns of ``read``; end_pos is not needed) as files sorted by position over ``contigs`` (name -> length, in order), each with its index.

    Rows are dealt by range of contig and position, so a contig spreads over many files. Records of other contigs come last, without one.
    """
    from pyspark.sql import functions as F

    register(df.sparkSession, AlignmentSource)
    number = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for k, c in enumerate(contigs) for x in (c, k))), F.col("chrom")), F.lit(len(contigs)))
    rows = df.withColumn("end_pos", F.lit(None).cast("long")).select(*ARROW.names)
    dealt = rows.repartitionByRange(number, "start_pos", "name").sortWithinPartitions(number, "start_pos")
    dealt.write.format("aligned_reads").option("contigs", json.dumps(contigs)).mode("append").save(path)
