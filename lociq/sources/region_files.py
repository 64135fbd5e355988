"""Indexed region tables: tab-separated text in blocks, sorted by position, with a bins-and-offsets index beside each file, as a Spark data source.

``write(df, path)`` and ``read(spark, path, schema)`` are the way in. Filters of one region (chrom = x and start_pos < e and end_pos > s) read only the blocks that the index names.
The files are plain block gzip with ``#`` before the header, so any reader of compressed text reads them whole.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pcsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource
from pyspark.sql.types import StructType

from lociq.sources.block_sources import BlockReader, BlockWriter, register, widened
from lociq.sources.blocks import Blocks, Index, Writer, compressed

# fixed values of the index format: 0-based half-open text, its columns of contig, start and end, the mark of header lines
INDEX_MAGIC = b"TBI\1"
LAYOUT = (0x10000, 1, 2, 3, ord("#"), 0)
POSITION = ("chrom", "start_pos", "end_pos")


def cut(data: bytes, at: int, limit: int) -> tuple[np.ndarray, int]:
    """See ``blocks.pieces``: lines."""
    newline = np.flatnonzero(np.frombuffer(data, np.uint8)[at:] == 10) + at + 1
    starts = np.concatenate([[at], newline[:-1]]) if len(newline) else newline
    inside = starts < limit
    return starts[inside].astype(np.int64), int(newline[inside][-1]) if inside.any() else at


def unpacked(raw: bytes) -> bytes:
    """All bytes of a small block-compressed file."""
    out, stream = b"", zlib.decompressobj(31)
    while raw:
        out += stream.decompress(raw)
        raw, stream = stream.unused_data, zlib.decompressobj(31)
    return out


class RegionReader(BlockReader):
    suffix, index_suffix, tail = ".tsv.gz", ".tbi", b"\n"

    def __init__(self, options: dict, schema: StructType):
        super().__init__(options)
        from pyspark.sql.pandas.types import to_arrow_schema

        self.kind = to_arrow_schema(schema)

    def header(self, blocks: Blocks) -> tuple[None, int]:
        """Header lines fill blocks of their own."""
        at = 0
        while at < blocks.size:
            data, after = blocks.get(at)
            if not data.startswith(b"#"):
                break
            at = after
        return None, at << 16

    def parsed(self, raw: bytes) -> Index:
        raw = unpacked(raw)
        if raw[:4] != INDEX_MAGIC:
            raise ValueError("not an index of a region table")
        size = int.from_bytes(raw[32:36], "little")
        self.index_names = {c.decode(): k for k, c in enumerate(raw[36 : 36 + size].split(b"\0")[:-1])}
        return Index.read(raw[4:8] + raw[36 + size :], 0)

    cut = staticmethod(cut)

    def resynchronised(self, blocks: Blocks, at: int, names) -> int:
        """Behind the first newline; the line before it belongs to the split before, even if it begins with the block."""
        least = 1 << 17
        while at < blocks.size:
            data, places, offsets, after = blocks.stretch(at, blocks.size, least)
            k = data.find(b"\n")
            if k >= 0:
                block = int(np.searchsorted(offsets, k + 1, side="right")) - 1
                return int(places[block]) << 16 | k + 1 - int(offsets[block]) if k + 1 < len(data) else after << 16
            if after >= blocks.size:
                break
            least *= 2
        return blocks.size << 16

    def rows(self, data: bytes, starts: np.ndarray, names):
        options = pcsv.ConvertOptions(column_types=self.kind, null_values=[""], strings_can_be_null=True)
        parse = pcsv.ParseOptions(delimiter="\t", quote_char=False, ignore_empty_lines=False)
        table = pcsv.read_csv(io.BytesIO(data[starts[0] : starts[-1]]), pcsv.ReadOptions(column_names=self.kind.names), parse, options)
        yield from table.cast(self.kind).to_batches()


class RegionWriter(BlockWriter):
    suffix, index_suffix = ".tsv.gz", ".tbi"

    def __init__(self, options: dict, overwrite: bool, names: list[str]):
        super().__init__(options, overwrite)
        self.names = names

    def written(self, path: str, batches, where) -> dict:
        out, held, contigs = Writer(where.open_output_stream(path, compression=None)), {}, {}
        out.put(("#" + "\t".join(self.names) + "\n").encode())
        index, last = Index(0), None
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = [pc.fill_null(c.cast(pa.string()), "") for c in batch.columns]
            if any(pc.any(pc.match_substring_regex(c, "[\t\n\r]")).as_py() for c in cells):
                raise ValueError("a cell holds a tab or a line break")
            lines = pc.binary_join_element_wise(*cells, "\t")
            raw = [line + b"\n" for line in lines.cast(pa.binary()).to_pylist()]
            starts = np.cumsum([0, *map(len, raw[:-1])]).astype(np.int64)
            offsets = out.records(b"".join(raw), starts)
            chrom, start, end = batch.column(0).to_pylist(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for c in dict.fromkeys(chrom):
                if c not in contigs:
                    contigs[c] = len(contigs)
                    index.contigs += Index(1).contigs
            number = np.array([contigs[c] for c in chrom])
            place = [*([last] if last else []), *zip(number.tolist(), start.tolist(), strict=True)]
            if any(a > b for a, b in zip(place, place[1:], strict=False)):
                raise ValueError("rows don't come in order of contig and position")
            last = place[-1]
            index.add(number, start, end, offsets)
            for c, n in contigs.items():
                if (mine := number == n).any():
                    widened(held, c, int(start[mine].min()), int(end[mine].max()))
        out.close()
        names = b"".join(c.encode() + b"\0" for c in contigs)
        body = index.written()
        raw = INDEX_MAGIC + body[:4] + struct.pack("<6ii", *LAYOUT, len(names)) + names + body[4:]
        with where.open_output_stream(path + self.index_suffix, compression=None) as f:
            f.write(b"".join(compressed(raw[k : k + 60_000]) for k in range(0, len(raw), 60_000)) + compressed(b""))
        return held


class RegionSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "region_table"

    def reader(self, schema: StructType) -> RegionReader:
        return RegionReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> RegionWriter:
        if tuple(schema.names[:3]) != POSITION:
            raise ValueError(f"the first columns are {', '.join(schema.names[:3])}, not {', '.join(POSITION)}")
        return RegionWriter(dict(self.options), overwrite, schema.names)


def write(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a table whose first columns are chrom, start_pos and end_pos as sorted, indexed files; nulls are empty cells.

    Rows are dealt by range of position, so a contig spreads over files and a file holds its contigs in one piece each. Rows without a position, which no index can find, are an error, as are
    cells with tabs or line breaks.
    """
    register(df.sparkSession, RegionSource)
    bare = F.col("chrom").isNull() | F.col("start_pos").isNull() | F.col("end_pos").isNull()
    checked = df.withColumn("chrom", F.when(bare, F.raise_error(F.lit("a row has no position"))).otherwise(F.col("chrom")))
    dealt = checked.withColumns({"start_pos": F.col("start_pos").cast("long"), "end_pos": F.col("end_pos").cast("long")}).repartitionByRange(*POSITION).sortWithinPartitions(*POSITION)
    dealt.write.format("region_table").mode(mode).save(path)


def read(spark: SparkSession, path: str, schema: str, split_bytes: int = 64 << 20) -> DataFrame:
    """The table that ``write`` wrote (or another program, of the same columns and names of files), in splits of ``split_bytes``; empty cells are null."""
    register(spark, RegionSource)
    return spark.read.format("region_table").schema(schema).option("split_bytes", split_bytes).load(path)
