"""Read files of four lines a record as a Spark data source: plain or block-compressed files in splits that find their first record by the shape of lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from lociq.sources.alignment_files import ragged, strings
from lociq.sources.block_sources import BlockReader, register
from lociq.sources.blocks import Blocks, Plain, block_size

SCHEMA = "name string, seq string, qual string, path string"


def newlines(data: bytes, at: int = 0) -> np.ndarray:
    return np.flatnonzero(np.frombuffer(data, np.uint8)[at:] == 10) + at


def cut(data: bytes, at: int, limit: int) -> tuple[np.ndarray, int]:
    """See ``blocks.pieces``: four lines each."""
    ends = newlines(data, at)[3::4] + 1
    starts = np.concatenate([[at], ends[:-1]]).astype(np.int64) if len(ends) else np.zeros(0, np.int64)
    inside = starts < limit
    return starts[inside], int(ends[inside][-1]) if inside.any() else at


def first_record(data: bytes) -> int | None:
    """The first line behind a newline that begins with @ where the next but one begins with +. A quality line may begin with @, but a sequence stands two lines behind it. None: too few bytes."""
    starts = newlines(data)[:16] + 1
    for k in range(len(starts) - 2):
        if starts[k + 2] >= len(data):
            return None
        if data[starts[k] : starts[k] + 1] == b"@" and data[starts[k + 2] : starts[k + 2] + 1] == b"+":
            return int(starts[k])
    return None


class FastqReader(BlockReader):
    tail = b"\n"

    def __init__(self, options: dict):
        super().__init__(options)
        self.suffix = options["suffix"]

    def blocks(self, path: str) -> Blocks:
        found = Blocks(path)
        head = found.file.read_at(min(64, found.size), 0)
        if head[:2] == b"\x1f\x8b" and not block_size(head):
            raise ValueError(f"{path} is compressed in one piece; read it with readers.fastq")
        return found if block_size(head) else Plain(path)

    def header(self, blocks: Blocks) -> tuple[None, int]:
        return None, 0

    cut = staticmethod(cut)

    def resynchronised(self, blocks: Blocks, at: int, names) -> int:
        least = 1 << 16
        while at < blocks.size:
            data, places, offsets, after = blocks.stretch(at, blocks.size, least)
            k = first_record(data)
            if k is not None:
                block = int(np.searchsorted(offsets, k, side="right")) - 1
                return int(places[block]) << 16 | k - int(offsets[block])
            if after >= blocks.size:
                break
            least *= 2
        return blocks.size << 16

    def read(self, partition):
        self.at = getattr(partition, "path", "")
        yield from super().read(partition)

    def rows(self, data: bytes, starts: np.ndarray, names):
        buf = np.frombuffer(data, np.uint8)
        ends = newlines(data[: starts[-1]], int(starts[0]))
        begins = np.concatenate([[starts[0]], ends[:-1] + 1])
        ends = ends - (buf[ends - 1] == 13)  # lines may end in \r\n
        if (buf[begins[::4]] != ord("@")).any() or (buf[begins[2::4]] != ord("+")).any() or ((ends - begins)[1::4] != (ends - begins)[3::4]).any():
            raise ValueError("not records of four lines")
        for k in range(0, len(begins), 4 * 20_000):
            b, e = begins[k : k + 80_000], ends[k : k + 80_000]
            cell = lambda line, skip, b=b, e=e: strings(*ragged(buf, b[line::4] + skip, (e - b)[line::4] - skip))
            yield pa.RecordBatch.from_arrays([cell(0, 1), cell(1, 0), cell(3, 0), pa.array([self.at] * len(b[::4]))], ["name", "seq", "qual", "path"])


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sequenced_reads"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        return FastqReader(dict(self.options))


def read(spark: SparkSession, path: str, suffix: str = ".fastq", split_bytes: int = 64 << 20) -> DataFrame:
    """Records (name with what follows it, seq, qual, path) of a file, or of a folder's files of a suffix, in splits of ``split_bytes``.

    Files are plain or compressed in blocks; one that is compressed in one piece can't be split, and is an error here. Records that aren't four lines, or of which sequence and quality
    differ in length, are an error.
    """
    register(spark, FastqSource)
    return spark.read.format("sequenced_reads").option("suffix", suffix).option("split_bytes", split_bytes).load(path)
