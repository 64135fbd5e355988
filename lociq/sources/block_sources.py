"""What Spark data sources over block-compressed, indexed files share: planning by ranges of bytes, regions from pushed filters, commit of written parts.

A scan is planned without opening a file: each split is a range of bytes of a file, and a task finds its own first record, from the offsets of the file's
index or by the shape of records. A region (from filters on chrom, start_pos and end_pos) leaves out the files that the folder's summary knows not to hold it, and
within a split all blocks that the index knows not to.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from lociq.sources.blocks import Blocks, Index, listed, opened, pieces

SUMMARY = "_regions.json"
SPLIT = 64 << 20


def register(spark: SparkSession, source: type) -> None:
    """Make a source known to a session, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)


@dataclass
class Split(InputPartition):
    path: str
    begin: int
    end: int


@dataclass
class Region:
    chrom: str | None = None
    start: int = 0
    end: int = 1 << 62


class BlockReader(DataSourceReader):
    """Options: path (a file or a folder), split_bytes. Subclasses say how a file begins, where records lie and what they hold."""

    suffix = ""
    index_suffix = ""
    tail = b""  # ends the last record of a file, where it may be missing
    absent = None  # stands for no contig; indexes leave such records out

    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("split_bytes", SPLIT))
        self.region = Region()

    def pushFilters(self, filters: list[Filter]):
        """Keep what filters say of one region; Spark still checks every row."""
        r = self.region
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("chrom",) and f.value != self.absent:
                r.chrom = f.value
            elif isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == ("start_pos",):
                r.end = min(r.end, f.value + isinstance(f, LessThanOrEqual))
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("end_pos",):
                r.start = max(r.start, f.value - isinstance(f, GreaterThanOrEqual))
            yield f

    def partitions(self) -> list[Split]:
        files = listed(self.path, self.suffix)
        if self.region.chrom is not None:
            where, at = opened(self.path)
            summary = f"{at}/{SUMMARY}"
            known = json.loads(where.open_input_file(summary).readall()) if where.get_file_info(summary).is_file else {}
            files = [(f, n) for f, n in files if self.holds(known.get(f.rpartition("/")[2]))]
        return [Split(f, k, min(n, k + self.split)) for f, n in files for k in range(0, n, self.split)]

    def holds(self, contigs: dict | None) -> bool:
        """Whether a file may hold the region, by its least start and greatest end on each contig."""
        if contigs is None:
            return True
        low, high = contigs.get(self.region.chrom, (0, -1))
        return low < self.region.end and self.region.start < high

    def read(self, partition):
        if not isinstance(partition, Split):  # nothing to read
            return
        blocks = self.blocks(partition.path)
        names, first = self.header(blocks)
        index = self.index(partition.path)
        begin, end = (self.boundary(blocks, at, first, index, names) for at in (partition.begin, partition.end))
        chunks = [(begin, end)]
        if index is not None and self.region.chrom is not None:
            number = (names if names is not None else self.index_names).get(self.region.chrom)
            found = index.chunks(number, self.region.start, self.region.end) if number is not None else []
            chunks = [(max(a, begin), min(b, end)) for a, b in found if a < end and begin < b]
        for a, b in chunks:
            for data, starts in pieces(blocks, a, b, self.cut, self.tail):
                yield from self.rows(data, starts, names)
        self.blocks_read = blocks.read

    def blocks(self, path: str) -> Blocks:
        return Blocks(path)

    def boundary(self, blocks: Blocks, at: int, first: int, index: Index | None, names) -> int:
        """Virtual offset of the first record in a block from a place on: one that the index names, or else by the shape of records. Both neighbours of a split come to the same."""
        if at == 0:
            return first
        if at >= blocks.size:
            return blocks.size << 16
        if index is not None:
            known = [v for c in index.contigs for v in c.windows.values() if v >> 16 >= at and v >= first]
            return min(known, default=blocks.size << 16)
        return max(first, self.resynchronised(blocks, blocks.first(at), names))

    def index(self, path: str) -> Index | None:
        where, at = opened(path)
        return self.parsed(where.open_input_file(at + self.index_suffix).readall()) if self.index_suffix and where.get_file_info(at + self.index_suffix).is_file else None

    # of a subclass: header(blocks) -> (numbers of contigs by name, first record), parsed(raw) -> Index, cut (see ``pieces``), resynchronised, rows


@dataclass
class Part(WriterCommitMessage):
    name: str
    contigs: dict


class BlockWriter(DataSourceArrowWriter):
    """Each task writes a part and its index into a hidden folder of the attempt; the commit moves the parts of the attempts that count and sums up what they hold."""

    suffix = ""
    index_suffix = ""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite, self.job = options["path"], overwrite, uuid.uuid4().hex

    def part(self) -> tuple[str, str]:
        """Name of this task's part, and the path to write it to."""
        where, at = opened(self.path)
        where.create_dir(f"{at}/_temporary-{self.job}", recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}-{self.job}{self.suffix}"
        return name, f"{at}/_temporary-{self.job}/{TaskContext.get().taskAttemptId()}-{name}"

    def write(self, iterator):
        name, path = self.part()
        where, _ = opened(self.path)
        contigs = self.written(path, iterator, where)
        return Part(f"{path.rpartition('/')[2]}|{name}" if contigs is not None else "", contigs or {})

    def commit(self, messages) -> None:
        where, at = opened(self.path)
        before = [f for f, _ in listed(self.path, self.suffix) + listed(self.path, self.suffix + self.index_suffix)] if self.overwrite else []
        summary = f"{at}/{SUMMARY}"
        known = json.loads(where.open_input_file(summary).readall()) if where.get_file_info(summary).is_file and not self.overwrite else {}
        for m in messages:
            if m is not None and m.name:
                temporary, name = m.name.split("|")
                for end in (self.index_suffix, ""):
                    where.move(f"{at}/_temporary-{self.job}/{temporary}{end}", f"{at}/{name}{end}")
                known[name] = m.contigs
        where.create_dir(at, recursive=True)
        with where.open_output_stream(summary, compression=None) as out:
            out.write(json.dumps(known).encode())
        for f in before:
            where.delete_file(f)
        self.abort(messages)

    def abort(self, messages) -> None:
        where, at = opened(self.path)
        if where.get_file_info(f"{at}/_temporary-{self.job}").type == fs.FileType.Directory:
            where.delete_dir(f"{at}/_temporary-{self.job}")


def widened(contigs: dict, name: str, start: int, end: int) -> None:
    low, high = contigs.get(name, (start, end))
    contigs[name] = (min(low, start), max(high, end))
