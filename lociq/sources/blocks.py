"""Block-compressed files (gzip members of at most 64 KB that name their size) and their bins-and-offsets indexes.

A virtual offset is a block's place in the file, shifted by 16 bits, plus a place in the decompressed block. An index maps, for each contig, bins of
five levels of width to ranges of virtual offsets, and windows of 16,384 bases to the least virtual offset of a record that reaches into them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyarrow import fs

# fixed values of the formats
MEMBER = struct.Struct("<4BI2BH2BHH")
MAGIC = (31, 139, 8, 4)
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")  # the empty block that ends a file
SHIFT, LEVELS = 14, 5  # the narrowest bins and the windows are 2^14 bases wide, each level above is eight times as wide
LEAST = [((1 << 3 * level) - 1) // 7 for level in range(LEVELS + 1)]  # first bin of each level, the widest first
LONGEST = 1 << SHIFT + 3 * LEVELS  # bases of a contig that bins can tell apart
PAYLOAD = 65_280  # decompressed bytes of a full block


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a local path or a URI that pyarrow knows, and the path there."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def listed(path: str, suffix: str) -> list[tuple[str, int]]:
    """Files of a suffix with their sizes: of a folder, not hidden, in order of name; or the file itself."""
    where, at = opened(path)
    if where.get_file_info(at).type == fs.FileType.File:
        return [(at, where.get_file_info(at).size)]
    found = where.get_file_info(fs.FileSelector(at, recursive=False))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(suffix) and not f.base_name.startswith(("_", ".")))


# ------------------------------------------------------------------------------------------ blocks


def compressed(data: bytes) -> bytes:
    """One block."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    return MEMBER.pack(*MAGIC, 0, 0, 255, 6, 66, 67, 2, len(body) + MEMBER.size + 7) + body + struct.pack("<II", zlib.crc32(data), len(data))


def block_size(head: bytes) -> int:
    """Bytes of the block that begins with ``head``, or 0 if none does; other extra fields may precede the one that tells."""
    if len(head) < 12 or tuple(head[:4]) != MAGIC:
        return 0
    at, end = 12, 12 + int.from_bytes(head[10:12], "little")
    while at + 4 <= min(end, len(head)):
        kind, size = head[at : at + 2], int.from_bytes(head[at + 2 : at + 4], "little")
        if kind == b"BC" and size == 2:
            return int.from_bytes(head[at + 4 : at + 6], "little") + 1
        at += 4 + size
    return 0


class Blocks:
    """Decompressed blocks of a file, read forwards from any block."""

    def __init__(self, path: str):
        where, at = opened(path)
        self.file = where.open_input_file(at)
        self.size = self.file.size()
        self.read = 0  # blocks decompressed so far

    def head(self, at: int) -> int:
        return block_size(self.file.read_at(min(64, self.size - at), at)) if at < self.size else 0

    def first(self, at: int) -> int:
        """The first block at or after a place: a header whose block is followed by another header, or by the file's end."""
        window = self.file.read_at(min(3 << 16, self.size - at), at) if at < self.size else b""
        k = window.find(bytes(MAGIC))
        while k >= 0:
            size = block_size(window[k : k + 64])
            if size and (at + k + size == self.size or self.head(at + k + size)):
                return at + k
            k = window.find(bytes(MAGIC), k + 1)
        return self.size

    def get(self, at: int) -> tuple[bytes, int]:
        """The bytes of the block at a place, and the place of the next one."""
        size = self.head(at)
        if not size:
            raise ValueError(f"no block at {at}")
        raw = self.file.read_at(size, at)
        begin = 12 + int.from_bytes(raw[10:12], "little")
        self.read += 1
        data = zlib.decompress(raw[begin:-8], -15)
        if zlib.crc32(data) != int.from_bytes(raw[-8:-4], "little"):
            raise ValueError(f"damaged block at {at}")
        return data, at + size

    def stretch(self, at: int, end: int, least: int = 4 << 20) -> tuple[bytes, np.ndarray, np.ndarray, int]:
        """At least ``least`` decompressed bytes of the blocks from ``at`` to ``end`` (or all of them): the bytes, the blocks' places in the file and in the bytes, the next place."""
        parts, places, offsets, total = [], [], [], 0
        while at < min(end, self.size) and total < least:
            places.append(at)
            offsets.append(total)
            data, at = self.get(at)
            parts.append(data)
            total += len(data)
        return b"".join(parts), np.array(places, np.int64), np.array(offsets, np.int64), at


class Plain(Blocks):
    """A file that isn't compressed, as blocks of 64 KB."""

    STEP = 1 << 16

    def first(self, at: int) -> int:
        return min(-(-at // self.STEP) * self.STEP, self.size)

    def get(self, at: int) -> tuple[bytes, int]:
        self.read += 1
        data = self.file.read_at(min(self.STEP, self.size - at), at)
        return data, at + len(data)


class Writer:
    """Writes records into blocks and tells their virtual offsets; no record is cut unless it is longer than a block."""

    def __init__(self, file):
        self.file, self.at = file, 0
        self.held: list[bytes] = []

    def put(self, data: bytes) -> None:
        """Bytes in blocks of their own."""
        for k in range(0, len(data), PAYLOAD):
            self.at += self.file.write(compressed(data[k : k + PAYLOAD]))

    def records(self, data: bytes, starts: np.ndarray) -> np.ndarray:
        """Write records that begin at ``starts`` of ``data`` (the first at 0); virtual offsets of where each begins, and where the last ends."""
        ends = np.append(starts[1:], len(data))
        out, k = [], 0
        while k < len(starts):
            last = max(k + 1, int(np.searchsorted(ends, starts[k] + PAYLOAD, side="right")))
            out.append((self.at << 16) + starts[k:last] - starts[k])
            self.put(data[starts[k] : ends[last - 1]])
            k = last
        return np.concatenate([*out, [self.at << 16]]).astype(np.int64)

    def close(self) -> None:
        self.file.write(LAST)
        self.file.close()


# ------------------------------------------------------------------------------------------ indexes


def bins_of(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The narrowest bin that holds each interval (an empty one counts as one base)."""
    low, high = start.astype(np.int64), np.maximum(end, start + 1).astype(np.int64) - 1
    out = np.zeros(len(low), np.int64)
    for level in range(1, LEVELS + 1):
        shift = SHIFT + 3 * (LEVELS - level)
        out = np.where(low >> shift == high >> shift, LEAST[level] + (low >> shift), out)
    return out


def bins_over(start: int, end: int) -> set[int]:
    """All bins that may hold intervals that overlap one."""
    start, end = max(0, min(start, LONGEST - 1)), max(1, min(end, LONGEST))
    return {0} | {b for level in range(1, LEVELS + 1) for s in [SHIFT + 3 * (LEVELS - level)] for b in range(LEAST[level] + (start >> s), LEAST[level] + ((end - 1) >> s) + 1)}


@dataclass
class Contig:
    bins: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    windows: dict[int, int] = field(default_factory=dict)


class Index:
    """Bins and windows by number of contig."""

    def __init__(self, contigs: int):
        self.contigs = [Contig() for _ in range(contigs)]

    def add(self, contig: np.ndarray, start: np.ndarray, end: np.ndarray, offsets: np.ndarray) -> None:
        """Records in file order; ``offsets`` has one more, the end of the last. Those without a contig (below 0) are left out."""
        bins = bins_of(start, end)
        change = np.flatnonzero((np.diff(bins) != 0) | (np.diff(contig) != 0)) + 1
        for a, b in zip(np.append(0, change), np.append(change, len(bins)), strict=True):
            if len(bins) and contig[a] >= 0:
                chunks = self.contigs[contig[a]].bins.setdefault(int(bins[a]), [])
                if chunks and chunks[-1][1] >> 16 == int(offsets[a]) >> 16:  # goes on in the same block
                    chunks[-1] = (chunks[-1][0], int(offsets[b]))
                else:
                    chunks.append((int(offsets[a]), int(offsets[b])))
        first, last = start >> SHIFT, (np.maximum(end, start + 1) - 1) >> SHIFT
        wide = last - first + 1
        which = np.repeat(np.arange(len(start)), wide)
        window = np.repeat(first, wide) + np.arange(len(which)) - np.repeat(np.cumsum(wide) - wide, wide)
        key, at = np.unique(contig[which].astype(np.int64) << 32 | window, return_index=True)  # the first record that reaches into each
        for k, w in zip(key.tolist(), which[at].tolist(), strict=True):
            if contig[w] >= 0:
                self.contigs[k >> 32].windows.setdefault(k & 0xFFFFFFFF, int(offsets[w]))

    def chunks(self, contig: int, start: int, end: int) -> list[tuple[int, int]]:
        """Ranges of virtual offsets that hold all records that overlap a region; neighbours in one block are one range."""
        c = self.contigs[contig]
        before = [w for w in c.windows if w <= max(0, start) >> SHIFT]
        least = c.windows[max(before)] if before else 0
        out: list[tuple[int, int]] = []
        for a, b in sorted(x for k in bins_over(start, end) for x in c.bins.get(k, [])):
            if b <= least:
                continue
            if out and a >> 16 <= out[-1][1] >> 16:
                out[-1] = (out[-1][0], max(out[-1][1], b))
            else:
                out.append((max(a, least), b))
        return out

    def written(self) -> bytes:
        out = [struct.pack("<i", len(self.contigs))]
        for c in self.contigs:
            out.append(struct.pack("<i", len(c.bins)))
            for k, chunks in sorted(c.bins.items()):
                out.append(struct.pack(f"<Ii{2 * len(chunks)}Q", k, len(chunks), *(x for chunk in chunks for x in chunk)))
            most = max(c.windows, default=-1) + 1
            offsets, last = [], 0
            for w in range(most):
                last = c.windows.get(w, last)
                offsets.append(last)
            out.append(struct.pack(f"<i{most}Q", most, *offsets))
        return b"".join(out)

    @classmethod
    def read(cls, raw: bytes, at: int, summary: int = LEAST[LEVELS] + (1 << 3 * LEVELS) + 1) -> Index:
        """From the number of contigs on; the bin ``summary`` holds counts, no chunks."""
        n = int.from_bytes(raw[at : at + 4], "little")
        at += 4
        out = cls(n)
        for c in out.contigs:
            n_bins = int.from_bytes(raw[at : at + 4], "little")
            at += 4
            for _ in range(n_bins):
                k, m = struct.unpack_from("<Ii", raw, at)
                flat = struct.unpack_from(f"<{2 * m}Q", raw, at + 8)
                at += 8 + 16 * m
                if k != summary:
                    c.bins[k] = list(zip(flat[::2], flat[1::2], strict=True))
            n_windows = int.from_bytes(raw[at : at + 4], "little")
            c.windows = dict(enumerate(struct.unpack_from(f"<{n_windows}Q", raw, at + 4)))
            at += 4 + 8 * n_windows
        return out


def pieces(blocks: Blocks, begin: int, end: int, cut, tail: bytes = b"", least: int = 4 << 20) -> Iterator[tuple[bytes, np.ndarray]]:
    """Whole records that begin between two virtual offsets, as bytes and the places where records begin in these and where the last ends.

    ``cut(data, at, limit)`` gives the places of the whole records that begin from ``at`` on and below ``limit``, and where the first one begins that isn't whole.
    ``tail`` ends the last record of a file that lacks it.
    """
    at, skip, held = begin >> 16, begin & 0xFFFF, b""
    stop, inner = end >> 16, end & 0xFFFF
    while at < min(stop + (inner > 0), blocks.size):
        data, places, offsets, at = blocks.stretch(at, stop + (inner > 0), least)
        data = held + data
        limit = len(held) + int(offsets[-1]) + inner if inner and places[-1] == stop else len(data)
        starts, rest = cut(data, skip, limit)
        final = at >= min(stop + (inner > 0), blocks.size)
        while final and rest < limit:  # a record that ends beyond
            if at < blocks.size:
                more, at = blocks.get(at)
                data += more
            elif tail and not data.endswith(tail):
                data += tail
            else:
                break
            starts, rest = cut(data, skip, limit)
        if len(starts):
            yield data, np.append(starts, rest)
        if final:
            if rest < limit:
                raise ValueError("the last record isn't whole")
            return
        held, skip = data[rest:], 0
