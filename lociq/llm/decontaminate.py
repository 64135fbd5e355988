"""Benchmark decontamination by spaced seeds: fixed masks over tokens, hash joins, and verified overlaps that tolerate substitutions."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import TEXT_BLOCK, U64, WordHasher, ascii_lower, mix64, release, row_blocks, staged, utf8

# fixed values: positions of a token window that a seed compares; the others are ignored. MASKS hit every stretch of 13 to 25 tokens of
# which 3 of 4 agree, so every longer one too, as it can be cut into pieces of these lengths and one piece has the share of the whole. For items of fewer
# tokens, by least length, the masks hit every such whole item that begins and ends with a match. A test enumerates the patterns.
MASKS = ("111011", "1100001011", "10011000011", "1010000111")
MASKS_OF_SHORT = {8: ("11101", "1010011", "11000011"), 5: ("11101", "11011", "10111")}
PIECE, LONGEST_PIECE, LEAST_SHARE = 13, 25, 0.75
NEAR = 8192  # hits whose surroundings are compared at once
SHORTEST = 5  # items of fewer tokens are too common to search

# letters of scripts written without spaces, each of which is a token, and the punctuation of these scripts
UNSPACED = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}])|[\u3000-\u303F\u30FB\uFF01-\uFF0F\uFF1A-\uFF20\uFF3B-\uFF40\uFF5B-\uFF65]"

# ranges that hold all of these: most texts hold none and are done with after this cheaper search
UNSPACED_RANGES = r"[\u0E00-\u109F\u1780-\u17FF\u19E0-\u19FF\u2E80-\u9FFF\uA9E0-\uA9FF\uAA60-\uAA7F\uF900-\uFAFF\uFF01-\uFF9F\x{16F00}-\x{16FFF}\x{1AFF0}-\x{1B16F}\x{1F200}-\x{1F2FF}\x{20000}-\x{3FFFF}]"


def searched(text: Column) -> Column:
    """The text as it is cut into tokens: in lower case, with spaces around letters of scripts without spaces."""
    low = F.lower(text.cast("string"))
    return F.when((F.octet_length(low) > F.length(low)) & low.rlike(UNSPACED_RANGES), F.regexp_replace(low, UNSPACED, " $1 ")).otherwise(low)


def _separators() -> np.ndarray:
    out = np.ones(256, bool)
    out[128:] = False
    out[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
    return out


@functools.cache
def hasher() -> WordHasher:
    return WordHasher(ascii_lower(), _separators())


def offsets_of(mask: str) -> np.ndarray:
    return np.array([i for i, c in enumerate(mask) if c == "1"])


def seed_hashes(token: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the masked tokens from each position on; positions that lack room are left out."""
    n = max(0, len(token) - len(mask) + 1)
    out = np.full(n, U64(int(mask, 2) * 2 + 1))
    for j in offsets_of(mask):
        out = mix64(out * U64(0x9E3779B97F4A7C15) + token[j : j + n])
    return out


def masks_of(n: int) -> tuple[str, ...]:
    """Masks for an item of n tokens."""
    return MASKS if n >= PIECE else MASKS_OF_SHORT[max(k for k in MASKS_OF_SHORT if k <= n)]


class Seeds:
    """Seeds of a block of benchmark items, sorted by hash, one array for each mask. Short items have masks of their own."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [i for i, _ in items]
        self.tokens = [t for _, t in items]
        self.length = np.array([len(t) for t in self.tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.flat = np.concatenate([np.zeros(0, U64), *self.tokens])
        by_mask: dict[str, list] = {}
        for k, t in enumerate(self.tokens):
            for m in masks_of(len(t)):
                h = seed_hashes(t, m)
                by_mask.setdefault(m, []).append((h, np.full(len(h), k), np.arange(len(h))))
        self.masks = []
        for m, parts in by_mask.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            shift = U64(64 - max(16, int(8 * len(h)).bit_length()))
            flags = np.zeros(1 << (64 - int(shift)), bool)
            flags[h >> shift] = True
            self.masks.append((m, h[order], item[order], at[order], shift, flags))

    def hits(self, token: np.ndarray, row: np.ndarray, share: float) -> np.ndarray:
        """Distinct (item, diagonal, row) of seed hits; the diagonal is token position minus item position. Seeds stay within a row.

        A hit stays if the tokens about it, as far as a piece that holds the seed can reach, agree as often as a piece (or whole short item) must.
        """
        found = [np.zeros((3, 0), np.int64)]
        for m, h, item, at, shift, flags in self.masks:
            x = seed_hashes(token, m)
            p = np.flatnonzero(flags[x >> shift])  # most seeds end here, before the search
            p = p[row[p] == row[p + len(m) - 1]]
            first = np.searchsorted(h, x[p])
            same = h[np.minimum(first, len(h) - 1)] == x[p]
            p, first = p[same], first[same]
            n = np.searchsorted(h, x[p], side="right") - first
            k = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            p = np.repeat(p, n)
            found += [self._near(token, row, item[k[i : i + NEAR]], p[i : i + NEAR], at[k[i : i + NEAR]], share) for i in range(0, len(k), NEAR)]
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def _near(self, token: np.ndarray, row: np.ndarray, item: np.ndarray, p: np.ndarray, at: np.ndarray, share: float) -> np.ndarray:
        length, start = self.length[item], self.start[item]
        agree = np.zeros(len(p), np.int64)
        for j in range(SHORTEST - LONGEST_PIECE, LONGEST_PIECE):
            here, there = np.clip(p + j, 0, len(token) - 1), np.clip(at + j, 0, length - 1)
            agree += (token[here] == self.flat[start + there]) & (here == p + j) & (there == at + j) & (row[here] == row[p])
        keep = agree >= np.ceil(share * np.minimum(length, PIECE) - 1e-9)
        return np.stack([item, p - at, row[p]])[:, keep]


def best_stretch(same: np.ndarray, share: float) -> tuple[int, int, int]:
    """Longest stretch of aligned tokens that begins and ends with a match and has at least ``share`` of matches: begin, end, matches."""
    total = np.concatenate([[0], np.cumsum(same)])
    # a stretch [i, j) qualifies if g[j] >= g[i]
    g = total - share * np.arange(len(total))
    best = (0, 0, 0)
    low = np.minimum.accumulate(np.where(same, g[:-1], np.inf))
    for j in range(len(total) - 1, 0, -1):
        if j <= best[1] - best[0]:
            break
        if same[j - 1]:
            i = int(np.searchsorted(-low, -(g[j] + 1e-9), side="left"))
            if i < j and j - i > best[1] - best[0]:
                best = (i, j, int(total[j] - total[i]))
    return best


def matches(seeds: Seeds, buf: np.ndarray, offsets: np.ndarray, least: int, share: float) -> dict[tuple[int, int], tuple[int, int, int]]:
    """Best stretch (matched, begin, end) of each (row, item) that overlaps."""
    if least < PIECE or share < LEAST_SHARE:
        raise ValueError(f"the seeds find every overlap from {PIECE} tokens and a share of {LEAST_SHARE} on, not below")
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for i, j in row_blocks(offsets, TEXT_BLOCK):
        row, _, _, token = hasher().words(buf[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        first = np.searchsorted(row, np.arange(j - i + 1))
        for item, d, r in seeds.hits(token, row, share).T.tolist():
            want = seeds.tokens[item]
            lo, hi = max(d, int(first[r])), min(d + len(want), int(first[r + 1]))
            begin, end, n = best_stretch(token[lo:hi] == want[lo - d : hi - d], share)
            if end - begin >= min(least, len(want)) and n > found.get((i + r, item), (0,))[0]:
                found[i + r, item] = (n, lo - int(first[r]) + begin, lo - int(first[r]) + end)
    return found


def _scan(items: list[tuple[int, np.ndarray]], least: int, share: float):
    seeds = Seeds(items)

    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            ids = batch.column("doc_id").to_pylist()
            out = [{"doc_id": ids[r], "item_id": seeds.ids[item], "begin": b, "end": e, "matched": n, "item_tokens": len(seeds.tokens[item])} for (r, item), (n, b, e) in sorted(matches(seeds, buf, off, least, share).items())]
            yield pa.RecordBatch.from_pylist(out, FOUND)

    return run


def _kept(items: list[tuple[int, np.ndarray]], least: int, share: float):
    """Rows without an overlap; the searched text is the last column, which goes."""
    seeds = Seeds(items)

    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column(batch.num_columns - 1))
            keep = np.ones(batch.num_rows, bool)
            keep[[r for r, _ in matches(seeds, buf, off, least, share)]] = False
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(keep))

    return run


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("matched", pa.int64()), ("item_tokens", pa.int64())])
FOUND_DDL = "doc_id long, item_id long, begin long, end long, matched long, item_tokens long"


def _item_tokens(batches):
    for batch in batches:
        buf, off = utf8(batch.column("text"))
        for i, j in row_blocks(off, TEXT_BLOCK):
            row, _, _, token = hasher().words(buf[off[i] : off[j]], off[i : j + 1] - off[i])
            first = np.searchsorted(row, np.arange(j - i + 1))
            yield pa.RecordBatch.from_pydict({"item_id": batch.column("item_id").slice(i, j - i), "tokens": pa.array([token[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())})


def item_blocks(benchmark: DataFrame, block_tokens: int):
    """Items as (item_id, tokens) in blocks of at most ``block_tokens`` tokens, one empty block at least."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), searched(F.col("text")).alias("text"))
    block, size, any_block = [], 0, False
    for r in items.mapInArrow(_item_tokens, "item_id long, tokens binary").toLocalIterator():  # an item at a time
        token = np.frombuffer(bytes(r["tokens"]), U64)
        if len(token) < SHORTEST:
            continue
        if block and size + len(token) > block_tokens:
            yield block
            block, size, any_block = [], 0, True
        block.append((r["item_id"], token))
        size += len(token)
    if block or not any_block:
        yield block


def overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.75, block_tokens: int = 1_000_000) -> DataFrame:
    """Verified overlaps of ``docs`` (doc_id, text, more) with ``benchmark`` (item_id, text, more), one row for each pair of a document and an item.

    A row tells doc_id, item_id, begin and end (token positions in the document), matched and item_tokens of the best stretch.
    Tokens are runs of letters and digits in lower case, and single characters in scripts without spaces. A pair counts if aligned tokens hold a stretch of ``least`` tokens (or of the whole
    item, if that is shorter) that begins and ends with a match and of which ``share`` agree; the seeds leave out none of these, for which ``least`` must be
    13 and ``share`` 0.75 at the least. Items go to the tasks in blocks of at most ``block_tokens`` tokens, each with
    one scan of all documents, one after another, so that what is held and sent has a fixed bound whatever the benchmark's size. Documents are never shuffled, and long ones are read whole.

    Nulls, empty texts and items of under five tokens overlap with nothing. Repeated rows give repeated rows. Empty tables give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), searched(F.col("text")).alias("text"))
    out = last = None
    for block in item_blocks(benchmark, block_tokens):
        if last is not None:  # done before the next block's seeds are made, so the driver holds those of one block
            done = staged(last, "overlaps")
            out = done if out is None else out.unionByName(done)
        last = docs.mapInArrow(_scan(block, least, share), FOUND_DDL)
    return last if out is None else out.unionByName(last)


def without_overlaps(docs: DataFrame, benchmark: DataFrame, least: int = 13, share: float = 0.75, block_tokens: int = 1_000_000) -> DataFrame:
    """The rows of ``docs``, with all columns whatever their names, that overlap with no item (see ``overlaps``); null and empty texts stay.

    Where the benchmark has several blocks, what each leaves is written before the next one reads it.
    """
    searched_text = "searched text"
    while searched_text in docs.columns:
        searched_text += "_"
    last = None
    for k, block in enumerate(item_blocks(benchmark, block_tokens)):
        if k:
            docs = staged(docs, "clean")
            if last is not None:
                release(last)
            last = docs
        low = docs.select("*", searched(F.col("text")).alias(searched_text))
        docs = low.mapInArrow(_kept(block, least, share), docs.schema)
    return docs


def contaminated(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """One row for each document with an overlap (see ``overlaps``): doc_id, item_ids (sorted), n_items, best_matched. Repeated rows count as one document."""
    found = overlaps(docs, benchmark, **limits).groupBy("doc_id")
    return found.agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.count_distinct("item_id").alias("n_items"), F.max("matched").alias("best_matched"))
