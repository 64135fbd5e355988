"""Column expressions over aligned reads and sequences."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def clip_at(cigar: Column, end: Column) -> Column:
    """Bases hard- or soft-clipped at the last (``end``) or first operation, 0 if it is another one."""
    last, first = F.regexp_extract(cigar, r"([0-9]+)[HS]$", 1), F.regexp_extract(cigar, r"^([0-9]+)[HS]", 1)
    found = F.when(end, last).otherwise(first)
    return F.when(found == "", 0).otherwise(F.try_to_number(found, F.lit("999999999")).cast("int"))


def is_reference_read(cigar: Column, mate_cigar: Column, forward: Column, proper: Column, contig: Column) -> Column:
    """Whether a read fits the reference. Read 1 looks at its mate's CIGAR and needs a proper pair; contigs look at their own, at the other end."""
    own = clip_at(cigar, forward) < 30
    mate = proper & (clip_at(mate_cigar, forward) < 30)
    return F.when(contig, own).otherwise(F.coalesce(mate, F.lit(False)))


def longest_run(s: Column, base: str) -> Column:
    return F.coalesce(F.array_max(F.transform(F.regexp_extract_all(s, F.lit(f"({base}+)"), F.lit(1)), F.length)), F.lit(0))


def clipped_run(cigar: Column, seq: Column, read2: Column, reverse: Column) -> tuple[Column, Column]:
    """Length of the soft clip at the 5' end of read 2 or the 3' end of read 1, and its longest run of A (T, if both flags agree)."""
    first = read2 != reverse
    n = F.regexp_extract(cigar, r"^([0-9]+)S", 1)
    m = F.regexp_extract(cigar, r"([0-9]+)S$", 1)
    length = F.when(first, n).otherwise(m)
    length = F.when(length == "", 0).otherwise(F.try_to_number(length, F.lit("999999999")).cast("int"))
    piece = F.when(first, F.substring(seq, F.lit(1), length)).otherwise(F.substring(seq, F.length(seq) - length + 1, length))
    run = F.when(read2 != reverse, longest_run(piece, "A")).otherwise(longest_run(piece, "T"))
    return length, F.when(length > 0, run).otherwise(0)


def cigar_operations(cigar: Column) -> Column:
    return F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1))


def count_of(s: Column, base: str) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(base), F.lit("")))


def supplementary(sa: Column) -> Column:
    """Number of supplementary alignments in an SA tag."""
    return F.coalesce(F.size(F.split(sa, ";")) - 1, F.lit(0))


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGTNacgtn", "TGCANtgcan"))


def motif_scores(seq: Column, weights: list[dict[str, float]]) -> Column:
    """Score of the motif at each position; other characters score 0."""
    k = len(weights)
    table = F.create_map(*(x for i, w in enumerate(weights) for b, v in w.items() for x in (F.lit(f"{i}{b}"), F.lit(float(v)))))

    def at(i: Column) -> Column:
        total = F.lit(0.0)
        for j in range(k):
            total = total + F.coalesce(table[F.concat(F.lit(str(j)), F.substring(seq, i + j, F.lit(1)))], F.lit(0.0))
        return total

    return F.when(F.length(seq) >= k, F.transform(F.sequence(F.lit(1), F.length(seq) - k + 1), at)).otherwise(F.array().cast("array<double>"))


def motif_best(seq: Column, weights: list[dict[str, float]]) -> Column:
    """The highest of ``motif_scores``, null where the motif doesn't fit in: a batch of sequences is scored as one row of characters."""
    k = len(weights)
    table = np.zeros((k, 129))
    for j, w in enumerate(weights):
        for b, v in w.items():
            table[j, ord(b)] = v

    @F.pandas_udf("double")
    def best(texts: pd.Series) -> pd.Series:
        n = texts.str.len().fillna(0).to_numpy(np.int64)
        out = np.full(len(n), np.nan)
        fits = n >= k
        if fits.any():
            codes = np.minimum(np.frombuffer("".join(texts[fits]).encode("utf-32-le", "surrogatepass"), np.uint32), 128)
            score = np.zeros(len(codes) - k + 1)
            for j in range(k):
                score += table[j, codes[j : j + len(score)]]
            first = np.cumsum(n[fits]) - n[fits]
            bounds = np.stack([first, first + n[fits] - k + 1], 1).reshape(-1)  # windows over the end of a sequence fall between
            out[fits] = np.maximum.reduceat(np.append(score, -np.inf), bounds)[::2]
        return pd.Series(out).astype(object).where(fits, None)

    return best(seq)


def motif_weights(instances: list[str], background: float = 0.25, pseudo: float = 0.5) -> list[dict[str, float]]:
    """Log-odds weights from motif instances (cleavage marks '/' are dropped)."""
    import math

    clean = [s.replace("/", "") for s in instances]
    return [{b: math.log2((sum(s[i] == b for s in clean) + pseudo) / (len(clean) + 4 * pseudo) / background) for b in "ACGT"} for i in range(len(clean[0]))]
