"""Secret scan with DataFrame functions only: three patterns, and strings of high sliding-window entropy.

Positions come from marking matches: each match is put between two control characters, the text is split at these, and
the lengths of the pieces add up to the places of the matches. Control characters that the text itself holds are first replaced
by a third one, which no pattern matches, so that all positions stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the patterns of the contract; the minimum lengths of access and hex stand in the pattern, as runs are matched whole
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# candidate strings for entropy: whole runs of 20 or more characters
RUN = "[A-Za-z0-9+/_=-]"
CANDIDATE = f"(?<!{RUN}){RUN}{{20,}}"
WINDOW = 20
# bits a character within a window of 20: random hexadecimal has about 3.3, random base 64 about 4.1, random letters of one case about 3.6
# and of both 3.9. A window's class is that of the stretch it lies in; PLAIN is for runs without a digit, mostly paths and joined words
HEX_BITS, CASE_BITS, LETTER_BITS, BASE64_BITS, PLAIN_BITS = 3.0, 3.5, 3.8, 3.75, 3.9
CLASSES = (("[0-9A-Fa-f]{20,}", HEX_BITS), ("[a-z]{20,}|[A-Z]{20,}", CASE_BITS), ("[A-Za-z]{20,}", LETTER_BITS))
# allow-list, for the part between '/' and '=' that holds it: placeholders, counting sequences, UUIDs. Digits alone and one repeated unit have no limit to reach
WORDS = r"example|sample|dummy|placeholder|redacted|changeme|0123456789|1234567890|abcdefghij|xxxxx"
UUID = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
ALLOWED = rf"(?i)(?<![^/=])(?:{UUID}(?![^/=])|[^/=]*(?:{WORDS})[^/=]*)"
KINDS = ("assign", "access", "hex", "entropy")
LEFT, RIGHT, OTHER = "\x01", "\x02", "\x03"
STEP = 256


def marked(text: Column, pattern: str) -> Column:
    """Pieces of the text: every second one is a match."""
    pieces = F.split(F.regexp_replace(text, pattern, f"{LEFT}$0{RIGHT}"), f"[{LEFT}{RIGHT}]", -1)
    return F.when(text.rlike(pattern), pieces).otherwise(F.array(text))  # most texts hold no match and need no splitting


def added(lengths: Column, sums: Column, n: Column) -> Column:
    """Sum of the first n lengths, from sums of blocks of STEP."""
    whole = F.floor(n / STEP).cast("int")
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)
    return total(F.slice(sums, F.lit(1), whole)) + total(F.slice(lengths, whole * STEP + 1, n - whole * STEP))


def placed(pieces: Column, lengths: Column, sums: Column, order: int, keep) -> Column:
    """Array of (begin, kind, end) of the matches that ``keep`` holds for."""

    def one(k: Column) -> Column:
        at = added(lengths, sums, 2 * k + 1)
        return F.struct(at.alias("begin"), F.lit(order).alias("kind"), (at + F.get(lengths, 2 * k + 1)).alias("end"), F.get(pieces, 2 * k + 1).alias("match"))

    n = F.size(pieces)
    found = F.transform(F.sequence(F.lit(0), F.floor(n / 2).cast("int") - 1), one)
    kind = "array<struct<begin: int, kind: int, end: int>>"
    trim = F.transform(F.filter(found, lambda x: keep(x["match"])), lambda x: F.struct(x["begin"].alias("begin"), x["kind"].alias("kind"), x["end"].alias("end")))
    return F.when(n > 1, trim).otherwise(F.array().cast(kind))


def weight(n: Column) -> Column:
    return F.when(n > 0, n * F.log2(F.greatest(n, F.lit(1)))).otherwise(F.lit(0.0))


def top_entropy(s: Column) -> Column:
    """Largest Shannon entropy of a window of WINDOW characters, from counts that each step changes by one in and one out."""
    # as elements of an array of one, characters and letters are made once and not at each step
    chars = F.transform(F.array(F.split(s, "(?!^)(?!$)")), lambda x: F.struct(x.alias("chars"), F.array_distinct(x).alias("letters")))
    return F.get(F.transform(chars, lambda c: _top_entropy(c["chars"], c["letters"])), F.lit(0))


def _top_entropy(chars: Column, letters: Column) -> Column:
    count = lambda st, j: F.coalesce(F.get(st["counts"], j), F.lit(0))

    def step(state: Column, i: Column) -> Column:
        new = F.array_position(letters, F.get(chars, i)).cast("int") - 1
        old = F.when(i >= WINDOW, F.array_position(letters, F.get(chars, i - WINDOW)).cast("int") - 1).otherwise(F.lit(-1))
        same = new == old
        a, b = count(state, new), count(state, old)
        change = weight(a + 1) - weight(a) + F.when(old >= 0, weight(b - 1) - weight(b)).otherwise(F.lit(0.0))
        total = state["total"] + F.when(same, F.lit(0.0)).otherwise(change)
        counts = F.transform(state["counts"], lambda x, j: x + F.when(j == new, 1).otherwise(0) - F.when(j == old, 1).otherwise(0))
        bits = F.when(i >= WINDOW - 1, F.log2(F.lit(float(WINDOW))) - total / WINDOW).otherwise(F.lit(0.0))
        return F.struct(counts.alias("counts"), total.alias("total"), F.greatest(state["best"], bits).alias("best"))

    start = F.struct(F.array_repeat(F.lit(0), F.size(letters)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
    return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), start, step, lambda st: st["best"])


def suspicious(s: Column) -> Column:
    """Whether a candidate string has, outside of the parts on the allow-list, a window above the limit of the window's character class."""
    left = F.when(s.rlike(ALLOWED), F.regexp_replace(s, ALLOWED, OTHER)).otherwise(s)

    def above(pattern: str, bits: Column | float) -> Column:
        return F.exists(F.regexp_extract_all(left, F.lit(pattern), F.lit(0)), lambda x: x.rlike("[A-Za-z]") & (top_entropy(x) >= bits))

    found = above(f"{RUN}{{20,}}", F.when(s.rlike("[0-9]"), BASE64_BITS).otherwise(PLAIN_BITS))
    for pattern, bits in CLASSES:
        found = found | above(pattern, bits)
    return found


def joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["begin"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Add n_assign, n_access, n_hex, n_entropy, base_sha256, spans and found (sorted array of begin, kind, end) to rows (doc_id, text, more).

    An entropy span is a whole run of 20 or more letters, digits and '+/_=-' that holds a window of 20 characters above the limit of its
    class: hexadecimal, letters of one case, letters, others (more bits in runs without a digit); parts on the allow-list are left out.

    Positions count code points of the whole text, ends exclusive. Null and empty texts have no spans (base_sha256 of the empty
    string). Repeated rows are scanned each; other columns stay as they are, but those of the added names are replaced. An empty table gives no rows.
    """
    plain = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), LEFT + RIGHT, OTHER + OTHER)
    names = docs.columns
    out = docs.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), plain.alias("plain"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
    out = out.withColumns({f"p_{k}": marked(F.col("plain"), p) for k, p in patterns.items()})
    out = out.withColumns({f"l_{k}": F.transform(f"p_{k}", F.length) for k in KINDS})
    blocks = lambda lengths: F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / STEP).cast("int")), lambda b: F.aggregate(F.slice(lengths, b * STEP + 1, F.lit(STEP)), F.lit(0), lambda a, x: a + x))
    out = out.withColumns({f"b_{k}": blocks(F.col(f"l_{k}")) for k in KINDS})
    everything = lambda s: F.lit(True)
    keeps = {"assign": lambda s: F.length(F.regexp_extract(s, ASSIGN, 2)) >= ASSIGN_LEAST, "access": everything, "hex": everything, "entropy": suspicious}
    out = out.withColumns({f"s_{k}": placed(F.col(f"p_{k}"), F.col(f"l_{k}"), F.col(f"b_{k}"), i, keeps[k]) for i, k in enumerate(KINDS)})
    out = out.withColumn("base", F.concat("s_assign", "s_access", "s_hex"))
    added_columns = {f"n_{k}": F.size(f"s_{k}").cast("long") for k in KINDS} | {"base_sha256": F.sha2(joined(F.col("base")), 256), "spans": joined(F.concat("base", "s_entropy")), "found": F.array_sort(F.concat("base", "s_entropy"))}
    return out.select(*(F.col("row").getField(c).alias(c) for c in names if c not in added_columns), *(v.alias(k) for k, v in added_columns.items()))


def redacted(text: Column, found: Column, by: str = "[REDACTED]") -> Column:
    """The text with each stretch of overlapping spans replaced by ``by``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        fresh = x["begin"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], F.substring(text, state["at"] + 1, x["begin"] - state["at"]), F.lit(by))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(found, start, step)
    return F.when(F.size(found) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)


def redact(docs: DataFrame, by: str = "[REDACTED]") -> DataFrame:
    """All rows of ``docs`` with all columns whatever their names, secrets in text replaced by ``by``; n_chars, where there is one, follows a changed text.

    Texts without secrets, nulls and empties among them, stay as they are. Repeated rows come back each.
    """
    found = scan(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text")))
    some = F.size("found") > 0
    changed = redacted(F.col("text").cast("string"), F.col("found"), by)

    def column(c: str) -> Column:
        was = F.col("row").getField(c)
        if c == "text":
            return F.when(some, changed).otherwise(was)
        return F.when(some, F.length(changed).cast(docs.schema[c].dataType)).otherwise(was) if c == "n_chars" else was

    return found.select(*(column(c).alias(c) for c in docs.columns))
