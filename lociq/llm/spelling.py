"""Spelling variants: words one edit apart, found by merging the light subtrees of the words' trie into what stands beside them.

A node of the trie is a beginning of words, its heavy child the one with most words below it. Where two words are one edit apart, one of them leaves the
heavy path at the node of the edit (or ends there), so only light words move: with the letter skipped they meet the other light words of the node, with it replaced by the
heavy letter, left out, or preceded by the heavy letter they are looked up among all words. A word leaves a heavy path at most log2(words) times, as
each time at least half of the words stay behind, so what moves is small-to-large: words times their logarithm. Terminals that coincide are pairs one edit
apart, each found once. Nodes are 128-bit hashes of beginnings; counts, merges and look-ups are Spark aggregations and joins.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import release, staged

EVERY = 199  # of hashes, one is a misprint
SHORTEST = 6  # code points of a word
LEAST = 5  # occurrences of a word, and how many times as frequent its form is
KEPT = 200_000  # words that a task counts before it hands them on
BLOCK = 50_000  # rows of an Arrow batch that a task hands on
END = -1  # stands for the letter where a word ends
SKIPPED = "*"  # stands for a skipped letter; no letter of a word


def _counted(every: int, shortest: int):
    """mapInArrow function from (id, text) to (word, n), words counted within the task as far as ``KEPT`` of them."""
    run_of = re.compile(rb"[a-z\xc0-\xff]{%d,}" % shortest).findall  # runs are maximal; shorter ones can't become words

    def handed(count: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array([w.decode("latin-1") for w in count], pa.string()), "n": pa.array(list(count.values()), pa.int64())})

    def run(batches):
        count: Counter = Counter()
        for batch in batches:
            for k in range(batch.num_rows):
                seed = zlib.crc32(f"{batch.column(0)[k].as_py()}:".encode())
                # a byte for each code point; those beyond the letters' range become "?"
                for word, n in Counter(run_of(batch.column(1)[k].as_py().encode("latin-1", "replace").lower())).items():
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), seed)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    if len(word) >= shortest:
                        count[word] += n
                if len(count) >= KEPT:
                    yield handed(count)
                    count.clear()
        if count:
            yield handed(count)

    return run


def _named(batches):
    for batch in batches:
        name = np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=16).digest() for w in batch.column("word").to_pylist()), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(name[:, 0]), pa.array(name[:, 1])], ["word", "n", "id", "id2"])


def word_counts(docs: DataFrame, every: int = EVERY, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """Words of whole texts with their number of occurrences (word, n) and the halves of a 128-bit name (id, id2).

    Words are the maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, of ``shortest`` code points or more and seen ``least`` times or more.
    Where ``every`` divides the CRC-32 of doc_id:run, the run loses its code point at CRC modulo length. A null doc_id counts as an empty one, a null text as none.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("string").alias("text")).where("text is not null")
    counted = texts.mapInArrow(_counted(every, shortest), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return counted.mapInArrow(_named, "word string, n long, id long, id2 long")


def _edges(batches):
    """Each word's way through the trie: node, letter that follows (END where the word ends), the word's name, depth."""
    columns = ["node", "node2", "letter", "id", "id2", "at"]

    def block(nodes: list[bytes], rest: list[tuple]) -> pa.RecordBatch:
        node, other = np.frombuffer(b"".join(nodes), np.int64).reshape(-1, 2), np.array(rest, np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays([pa.array(node[:, 0]), pa.array(node[:, 1]), *(pa.array(other[:, k]) for k in range(4))], columns)

    nodes: list[bytes] = []
    rest: list[tuple] = []
    for batch in batches:
        for word, a, b in zip(*(batch.column(c).to_pylist() for c in ("word", "id", "id2")), strict=True):
            way = hashlib.blake2b(digest_size=16)
            for at, letter in enumerate(word):
                nodes.append(way.copy().digest())
                rest.append((ord(letter), a, b, at))
                way.update(letter.encode())
                if len(rest) >= BLOCK:
                    yield block(nodes, rest)
                    nodes, rest = [], []
            nodes.append(way.digest())
            rest.append((END, a, b, len(word)))
    if rest:
        yield block(nodes, rest)


def _moved(batches):
    """Of each word and node where it leaves the heavy path (lights: depth and heavy letter): what it becomes (key, skipped or not)."""
    for batch in batches:
        keys, skipped, of = [], [], []

        def move(key: str, skip: bool, k: int, keys=keys, skipped=skipped, of=of) -> None:
            keys.append(key)
            skipped.append(skip)
            of.append(k)

        def block(batch=batch, keys=keys, skipped=skipped, of=of) -> pa.RecordBatch:
            part = batch.take(pa.array(of, pa.int64()))
            out = pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(skipped), part.column("word"), part.column("n")], ["key", "skipped", "word", "n"])
            for x in (keys, skipped, of):
                x.clear()
            return out

        for k, (word, lights) in enumerate(zip(batch.column("word").to_pylist(), batch.column("lights").to_pylist(), strict=True)):
            for light in lights:
                at, heavy = light["at"], chr(light["heavy"])
                head, tail = word[:at], word[at + 1 :]
                move(head + heavy + word[at:], False, k)
                if at < len(word):
                    move(head + SKIPPED + tail, True, k)
                    move(head + heavy + tail, False, k)
                    if tail[:1] != word[at]:  # of equal letters in a row, the last one goes
                        move(head + tail, False, k)
            if len(of) >= BLOCK:
                yield block()
        if of:
            yield block()


def near_words(words: DataFrame) -> DataFrame:
    """Of each word that has near words: word, n_near (their number), best (struct of minus n and word of the most frequent one, ties by code points).

    ``words`` has word, n and the names of ``word_counts``, each word once. Two words are near if one inserted, deleted or replaced code point tells them apart.
    """
    edges = words.mapInArrow(_edges, "node long, node2 long, letter long, id long, id2 long, at long")
    child = edges.groupBy("node", "node2", "letter").agg(F.count("*").alias("below"))
    letter = F.when(F.col("letter") != END, F.struct("below", -F.col("letter"), "letter"))
    node = child.groupBy("node", "node2").agg(F.sum("below").alias("words"), F.max(letter).getField("letter").alias("heavy"))
    heavy = staged(node.where("words > 1 and heavy is not null").drop("words"), "heavy-children")  # written, so that a join can split the words of one node
    light = edges.join(heavy, ["node", "node2"]).where("letter <> heavy").groupBy("id", "id2").agg(F.collect_list(F.struct("at", "heavy")).alias("lights"))  # log2(words) at most
    moved = staged(words.join(light, ["id", "id2"]).select("word", "n", "lights").mapInArrow(_moved, "key string, skipped boolean, word string, n long"), "light-words")
    release(heavy)
    rank = lambda word, n: F.struct((-F.col(n)).alias("less"), F.col(word).alias("word"))
    # light words that coincide with a letter skipped: one for each letter of the alphabet at most
    group = moved.where("skipped").groupBy("key").agg(F.sort_array(F.collect_list(rank("word", "n"))).alias("all")).where("size(all) > 1")
    met = group.select(F.explode("all").alias("own"), "all").select("own.word", (F.size("all") - 1).cast("long").alias("n_near"), F.when(F.col("own.word") == F.col("all")[0]["word"], F.col("all")[1]).otherwise(F.col("all")[0]).alias("best"))
    pair = moved.where("not skipped").join(words.select(F.col("word").alias("key"), F.col("n").alias("n_key")), "key")
    one = F.lit(1).cast("long").alias("n_near")
    both = pair.select("word", one, rank("key", "n_key").alias("best")).unionByName(pair.select(F.col("key").alias("word"), one, rank("word", "n").alias("best")))
    return met.unionByName(both).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """The last form of each word (word, root), by pointer doubling over ``forms`` (word, form): a form is several times as frequent as its word, so a chain is short."""
    up = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(up.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(up)
        up = moved.drop("moved")
        up._staged_at = moved._staged_at
        if not moved.where("moved").limit(1).count():
            return up


def variants(docs: DataFrame, every: int = EVERY, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """Words with the form that they are a variant of: word, n, n_near, form, form_n, root.

    The form is the most frequent near word (ties: the smallest by code points), if it is at least ``least`` times as frequent; the root is where forms lead. Repeated rows
    count each time. Empty tables, null and empty texts have no words; texts are read whole, and words may be of any length.
    """
    words = staged(word_counts(docs, every, shortest, least), "words")
    near = words.select("word", "n").join(near_words(words), "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))
    fits = -F.col("best.less") >= least * F.col("n")
    near = staged(near.select("word", "n", "n_near", F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "near-words")
    root = roots(near.where("form is not null"))
    return near.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
