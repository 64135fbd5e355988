"""Conversation repair: the cheapest edits that bring turns into the order of roles (s?(ua)+)?, by a tensor program over turns.

Turns are dealt by range of (conversation, turn) and sorted, so a conversation of any length spreads over tasks. Within an Arrow batch conversations of similar length form a bucket; the
costs of all its conversations in the four states (start, behind s, u, a) are updated together, one turn at a time from the last to the first, and stored; edits are
then traced forwards, for all of them at once. A conversation that a batch cuts becomes pieces: each yields its cost from every state to every
state (a 4 x 4 table), tables are chained by conversation, and pieces are traced once the costs behind them and the states before them are known.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import staged

DAMAGES = 20
HEAD = 64  # characters of a text that order turns of one number and role; beyond them the table's order holds
PIECE_ROWS = 8  # pieces of an Arrow batch
DELETE, REROLE, INSERT = 3, 2, 2
NEVER = 1 << 40
# states: 0 start, 1 behind s, 2 behind u, 3 behind a; letters: 0 s, 1 u, 2 a, 3 other
NEXT = np.array([[1, 2, -1, -1], [-1, 2, -1, -1], [-1, -1, 3, -1], [-1, 2, -1, -1]])
TO = np.array([2, 2, 3, 2])  # where a changed or inserted turn leads
CLOSING = np.array([0, 2 * INSERT, INSERT, 0])  # behind the last turn
LETTERS = "DIKR"
RAW = "raw array<struct<turn:long,role:string,text:string,blank:boolean,truncated:boolean,d1:long,d2:long>>"
TOTALS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
RESULT = "conv_id long, piece long, whole boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, turns array<struct<role:string,text:string>>"


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) with faults by CRC-32 of conv_id:turn modulo 20: 0 drops the turn (absent), 1 empties its text, 2 takes [.!?] out, 3 repeats it, 4 sets role user.

    A null counts as one space, also in the hashed string; conv_id and turn themselves stay null.
    """
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")), F.lit(DAMAGES))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain("text"), "[.!?]", "")).otherwise(plain("text"))
    out = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(kind == 4, "user").otherwise(plain("role")).alias("role"), text.alias("text"), (kind == 0).alias("absent"), kind.alias("kind"))
    return out.withColumn("kind", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind")


# ------------------------------------------------------------------------------------------ the tensor program


def settle(cost: np.ndarray) -> np.ndarray:
    """Costs (..., 4) once turns may be inserted."""
    out = cost.copy()
    out[..., 2] = np.minimum(cost[..., 2], INSERT + cost[..., 3])
    out[..., 3] = np.minimum(cost[..., 3], INSERT + cost[..., 2])
    for q in (0, 1):
        out[..., q] = np.minimum(cost[..., q], INSERT + out[..., 2])
    return out


class Bucket:
    """Conversations of similar length, turns first: letters, and which must go or are truncated, of each (turn, conversation)."""

    def __init__(self, rows: Rows, which: np.ndarray):
        self.n, self.at = rows.n[which], rows.offsets[which]
        self.most = int(self.n.max(initial=0))
        place = self.at + np.minimum(np.arange(self.most)[:, None], np.maximum(self.n - 1, 0))  # turns beyond a conversation's end aren't read
        self.letter, self.gone, self.truncated = rows.letter[place], rows.gone[place], rows.truncated[place]

    def options(self, t: np.ndarray | int, k: np.ndarray, q: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Costs of deleting, keeping and changing turn t in state q, where ``after`` (..., 4) follows."""
        take = lambda to: np.take_along_axis(after, np.broadcast_to(to, q.shape)[..., None], -1)[..., 0]
        letter, gone, more = self.letter[t, k], self.gone[t, k], self.truncated[t, k]
        to = NEXT[q, letter]
        keep = np.where(gone | (to < 0), NEVER, more + take(np.maximum(to, 0)))
        return DELETE + take(q), keep, np.where(gone, NEVER, REROLE + more + take(TO[q]))

    def backward(self, ends: np.ndarray) -> np.ndarray:
        """Costs (turn, conversation, 4) from before each turn on, where ``ends`` (conversation, 4) follows the last one."""
        back = np.empty((self.most + 1, len(self.n), 4), np.int64)
        back[self.most] = ends
        k = np.arange(len(self.n))
        for t in range(self.most - 1, -1, -1):
            new = np.stack([np.minimum.reduce(self.options(t, k, np.full(len(k), q), back[t + 1])) for q in range(4)], -1)
            back[t] = np.where((t < self.n)[:, None], settle(new), back[t + 1])
        return back

    def trace(self, back: np.ndarray, enters: np.ndarray):
        """Edits from the states ``enters`` on: exit states, and for each edit its conversation, letter, turn and new role (0 none, 1 user, 2 assistant), in order of step."""
        t, q, steps = np.zeros(len(self.n), np.int64), enters.copy(), []
        while len(k := np.flatnonzero(t < self.n)):
            now, at, here = back[t[k], k], t[k], q[k]
            cost = np.take_along_axis(now, here[:, None], 1)[:, 0]
            delete, keep, _ = self.options(at, k, here, back[at + 1, k])
            insert = INSERT + np.take_along_axis(now, TO[here][:, None], 1)[:, 0]
            code = np.select([delete == cost, insert == cost, keep == cost], [0, 1, 2], 3)  # ties: D < I < K < R
            steps.append((k, code, at, np.where(code % 2, np.where(here == 2, 2, 1), 0)))
            q[k] = np.choose(code, [here, TO[here], NEXT[here, self.letter[at, k]], TO[here]])
            t[k] += code != 1
        return q, steps


class Rows:
    """Turns of several conversations or pieces, one behind the other (``offsets``), with their faults."""

    def __init__(self, table, offsets: np.ndarray, duplicate: np.ndarray):
        column = lambda c: table[c].to_numpy(zero_copy_only=False)
        self.offsets, self.n = offsets[:-1], np.diff(offsets)
        self.role, self.text = table["role"], table["text"]
        self.letter = pc.fill_null(pc.index_in(pc.utf8_slice_codeunits(self.role, 0, 1), value_set=pa.array(["s", "u", "a"])), 3).to_numpy(zero_copy_only=False).astype(np.int64)
        self.blank = column("blank").astype(bool)
        self.duplicate = duplicate & ~self.blank
        self.gone = self.blank | self.duplicate
        self.truncated = column("truncated").astype(bool) & ~self.gone
        self.turn, self.no_turn = pc.fill_null(table["turn"], 0).to_numpy(zero_copy_only=False), pc.is_null(table["turn"]).to_numpy(zero_copy_only=False)
        self.ends = offsets[1:]

    def total(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return (sums[self.ends] - sums[self.offsets]).astype(np.int64)

    def facts(self) -> dict[str, np.ndarray]:
        """Of each piece: counts of faults, adjacent pairs of roles out of order, and the first, last and number of its turns."""
        size = len(self.letter)
        inner = np.ones(size + 1, bool)  # whether a turn follows another of its piece
        inner[self.offsets] = False
        inner = inner[:size]
        back = lambda x: np.concatenate([x[:1], x[:-1]])
        wrong = inner & ~legal(back(self.letter), self.letter)
        new = ~self.no_turn & (~inner | back(self.no_turn) | (back(self.turn) != self.turn))
        numbered = self.total(~self.no_turn)
        first = np.minimum(self.ends - numbered, max(size - 1, 0))  # nulls come first
        last = np.maximum(self.ends - 1, 0)
        turn = self.turn if size else np.zeros(1, np.int64)
        return {"blank": self.total(self.blank), "duplicate": self.total(self.duplicate), "truncated": self.total(self.truncated), "illegal": self.total(wrong), "first": turn[first], "last": turn[last], "turns": self.total(new), "numbered": numbered}

    def buckets(self):
        """Places of pieces of similar length, by powers of two; none of more than about a million turns."""
        size = np.where(self.n > 0, np.ceil(np.log2(np.maximum(self.n, 1))).astype(int), -1)
        for s in np.unique(size):
            which = np.flatnonzero(size == s)
            step = max(1, (1 << 20) >> max(0, int(s)))
            for at in range(0, len(which), step):
                part = which[at : at + step]
                yield part, Bucket(self, part)

    def repaired(self, ends: np.ndarray, enters: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Costs, edits and repaired turns of each piece; ``final`` ones are closed."""
        cost, parts = np.zeros(len(self.n), np.int64), []
        for which, bucket in self.buckets():
            back = bucket.backward(ends[which])
            cost[which] = np.take_along_axis(back[0], enters[which][:, None], 1)[:, 0]
            exits, steps = bucket.trace(back, enters[which])
            parts += [(which[k], np.full(len(k), number), code, bucket.at[k] + t, role) for number, (k, code, t, role) in enumerate(steps)]
            for more in (0, 1):  # u and a behind s, a behind u
                k = np.flatnonzero(final[which] & (CLOSING[exits] > more * INSERT))
                parts.append((which[k], np.full(len(k), len(steps) + more), np.ones(len(k), int), np.zeros(len(k), int), np.where((exits[k] == 1) & (more == 0), 1, 2)))
        piece, step, code, row, role = (np.concatenate([p[x] for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64) for x in range(5))
        order = np.lexsort((step, piece))
        piece, code, row, role = piece[order], code[order], row[order], role[order]
        split = lambda p: np.concatenate([[0], np.cumsum(np.bincount(p, minlength=len(self.n)))]).astype(np.int32)
        letters = np.frombuffer(LETTERS.encode(), np.uint8)[code]
        audit = pa.Array.from_buffers(pa.string(), len(self.n), [None, pa.py_buffer(split(piece)), pa.py_buffer(np.ascontiguousarray(letters))])
        out = code > 0
        piece, code, row, role = piece[out], code[out], row[out], role[out]
        source = pa.array(row, mask=code == 1)
        names = pc.if_else(pa.array(role == 0), self.role.take(source), pa.array(["", "user", "assistant"]).take(pa.array(role)))
        turns = pa.StructArray.from_arrays([names, pc.fill_null(self.text.take(source), "")], ["role", "text"])
        return cost, audit, pa.ListArray.from_arrays(pa.array(split(piece)), turns)


def legal(before: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Whether a role may follow another: su, ua, au."""
    return ((before == 0) | (before == 2)) & (letter == 1) | (before == 1) & (letter == 2)


# ------------------------------------------------------------------------------------------ the batches


def repeated(group: np.ndarray, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
    """Rows whose digest stands in an earlier row of their group."""
    order = np.lexsort((np.arange(len(group)), d2, d1, group))
    same = np.zeros(len(group), bool)
    same[1:] = (np.diff(group[order]) == 0) & (np.diff(d1[order]) == 0) & (np.diff(d2[order]) == 0)
    out = np.zeros(len(group), bool)
    out[order] = same
    return out


def _first_pass(batches):
    """Sorted turns to repaired conversations, and raw pieces of those that the batch's edges may cut."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, absent = batch.column("conv_id"), batch.column("absent").to_numpy(zero_copy_only=False)
        none, ids = pc.is_null(conv).to_numpy(zero_copy_only=False), pc.fill_null(conv, 0).to_numpy(zero_copy_only=False)
        start = np.concatenate([[0], 1 + np.flatnonzero((np.diff(ids) != 0) | (np.diff(none.astype(int)) != 0))])
        group = np.searchsorted(start, np.arange(len(ids)), side="right") - 1
        open_ = np.zeros(len(start), bool)
        open_[[0, -1]] = True
        there = ~absent
        for is_open in (False, True):
            which = np.flatnonzero(open_ == is_open)
            if not len(which):
                continue
            part = batch.filter(pa.array(there & (open_[group] == is_open)))
            own = np.searchsorted(which, group[there & (open_[group] == is_open)])
            offsets = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(which)))])
            zero = pa.array(np.zeros(len(which), np.int64))
            columns = {"conv_id": conv.take(pa.array(start[which])), "piece": pa.array(number + which), "whole": pa.array(np.full(len(which), not is_open))}
            if is_open:
                raw = pa.StructArray.from_arrays([part.column(c) for c in ("turn", "role", "text", "blank", "truncated", "d1", "d2")], ["turn", "role", "text", "blank", "truncated", "d1", "d2"])
                columns |= dict.fromkeys(TOTALS, zero) | {"audit": pa.nulls(len(which), pa.string()), "turns": pa.nulls(len(which), pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), "raw": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), raw)}
            else:
                digest = [part.column(c).to_numpy() for c in ("d1", "d2")]
                rows = Rows(part, offsets, repeated(own, *digest))
                cost, audit, turns = rows.repaired(np.tile(CLOSING, (len(which), 1)), np.zeros(len(which), int), np.ones(len(which), bool))
                f = rows.facts()
                f |= {"gaps": np.where(f["numbered"] > 0, f["last"] - f["first"] + 1 - f["turns"], 0), "cost": cost}
                columns |= {c: pa.array(f[c].astype(np.int64)) for c in TOTALS} | {"audit": audit, "turns": turns, "raw": pa.nulls(len(which), pa.list_(part_type()))}
            yield pa.RecordBatch.from_pydict(columns)
        number += len(start)


def part_type() -> pa.DataType:
    return pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("blank", pa.bool_()), ("truncated", pa.bool_()), ("d1", pa.int64()), ("d2", pa.int64())])


def unpacked(batch) -> Rows:
    """Turns of raw pieces; ``firsts`` are the places of turns that repeat none."""
    raw, offsets = batch.column("raw"), np.concatenate([[0], np.cumsum(pc.list_value_length(batch.column("raw")).to_numpy(zero_copy_only=False))]).astype(np.int64)
    flat = raw.flatten()
    fields = dict(zip([f.name for f in flat.type], flat.flatten(), strict=True))
    duplicate = np.ones(len(flat), bool)
    firsts = batch.column("firsts")
    length = pc.fill_null(pc.list_value_length(firsts), 0).to_numpy(zero_copy_only=False)
    duplicate[np.repeat(offsets[:-1], length) + firsts.flatten().to_numpy(zero_copy_only=False)] = False
    return Rows(fields, offsets, duplicate)


def lists(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.int64).reshape(len(column), -1)


def _summaries(batches):
    """Raw pieces to their facts, their outer letters, and their costs from each state to each."""
    for batch in batches:
        rows = unpacked(batch)
        table = np.zeros((len(rows.n), 4, 4), np.int64)
        for which, bucket in rows.buckets():
            for e in range(4):
                ends = np.full((len(which), 4), NEVER)
                ends[:, e] = 0
                table[which, :, e] = np.minimum(bucket.backward(ends)[0], NEVER)
        letter = rows.letter if len(rows.letter) else np.zeros(1, np.int64)
        outer = {"n": rows.n, "letter_first": letter[np.minimum(rows.offsets, len(letter) - 1)], "letter_last": letter[np.maximum(rows.ends - 1, 0)]}
        cells = pa.FixedSizeListArray.from_arrays(pa.array(table.reshape(-1)), 16).cast(pa.list_(pa.int64()))
        yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "piece": batch.column("piece"), "costs": cells} | {k: pa.array(v.astype(np.int64)) for k, v in (rows.facts() | outer).items()})


SUMMARY = "conv_id long, piece long, costs array<long>, blank long, duplicate long, truncated long, illegal long, first long, last long, turns long, numbered long, n long, letter_first long, letter_last long"


def _chained(group: pd.DataFrame) -> pd.DataFrame:
    """The costs behind each piece of a conversation; its first piece gets the conversation's totals."""
    group = group.sort_values("piece", ignore_index=True)
    behind, ends = CLOSING, []
    for costs in group["costs"][::-1]:
        ends.append(behind.tolist())
        behind = (np.asarray(costs).reshape(4, 4) + behind).min(axis=1)
    out = pd.DataFrame({"piece": group["piece"], "ends": ends[::-1], "final": group.index == len(group) - 1} | dict.fromkeys(TOTALS, 0))
    own, numbered = group[group["n"] > 0], group[group["numbered"] > 0]
    crossing = ~legal(own["letter_last"].to_numpy()[:-1], own["letter_first"].to_numpy()[1:])
    again = int((numbered["last"].to_numpy()[:-1] == numbered["first"].to_numpy()[1:]).sum())
    out.loc[0, ["blank", "duplicate", "truncated"]] = group[["blank", "duplicate", "truncated"]].sum()
    out.loc[0, "illegal"] = group["illegal"].sum() + crossing.sum()
    out.loc[0, "gaps"] = numbered["last"].max() - numbered["first"].min() + 1 - (numbered["turns"].sum() - again) if len(numbered) else 0
    out.loc[0, "cost"] = behind[0]
    return out


def _exits(batches):
    """The state behind each piece, for each state before it."""
    for batch in batches:
        rows, ends = unpacked(batch), lists(batch.column("ends"))
        exits = np.zeros((len(rows.n), 4), np.int64)
        for which, bucket in rows.buckets():
            back = bucket.backward(ends[which])
            for q in range(4):
                exits[which, q] = bucket.trace(back, np.full(len(which), q))[0]
        yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "piece": batch.column("piece"), "exits": pa.FixedSizeListArray.from_arrays(pa.array(exits.reshape(-1)), 4).cast(pa.list_(pa.int64()))})


def _entered(group: pd.DataFrame) -> pd.DataFrame:
    """The state before each piece of a conversation."""
    group = group.sort_values("piece", ignore_index=True)
    q, enters = 0, []
    for exits in group["exits"]:
        enters.append(q)
        q = int(exits[q])
    return pd.DataFrame({"piece": group["piece"], "enters": enters})


def _last_pass(batches):
    for batch in batches:
        rows = unpacked(batch)
        _, audit, turns = rows.repaired(lists(batch.column("ends")), batch.column("enters").to_numpy(), batch.column("final").to_numpy(zero_copy_only=False))
        columns = {"conv_id": batch.column("conv_id"), "piece": batch.column("piece"), "whole": pa.array(np.zeros(len(rows.n), bool))}
        yield pa.RecordBatch.from_pydict(columns | {c: batch.column(c) for c in TOTALS} | {"audit": audit, "turns": turns})


def repair(turns: DataFrame) -> DataFrame:
    """Repaired conversations: conv_id, piece, whole, gaps, blank, duplicate, truncated, illegal, cost, audit (the edits K, R, D, I) and turns (role and text).

    ``turns`` has conv_id, turn, role, text and absent; an absent turn takes no part, but its conversation has a row. A ``whole`` conversation is one row; another
    is one row for each ``piece``, in whose order turns and edits follow each other, with its counts and cost in the first. Turns come in order of
    number, nulls first; those of one number in order of role, of the text's first 64 characters, then as in the table. A null conv_id is a conversation of its own,
    null roles and texts are one space. An empty table gives no rows; extra columns are left out.

    No task holds more than a batch of turns. A conversation's 4 x 4 tables do meet in one task: one for each batch of its turns, so no more than 2^31 turns (what an
    audit string can hold) over the 10,000 of a batch.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role"), space("text"), F.coalesce("absent", F.lit(False)).alias("absent"), F.monotonically_increasing_id().alias("order"))
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    half = lambda k: F.conv(F.substring(digest, 1 + 15 * k, 15), 16, 10).cast("long")
    blank, ended = F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.col("text").rlike("[.!?][\\x20\\x09-\\x0D]*\\z")
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.substring("text", 1, HEAD), F.col("order")]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    judged = sorted_.select("conv_id", "turn", "role", "text", "absent", (~blank).alias("blank"), (~ended).alias("truncated"), half(0).alias("d1"), half(1).alias("d2"))
    pieces = staged(judged.mapInArrow(_first_pass, RESULT + ", " + RAW), "conversations")
    cut = pieces.where("not whole").select("conv_id", "piece", "raw")
    first = cut.select("conv_id", "piece", F.posexplode(F.transform("raw", lambda x: F.struct(x["d1"].alias("d1"), x["d2"].alias("d2")))).alias("at", "digest"))
    first = first.groupBy("conv_id", "digest").agg(F.min(F.struct("piece", "at")).alias("x")).groupBy("x.piece").agg(F.collect_list("x.at").alias("firsts"))  # no more than the turns of a piece
    marked = staged(cut.join(first, "piece", "left"), "cut-conversations", PIECE_ROWS)
    summary = staged(marked.mapInArrow(_summaries, SUMMARY), "piece-costs", PIECE_ROWS)
    totals = ", ".join(f"{c} long" for c in TOTALS)
    ends = staged(summary.groupBy("conv_id").applyInPandas(_chained, f"piece long, ends array<long>, final boolean, {totals}"), "piece-ends")
    exits = staged(marked.join(ends.select("piece", "ends"), "piece").mapInArrow(_exits, "conv_id long, piece long, exits array<long>"), "piece-exits", PIECE_ROWS)
    enters = exits.groupBy("conv_id").applyInPandas(_entered, "piece long, enters long")
    done = staged(marked.join(ends, "piece").join(enters, "piece").mapInArrow(_last_pass, RESULT), "repaired-pieces", PIECE_ROWS)
    return pieces.where("whole").drop("raw").unionByName(done)


def _digests(batches):
    """SHA-256 of the turns of conversations whose pieces come in order."""
    present, digest, begun = None, None, False
    kind = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    for batch in batches:
        for conv, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns"), strict=True):
            if digest is None or conv != present:
                if digest is not None:
                    yield pa.RecordBatch.from_pylist([{"conv_id": present, "repaired_sha256": digest.hexdigest()}], kind)
                present, digest, begun = conv, hashlib.sha256(), False
            for turn in turns:
                digest.update((("\n" if begun else "") + turn["role"].as_py() + ":" + turn["text"].as_py()).encode())
                begun = True
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"conv_id": present, "repaired_sha256": digest.hexdigest()}], kind)


def digests(repaired: DataFrame) -> DataFrame:
    """A row for each conversation, its turns as SHA-256 of the lines role:text.

    The digest of a conversation in pieces is a chain over all its bytes, so one task reads these in order; it holds a few pieces at a time.
    """
    line = lambda x: F.concat(x["role"], F.lit(":"), x["text"])
    own: list[Column] = [F.col(c) for c in ("conv_id", *TOTALS)]
    whole = repaired.where("whole").select(*own, "audit", F.sha2(F.array_join(F.transform("turns", line), "\n").cast("binary"), 256).alias("repaired_sha256"))
    cut = repaired.where("not whole")
    hashed = staged(cut.select("conv_id", "piece", "turns").repartition("conv_id").sortWithinPartitions("conv_id", "piece").mapInArrow(_digests, "conv_id long, repaired_sha256 string"), "digests", PIECE_ROWS)
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("piece", "audit"))), lambda x: x["audit"]), "")
    joined = cut.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in TOTALS), audit.alias("audit")).alias("a").join(hashed.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")))
    return whole.unionByName(joined.select("a.*", "repaired_sha256"))
