"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

P(severity > k | x) = sigmoid(w . x - t[k]), with one weight vector for all ordered thresholds t[0] < t[1] < t[2]; the score of a
document is the expected severity, the sum of these probabilities over k. Features are the presence of words and of word heads
(their first five bytes), and that these stand there twice or three times at least, hashed.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.llm.common import TEXT_BLOCK, U64, WordHasher, ascii_lower, fitting, mix64, row_blocks, utf8

BITS = 19
HEAD = 5
TIMES = 3
GRADES = 3  # severities above 0
REJECT = 0.5  # expected severity from which a document counts as toxic


@functools.cache
def hasher() -> WordHasher:
    apart = np.ones(256, bool)
    apart[128:] = False
    apart[[*range(65, 91), *range(97, 123)]] = False
    return WordHasher(ascii_lower(), apart)


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of the rows, in order: row and feature. A word or head that comes again, and a third time, has a further feature each."""
    row, _, _, word = hasher().words(buf, offsets)
    _, _, _, head = hasher().words(buf, offsets, HEAD)
    h = np.concatenate([mix64(word), mix64(~head)]) >> U64(64 - BITS)
    key, n = np.unique((np.concatenate([row, row]) << BITS) | h.astype(np.int64), return_counts=True)
    mask = (1 << BITS) - 1
    more = []
    for times in range(2, TIMES + 1):
        some = key[n >= times]
        more.append((some & ~mask) | (mix64((some & mask).astype(U64) + (U64(times) << U64(32))) >> U64(64 - BITS)).astype(np.int64))
    key = np.unique(np.concatenate([key, *more]))
    return key >> BITS, key & mask


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Model:
    """Shared weights (2 ** BITS) and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights.astype(np.float32), thresholds

    def severity(self, row: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        """Expected severity of each of n rows."""
        x = np.bincount(row, weights=self.weights[feature], minlength=n)
        return sigmoid(x[:, None] - self.thresholds[None, :]).sum(axis=1)


def severities(row, feature, toxic: np.ndarray) -> np.ndarray:
    """Grades 0 to GRADES of a sample labelled toxic or not: toxic texts are graded by how many distinct features of theirs speak for toxicity.

    A feature speaks for toxicity if its smoothed document-frequency log odds exceed 3. The numbers of the toxic texts are cut at their quantiles.
    """
    size, pos = 1 << BITS, max(1, int(toxic.sum()))
    p = np.bincount(feature[toxic[row]], minlength=size)
    q = np.bincount(feature[~toxic[row]], minlength=size)
    odds = np.log((p + 0.5) / (pos + 1)) - np.log((q + 0.5) / (len(toxic) - pos + 1))
    speaks = (odds > 3) & (p >= 5)
    number = np.bincount(row, weights=speaks[feature], minlength=len(toxic))
    cuts = np.quantile(number[toxic], np.arange(1, GRADES) / GRADES) if toxic.any() else np.zeros(GRADES - 1)
    return np.where(toxic, 1 + np.searchsorted(cuts, number, side="left"), 0)


def fit(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, rounds: int = 800, l2: float = 2e-4, least_z: float = 6.0) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam over the whole sample.

    Only features whose document frequencies among graded and other texts differ by ``least_z`` standard errors get a weight; a text
    has hundreds of features that say nothing, whose chance weights would add up.
    """
    n, size = len(grade), 1 << BITS
    if not n or grade.min() == grade.max():
        return Model(np.zeros(size), np.arange(GRADES) + 4.0)
    pos = int((grade > 0).sum())
    p, q = (np.bincount(feature[mine], minlength=size) for mine in ((grade > 0)[row], (grade == 0)[row]))
    both = (p + q) / n
    error = np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / max(1, pos) + 1 / max(1, n - pos)))
    keep = np.flatnonzero((p + q >= 4) & (np.abs(p / max(1, pos) - q / max(1, n - pos)) >= least_z * error))
    index = np.full(size, -1)
    index[keep] = np.arange(len(keep))
    col = index[feature]
    row, col = row[col >= 0], col[col >= 0]
    over = (grade[:, None] > np.arange(GRADES)[None, :]).astype(float)
    # thresholds as a first one and positive steps
    rate = np.clip(over.mean(axis=0), 1e-3, 1 - 1e-3)
    t = -np.log(rate / (1 - rate))
    theta = np.concatenate([np.zeros(len(keep)), [t[0]], np.log(np.maximum(np.diff(t), 0.05))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    weight = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))  # both sides count alike
    for k in range(1, rounds + 1):
        w, first, step = theta[: len(keep)], theta[len(keep)], np.exp(theta[len(keep) + 1 :])
        cut = first + np.concatenate([[0], np.cumsum(step)])
        x = np.bincount(row, weights=w[col], minlength=n)
        s = sigmoid(x[:, None] - cut[None, :])
        # P(grade = g) = s[g - 1] - s[g]; gradient of -log P by the two links at the grade's edges
        pad = np.concatenate([np.ones((n, 1)), s, np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        upper, lower = pad[at, grade], pad[at, grade + 1]
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        gx = -(du - dl) * weight
        gcut = np.zeros(GRADES)
        np.add.at(gcut, (grade - 1)[grade > 0], (du * weight)[grade > 0])
        np.add.at(gcut, grade[grade < GRADES], -(dl * weight)[grade < GRADES])
        gstep = np.cumsum(gcut[::-1])[::-1]
        grad = np.concatenate([np.bincount(col, weights=gx[row], minlength=len(keep)) + l2 * w, [gstep[0]], gstep[1:] * step])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - 0.05 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    weights = np.zeros(size)
    weights[keep] = theta[: len(keep)]
    return Model(weights, theta[len(keep)] + np.concatenate([[0], np.cumsum(np.exp(theta[len(keep) + 1 :]))]))


def _sampled(batches):
    for batch in batches:
        buf, off = utf8(batch.column("text"))
        for i, j in row_blocks(off, TEXT_BLOCK):
            row, feature = features(buf[off[i] : off[j]], off[i : j + 1] - off[i])
            first = np.searchsorted(row, np.arange(j - i + 1))
            cut = [feature[a:b].astype(np.int32).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("grade").slice(i, j - i), pa.array(cut, pa.binary())], ["grade", "feature"])


def _scored(model: Model):
    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            score = np.zeros(batch.num_rows)
            for i, j in row_blocks(off, TEXT_BLOCK):
                row, feature = features(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                score[i:j] = model.severity(row, feature, j - i)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(np.rint(score).astype(np.int32)), pa.array(score >= REJECT)], ["doc_id", "severity", "grade", "toxic"])

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = 8000, sample_bytes: int = 256 << 20) -> Model:
    """Fit on at most ``sample`` labelled documents, half of them toxic as far as there are so many, those of the smallest hash of doc_id.

    Of these, in hash order, whole texts serve that fit into ``sample_bytes`` together, which bounds what the driver holds. Of rows of one doc_id, one text serves.

    labels: doc_id and toxic (0/1), or severity (0 to GRADES) where there is such a column. Rows without a label or doc_id are not used.
    """
    target = "severity" if "severity" in labels.columns else "toxic"
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("grade")).where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    half = lambda cond: labels.where(cond).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2)
    chosen = half("grade > 0").union(half("grade <= 0"))  # at most ``sample`` rows of two numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = texts.withColumn("h", F.xxhash64("doc_id", "text"))
    sizes = texts.groupBy("doc_id").agg(F.min(F.struct("h", F.octet_length("text").alias("size"))).alias("x")).select("x.*").collect()  # at most ``sample`` rows
    fit_in = fitting(sorted((r["h"], r["size"] or 0) for r in sizes), sample_bytes)
    serving = docs.sparkSession.createDataFrame([(h,) for h in fit_in], "h long")
    once = texts.join(F.broadcast(serving), "h").select("h", "grade", "text").dropDuplicates(["h"])
    rows = once.select("grade", "text").mapInArrow(_sampled, "grade int, feature binary").collect()
    rows.sort(key=lambda r: (r["grade"], bytes(r["feature"])))
    if not rows:
        return fit(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    parts = [np.frombuffer(bytes(r["feature"]), np.int32) for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(x) for x in parts])
    feature = np.concatenate(parts).astype(np.int64)
    grade = np.array([r["grade"] for r in rows])
    grade = np.clip(grade, 0, GRADES) if target == "severity" else severities(row, feature, grade > 0)
    return fit(row, feature, grade)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Expected severity of each row of ``docs`` (doc_id, text, more): doc_id, severity (0 to GRADES), grade (rounded), toxic (severity >= REJECT).

    Whole texts count. Null and empty texts have no features and get the model's base score, below REJECT. Repeated rows are
    scored each; a null doc_id stays null. An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_scored(model), "doc_id long, severity double, grade int, toxic boolean")


def _clean(model: Model):
    def run(batches):
        for batch in batches:
            buf, off = utf8(batch.column("text"))
            keep = np.ones(batch.num_rows, bool)
            for i, j in row_blocks(off, TEXT_BLOCK):
                row, feature = features(buf[off[i] : off[j]], off[i : j + 1] - off[i])
                keep[i:j] = model.severity(row, feature, j - i) < REJECT
            yield batch.filter(pa.array(keep))

    return run


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all columns, whose expected severity is below REJECT; null and empty texts stay, repeated rows stay each."""
    return docs.mapInArrow(_clean(model), docs.schema)
