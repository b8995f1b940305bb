"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, then a linear hinge-loss machine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm.common import durable, query, table
from cartloom.llm.language import held_out

#: Hashed n-gram indicators; the counts of one class are as many longs.
BITS = 16
#: Labelled texts the machine is fitted on, both classes together. The log-count ratios
#: are taken over all labelled texts.
SAMPLE = 3000
SMOOTH, COST, PASSES, TOLERANCE, FOLDS = 1.0, 1.0, 60, 1e-3, 3
THRESHOLD = 0.3
#: Code points whose n-grams are hashed at a time, which bounds memory for very long texts.
PIECE = 1 << 18

STEP, MIX = np.uint32(40503 * 65537), np.uint32(2654435761)
#: Kind of an ASCII character as one bit (capital, small, digit, other); from 128 on the bit 16.
CAPITAL, SMALL, DIGIT, OTHER, WIDE = 1, 2, 4, 8, 16
KINDS = np.array([CAPITAL if 65 <= k <= 90 else SMALL if 97 <= k <= 122 else DIGIT if 48 <= k <= 57 else OTHER for k in range(128)] + [WIDE], np.uint8)


def _bucket(*parts: np.ndarray, kind: int) -> np.ndarray:
    """Hash of several columns of 32-bit numbers, as a bucket."""
    h = parts[0] ^ np.uint32(kind * 0x01000193)
    for p in parts[1:]:
        h = (h * STEP) ^ (h >> np.uint32(15)) ^ p
    return (h * MIX) >> np.uint32(32 - BITS)


def _words(c: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape of every word: its kinds of characters and how it starts."""
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, np.uint32), np.empty(0, np.uint32)
    chars, sizes = c[~space], ends - starts
    offsets = np.cumsum(sizes) - sizes
    place = np.arange(len(chars), dtype=np.uint32) - np.repeat(offsets.astype(np.uint32), sizes)
    mixed = (chars + np.uint32(0x5BD1)) * (2 * place + np.uint32(1)) * MIX
    hashes = np.add.reduceat(mixed ^ (mixed >> np.uint32(13)), offsets, dtype=np.uint32)
    kinds = KINDS[np.minimum(chars, 128)]
    shape = np.bitwise_or.reduceat(kinds, offsets).astype(np.uint32)
    return hashes, shape | ((kinds[offsets] & CAPITAL).astype(np.uint32) << np.uint32(5))


def features(text: str | None) -> np.ndarray:
    """Sorted buckets of the n-grams a text holds: characters (1 to 3), words (1, 2), and shapes (1 to 3).

    The shape of a word tells its kinds of characters and whether it repeats one of the
    two words before, so that runs of equal words look alike whatever the word is.
    """
    c = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    flags = np.zeros(1 << BITS, bool)
    flags[_bucket(np.zeros(1, np.uint32), kind=0)] = True  # every text holds this one
    for k in range(0, len(c), PIECE):
        p = c[k : k + PIECE + 2]
        flags[_bucket(p, kind=1)] = True
        flags[_bucket(p[:-1], p[1:], kind=2)] = True
        flags[_bucket(p[:-2], p[1:-1], p[2:], kind=3)] = True
    space = (c == 32) | ((c >= 9) & (c <= 13))
    words, shape = _words(c, space)
    if len(words):
        flags[_bucket(words, kind=4)] = True
        flags[_bucket(words[:-1], words[1:], kind=5)] = True
        shape[1:] |= (words[1:] == words[:-1]).astype(np.uint32) << np.uint32(6)
        shape[2:] |= (words[2:] == words[:-2]).astype(np.uint32) << np.uint32(7)
        flags[_bucket(shape, kind=6)] = True
        flags[_bucket(shape[:-1], shape[1:], kind=7)] = True
        flags[_bucket(shape[:-2], shape[1:-1], shape[2:], kind=8)] = True
    return np.flatnonzero(flags).astype(np.int32)


def log_ratios(good: np.ndarray, bad: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """Log of how much likelier each indicator is among good texts than among bad ones."""
    p, q = good + smooth, bad + smooth
    return np.log(p / p.sum()) - np.log(q / q.sum())


def scaled(held: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Values of the held indicators: their ratios, as a vector of length one."""
    x = ratios[held]
    return x / max(np.linalg.norm(x), 1e-12)


def fit_hinge(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: np.ndarray, passes: int = PASSES, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights of a linear machine with hinge loss, by dual coordinate descent.

    ``rows`` are (places, values), ``y`` is +1 or -1, ``cost`` bounds each row's dual
    variable. Each step solves one variable exactly; passes end when no projected
    gradient exceeds ``tolerance``.
    """
    w, alpha = np.zeros(size), np.zeros(len(rows))
    norms = np.array([v @ v for _, v in rows])
    rng = np.random.default_rng(0)
    for _ in range(passes):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            at, v = rows[i]
            slope = y[i] * (w[at] @ v) - 1.0
            step = min(slope, 0.0) if alpha[i] <= 0 else max(slope, 0.0) if alpha[i] >= cost[i] else slope
            worst = max(worst, abs(step))
            if step:
                new = min(max(alpha[i] - slope / norms[i], 0.0), cost[i])
                w[at] += (new - alpha[i]) * y[i] * v
                alpha[i] = new
        if worst < tolerance:
            break
    return w


def fit_curve(margins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from margins to chances (Newton steps, targets kept off 0 and 1)."""
    n1, n0 = weight[y > 0].sum(), weight[y <= 0].sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margins, np.ones(len(margins))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -35, 35)))
        slope = x.T @ (weight * (p - target)) + 1e-6 * at
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at = at - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


@dataclass
class QualityModel:
    """Weight of every indicator, its ratio, and the curve from margins to chances."""

    ratios: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        held = features(text)
        margin = self.weights[held] @ scaled(held, self.ratios)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -35, 35))))


def fit(held: list[np.ndarray], y: np.ndarray, good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int) -> QualityModel:
    """The model from sampled indicators, the counts of all labelled texts, and how many those were."""
    ratios = log_ratios(good, bad)
    size = 1 << BITS
    if n_good == 0 or n_bad == 0 or len(set(y.tolist())) < 2:
        # one class only, or nothing: its share of the labels for every text
        share = (n_good + 1) / (n_good + n_bad + 2)
        return QualityModel(ratios, np.zeros(size), 0.0, float(np.log(share / (1 - share))))
    rows = [(h, scaled(h, ratios)) for h in held]
    side = np.where(y > 0, (y > 0).sum(), (y <= 0).sum())
    cost = COST * len(y) / (2.0 * side)  # either class weighs the same in the fit
    # margins of texts the machine has not seen, for the curve
    fold, margins = np.arange(len(y)) % FOLDS, np.zeros(len(y))
    for k in range(FOLDS):
        mine = np.flatnonzero(fold != k)
        if len(set(y[mine].tolist())) == 2:
            w = fit_hinge([rows[i] for i in mine], y[mine], size, cost[mine])
            for i in np.flatnonzero(fold == k):
                margins[i] = w[rows[i][0]] @ rows[i][1]
    natural = np.where(y > 0, n_good / (n_good + n_bad), n_bad / (n_good + n_bad)) * len(y) / side
    slope, offset = fit_curve(margins, y, natural)
    return QualityModel(ratios, fit_hinge(rows, y, size, cost), slope, offset)


def _gather(share_good: float, share_bad: float):
    """Rows (spread, quality, text): indicator counts of the task, and the indicators of sampled texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "good", "bad", "spread", "quality", "held"]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.binary()]
        counts = np.zeros((2, 1 << BITS), np.int64)
        for batch in batches:
            picked = []
            for spread, quality, text in zip(*batch.columns):
                spread, quality, held = spread.as_py(), quality.as_py(), features(text.as_py())
                counts[quality, held] += 1
                if spread <= (share_good if quality else share_bad):
                    picked.append((None, None, None, spread, quality, held.tobytes()))
            if picked:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*picked), types)], names)
        met = np.flatnonzero(counts.any(axis=0))
        empty = [pa.nulls(len(met), t) for t in types[3:]]
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(counts[1, met]), pa.array(counts[0, met]), *empty], names)

    return run


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Fit the model on the labelled texts that are not held out.

    The log-count ratios come from every labelled text; each task counts its indicators,
    so at most 2 ** BITS rows a task are shuffled and 2 ** BITS reach the driver. The
    machine is fitted on at most ``sample`` texts, half of either class, those with the
    smallest id hashes; at most 256 KB each reach the driver.

    Rows without id or label and labels other than 0 and 1 teach nothing; a text that is
    NULL counts as empty; a document labelled twice counts twice.
    """
    known = labels.select(F.col(doc_id).alias("id"), F.col(quality).cast("int").alias("quality"))
    known = known.where(F.col("id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("id")))
    counts = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    half = sample // 2
    share = [min(1.0, half / max(1, counts.get(q, 0))) for q in (0, 1)]
    spread = F.xxhash64("id").cast("double") / 2.0**64 + 0.5  # even between 0 and 1
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # hashed on the short labels, so that texts are dealt once and never sorted, at every size
    rows = texts.where(~held_out(F.col("id"))).join(known.hint("shuffle_hash"), "id").select(spread.alias("spread"), "quality", "text")
    made = durable(rows.mapInArrow(_gather(share[1], share[0]), "bucket int, good long, bad long, spread double, quality int, held binary"))
    sums = made.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    good, bad = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for r in sums:
        good[r.bucket], bad[r.bucket] = r.good, r.bad
    taken, held, y = [0, 0], [], []
    for r in sorted(made.where("held IS NOT NULL").select("spread", "quality", "held").collect()):
        if taken[r.quality] < half:  # chance may have picked a few more
            taken[r.quality] += 1
            held.append(np.frombuffer(r.held, np.int32))
            y.append(1.0 if r.quality else -1.0)
    # the indicator that every text holds counts the texts themselves
    always = int(_bucket(np.zeros(1, np.uint32), kind=0)[0])
    return fit(held, np.array(y), good, bad, int(good[always]), int(bad[always]))


def judge(docs: DataFrame, model: QualityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on), which replace columns of that name.

    Only the text goes to Python and only the score returns. A NULL text is scored like
    an empty one; equal texts have equal scores; no rows give no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two numbers for each of 2 ** BITS indicators

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t.as_py()) for t in texts], pa.float64())

    kept = [docs[c] for c in docs.columns if c not in ("score", "predicted")]
    out = docs.select(*kept, score(docs[text]).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op12_quality")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judge(docs, learn(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
