"""Language id in two steps: the family first, then one-versus-one linear machines within it."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import fresh, query, table

#: Families of ISO 639-1 codes; a code without an entry is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "is"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca"],
    "slavic": ["ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"],
    "uralic": ["fi", "et", "hu"],
    "indic": ["hi", "bn", "mr", "ur"],
}
#: Labelled texts that are learned from, all languages together, and hashed n-gram features.
SAMPLE, FEATURES = 2400, 4096
COST, PASSES, SLOPE = 1.0, 25, 4.0
UNKNOWN = "und"
#: As sure as one guess of four; the pipeline keeps texts from here on.
MIN_SCORE = 0.25


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of hashed letter n-grams (one to three) of the whole text; None without letters."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[chars]
    if not letter.any():
        return None
    first = np.append(True, letter[:-1])  # of a run of other characters only the first counts
    c = np.where(letter, chars, 32)[letter | first].astype(np.uint32)
    c = np.concatenate([[32], c, [32]]).astype(np.uint32)
    one = c * np.uint32(2654435761)
    two = (c[:-1] * np.uint32(40503) ^ c[1:]) * np.uint32(2246822519)
    three = ((c[:-2] * np.uint32(40503) ^ c[1:-1]) * np.uint32(40503) ^ c[2:]) * np.uint32(3266489917)
    places = np.concatenate([one, two, three]) >> np.uint32(32 - FEATURES.bit_length() + 1)
    counts = np.sqrt(np.bincount(places, minlength=FEATURES).astype(np.float32))
    return counts / np.linalg.norm(counts)


def fit_svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a linear machine (hinge loss) by dual coordinate descent; ``y`` is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    norm = (x * x).sum(axis=1)
    cost = COST * len(y) / (2 * np.array([max(1, (y == s).sum()) for s in y]))  # each side weighs the same
    alpha, w = np.zeros(len(y)), np.zeros(x.shape[1])
    rng = np.random.default_rng(0)
    for _ in range(PASSES):
        for i in rng.permutation(len(y)):
            new = min(max(alpha[i] - (y[i] * (w @ x[i]) - 1) / norm[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


class PairModel:
    """One linear machine for every pair of classes; the class with the best worst duel wins."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        self.classes = sorted(set(labels))
        labels = np.array(labels)
        self.duels = {}
        for a, b in combinations(self.classes, 2):
            mine = (labels == a) | (labels == b)
            self.duels[a, b] = fit_svm(x[mine], np.where(labels[mine] == a, 1.0, -1.0))

    def best(self, x: np.ndarray) -> tuple[str, float]:
        worst = dict.fromkeys(self.classes, 1.0)
        for (a, b), w in self.duels.items():
            p = 1.0 / (1.0 + np.exp(-SLOPE * (w[:-1] @ x + w[-1])))
            worst[a], worst[b] = min(worst[a], p), min(worst[b], 1.0 - p)
        name = max(self.classes, key=worst.get)
        return name, float(worst[name])


class LanguageModel:
    def __init__(self, x: np.ndarray, langs: list[str], families: dict[str, list[str]] = FAMILIES):
        of = {lang: name for name, members in families.items() for lang in members}
        family = [of.get(lang, lang) for lang in langs]
        self.families = PairModel(x, family)
        self.within = {}
        for name in self.families.classes:
            mine = [i for i, f in enumerate(family) if f == name]
            self.within[name] = PairModel(x[mine], [langs[i] for i in mine])

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or not self.families.classes:
            return UNKNOWN, 0.0
        family, sure = self.families.best(x)
        lang, surer = self.within[family].best(x)
        return lang, sure * surer


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text is a multiple of five."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Fit the model on at most ``sample`` labelled texts that are not held out.

    Every language gets an equal share, the documents with the smallest id hashes;
    their feature vectors (16 KB each) come to the driver. How small follows from the
    count per language, so texts are picked where they are read and never shuffled.
    """
    known = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    counts = {r.lang: r["count"] for r in known.groupBy("lang").count().collect()}
    share = max(1, sample // max(1, len(counts)))
    spread = F.xxhash64("id").cast("double") / 2.0**64 + 0.5  # even between 0 and 1
    bar = F.lit(0.0)
    for name, n in sorted(counts.items()):
        bar = F.when(F.col("lang") == name, F.lit(share / n)).otherwise(bar)
    picked = known.withColumn("spread", spread).where(F.col("spread") <= bar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(lang, k, features(t)) for lang, k, t in zip(*[c.to_pylist() for c in batch.columns])]
            found = [(lang, k, v.tobytes()) for lang, k, v in found if v is not None]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.binary()))], ["lang", "spread", "v"])

    rows = sorted(picked.select("lang", "spread", "text").mapInArrow(run, "lang string, spread double, v binary").collect())
    taken = Counter()
    rows = [r for r in rows if (taken.update([r.lang]), taken[r.lang] <= share)[1]]  # chance may have picked a few more
    x = np.array([np.frombuffer(r.v, np.float32) for r in rows]).reshape(len(rows), FEATURES)
    return LanguageModel(x, [r.lang for r in rows])


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (which replace columns of that name).

    The score is the smallest duel probability of the family times that of the
    language. Only the text goes to Python and only the guess returns. NULL texts and texts without a letter are ``und`` with score 0, as is
    every text if nothing could be learned; a language alone in its family needs no
    duel there. Rows are independent of each other; no rows give no rows.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t.as_py()) for t in texts]
        made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
        return pa.StructArray.from_arrays(made, ["lang_pred", "score"])

    (guess,) = fresh(docs, "_guess")
    out = docs.select(*[docs[c] for c in kept], predict(docs[text]).alias(guess))
    return out.select(*[F.col(f"`{c}`") for c in kept], f"{guess}.lang_pred", f"{guess}.score")


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and score of every document."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.select("doc_id", "text"), learn(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
