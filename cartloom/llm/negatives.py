"""Hard-negative mining: anchors in clusters, one list of candidates a cluster sorted by an angular bound, walks that end when no better candidate can follow."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import durable, query, same, table

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 30, 90
SCALE = 256
#: Anchors that cluster centres are fitted on, and the largest number of clusters.
SAMPLE, CLUSTERS, PER_CLUSTER = 4096, 64, 64
#: Candidates of one list, candidates scored at a time, and anchors that walk together.
CHUNK, STEP, TOGETHER = 32768, 1024, 256


def rows_of(vectors: DataFrame, label: Column, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Stored ``id, label, mark, v``: whole-number vectors of equal length, padded by zeros.

    Rows without id, label or vector, with a NULL or non-finite component, or so long
    that scores would not fit a long take no part; equal rows are one.
    """
    whole = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > 2.0**40))
    rows = vectors.where(F.col(vec_id).isNotNull() & label.isNotNull() & F.col(vector).isNotNull() & ~bad)
    rows = rows.select(F.col(vec_id).alias("id"), label.alias("label"), whole.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.where(square < 2.0**62)
    size = rows.agg(F.max(F.size("v"))).first()[0] or 0
    rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size("v"))))
    return durable(rows.withColumn("mark", F.xxhash64("label", "v")).dropDuplicates(["id", "mark"]))


def matrix(column: pa.Array) -> np.ndarray:
    """List column of equal lengths as rows of whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.empty((0, 0), np.int64)


def unit(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = v.astype(np.float64)
    norms = np.sqrt((v * v).sum(axis=1))
    return v / np.maximum(norms, 1e-300)[:, None], norms


def fit_centres(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of ``k`` groups of directions."""
    u, norms = unit(v)
    u = u[norms > 0]
    if not len(u):
        return np.zeros((1, v.shape[1]))
    rng = np.random.default_rng(0)
    centres = u[rng.choice(len(u), min(k, len(u)), replace=False)]
    for _ in range(rounds):
        of = (u @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, of, u)
        sizes = np.linalg.norm(sums, axis=1)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1e-300)[:, None], centres)
    return centres


def nearest(v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and angle of every row; a zero row, all of whose scores are 0, is at no angle."""
    u, norms = unit(v)
    cosines = u @ centres.T
    of = cosines.argmax(axis=1)
    angle = np.arccos(np.clip(cosines[np.arange(len(of)), of], -1.0, 1.0))
    return of, np.where(norms > 0, angle, 0.0)


@dataclass
class Shard:
    """Candidates of one chunk, and a list of them for every cluster that walks here."""

    ids: np.ndarray
    marks: np.ndarray
    labels: np.ndarray
    v: np.ndarray
    lists: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self):
        self.unit, self.norms = unit(self.v)
        # sums of doubles are exact up to 2 ** 53, those of longs beyond
        if not len(self.v) or self.norms.max() < 2.0**26:
            self.v = self.v.astype(np.float64)

    def list_of(self, cluster: int, centre: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Candidates by falling bound on their score with a member of length one.

        A member is at most ``reach`` from the centre, so its angle to a candidate is at
        least the candidate's angle to the centre less ``reach``.
        """
        if cluster not in self.lists:
            angle = np.arccos(np.clip(self.unit @ centre, -1.0, 1.0))
            bound = self.norms * np.cos(np.maximum(0.0, angle - reach - 1e-7))
            order = np.argsort(-bound, kind="stable")
            self.lists[cluster] = order, bound[order]
        return self.lists[cluster]


def walk(shard: Shard, order: np.ndarray, bound: np.ndarray, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, wanted: list[tuple[int, int | None, int | None]], k: int, alike: bool, step: int = STEP) -> tuple[list[list[tuple[int, int, int]]], int]:
    """The best ``k`` candidates of every walker, and how many list places were read.

    A walker is (member, least score, largest score), None for no limit. It leaves when
    the bound of the next place is below what it needs: its least score, or the last of
    its ``k`` best. Scores are whole numbers; higher ones come first, then smaller ids.
    """
    norms = unit(v)[1]
    if len(v) and (shard.v.dtype == np.int64 or norms.max() >= 2.0**26):
        left, right = v, shard.v.astype(np.int64)
    else:
        left, right = v.astype(np.float64), shard.v
    of = np.array([w[0] for w in wanted], np.int64)
    low = np.array([-np.inf if w[1] is None else float(w[1]) for w in wanted])
    high = np.array([np.inf if w[2] is None else float(w[2]) for w in wanted])
    need, best, read = low.copy(), [[] for _ in wanted], 0
    for at in range(0, len(order), step):
        most = norms[of] * bound[at]
        going = np.flatnonzero(most + 1e-9 * np.abs(most) + 1e-6 >= need)
        if not len(going):
            break
        members, row = np.unique(of[going], return_inverse=True)
        place = order[at : at + step]
        read += len(members) * len(place)
        scores = left[members] @ right[place].T
        fits = (labels[members][:, None] == shard.labels[place][None, :]) == alike
        fits &= ids[members][:, None] != shard.ids[place][None, :]
        mine = scores[row]
        hit = fits[row] & (mine >= need[going][:, None]) & (mine <= high[going][:, None])
        for g in np.flatnonzero(hit.any(axis=1)):
            w, found = going[g], np.flatnonzero(hit[g])
            if len(found) > k:  # those below the k-th of this step cannot stay
                found = found[mine[g, found] >= np.partition(mine[g, found], -k)[-k]]
            new = [(-int(mine[g, f]), int(shard.ids[place[f]]), int(shard.marks[place[f]])) for f in found]
            best[w] = sorted(best[w] + new)[:k]
            if len(best[w]) == k:
                need[w] = -best[w][-1][0]
    return best, read


FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("anchor", "anchor_mark", "positive_score", "other", "other_mark", "score")])


def _scan(centres: np.ndarray, reach: list[float], k: int, alike: bool, low: int, high: int):
    """Rows sorted by chunk, candidates before anchors, anchors by cluster."""

    def answer(shard: Shard, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        clusters = batch.column("cluster").to_numpy()
        ids, marks, labels = (batch.column(c).to_numpy() for c in ("id", "mark", "label"))
        v, scores = matrix(batch.column("v")), batch.column("scores").to_pylist()
        cuts = np.flatnonzero(np.diff(clusters)) + 1
        for part in np.split(np.arange(len(ids)), cuts):
            order, bound = shard.list_of(int(clusters[part[0]]), centres[clusters[part[0]]], reach[clusters[part[0]]])
            for s in range(0, len(part), TOGETHER):
                some = part[s : s + TOGETHER]
                if alike:
                    wanted, keys = [(i, None, None) for i in range(len(some))], [(i, None) for i in range(len(some))]
                else:
                    keys = [(i, p) for i, a in enumerate(some) for p in scores[a]]
                    wanted = [(i, -(-low * p // 100), high * p // 100) for i, p in keys]
                best, _ = walk(shard, order, bound, ids[some], labels[some], v[some], wanted, k, alike)
                rows = [(ids[some[i]], marks[some[i]], p, other, mark, -score) for (i, p), b in zip(keys, best) for score, other, mark in b]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], FOUND.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard, held = None, None, []
        for batch in batches:
            chunk, kind = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(chunk) != 0) | (np.diff(kind) != 0)) + 1
            edges = [0, *cuts.tolist(), len(chunk)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if chunk[a] != at:
                    at, shard, held = chunk[a], None, []
                if kind[a] == 0:
                    held.append(part)
                    continue
                if shard is None and held:
                    whole = pa.Table.from_batches(held)
                    shard = Shard(*(whole.column(c).to_numpy() for c in ("id", "mark", "label")), matrix(whole.column("v")))
                    held = []
                if shard is not None:
                    yield from answer(shard, part)

    return run


def _search(rows: DataFrame, anchors: DataFrame, chunks: int, centres: np.ndarray, reach: list[float], k: int, alike: bool, low: int, high: int) -> DataFrame:
    """The best ``k`` of every chunk, for every anchor (and positive score)."""
    chunk = F.pmod(F.xxhash64("id", "mark"), F.lit(chunks)).cast("int")
    none = F.lit(None).cast("array<bigint>")
    theirs = rows.select(chunk.alias("chunk"), F.lit(0).alias("kind"), F.lit(0).alias("cluster"), "id", "mark", "label", "v", none.alias("scores"))
    each = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    ours = anchors.select(each.alias("chunk"), F.lit(1).alias("kind"), "cluster", "id", "mark", "label", "v", "scores")
    dealt = theirs.unionByName(ours).repartition(chunks, "chunk").sortWithinPartitions("chunk", "kind", "cluster", "id", "mark")
    return dealt.mapInArrow(_scan(centres, reach, k, alike, low, high), FOUND)


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, chunk_rows: int = CHUNK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for stored ``rows_of`` rows.

    The score of two rows is their inner product. An anchor's positives are its first
    ``positives`` other rows of its label; for each the first ``negatives`` rows of other
    labels are returned whose score is between ``low`` and ``high`` hundredths of the
    positive's. Higher scores come first, then smaller ids.

    Anchors are clustered by direction around centres fitted on at most SAMPLE of them.
    Candidates are dealt by hash to chunks of about ``chunk_rows``; anchors visit every
    chunk. There, each cluster's list is sorted once by the angular upper bound, and every
    member walks it until the bound certifies that nothing better follows. Chunks keep
    the best of each walk, and these few rows are ranked per anchor. First the positives
    are found so, then the negatives within the windows that they set. No chunk and no
    batch of anchors grows with the table, and no candidate is left out.

    Rows of one id but unlike content are several rows, and never each other's result;
    an anchor with fewer positives or negatives has those there are; a positive of
    negative score has no negatives; no rows or no anchors give no rows.
    """
    spark = rows.sparkSession
    n, size = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // chunk_rows))
    chosen = rows.where(anchor)
    sample = chosen.orderBy(F.xxhash64("id", "mark"), "id", "mark").limit(SAMPLE).select("v").collect()
    picked = np.array([r.v for r in sample], np.int64).reshape(len(sample), size or 0)
    centres = fit_centres(picked, max(1, min(CLUSTERS, len(picked) // PER_CLUSTER)))

    @F.arrow_udf(T.StructType([T.StructField("cluster", T.IntegerType()), T.StructField("angle", T.DoubleType())]))
    def place(v: pa.Array) -> pa.Array:
        of, angle = nearest(matrix(v), centres)
        return pa.StructArray.from_arrays([pa.array(of, pa.int32()), pa.array(angle, pa.float64())], ["cluster", "angle"])

    anchors = durable(chosen.select("id", "mark", "label", "v", place("v").alias("at")).select("id", "mark", "label", "v", "at.*"))
    far = {r.cluster: r.far for r in anchors.groupBy("cluster").agg(F.max("angle").alias("far")).collect()}  # at most CLUSTERS
    reach = [far.get(c, 0.0) for c in range(len(centres))]
    none = F.lit(None).cast("array<bigint>")
    met = _search(rows, anchors.withColumn("scores", none), chunks, centres, reach, positives, True, low, high)
    first = Window.partitionBy("anchor", "anchor_mark").orderBy(F.desc("score"), "other", "other_mark")
    met = met.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    known = durable(met.select("anchor", "anchor_mark", "other", "other_mark", "score"))
    scores = known.where("score >= 0").groupBy(F.col("anchor").alias("_anchor"), F.col("anchor_mark").alias("_mark")).agg(F.collect_set("score").alias("scores"))
    asking = durable(anchors.join(scores, (F.col("id") == F.col("_anchor")) & (F.col("mark") == F.col("_mark"))).drop("_anchor", "_mark"))
    found = _search(rows, asking, chunks, centres, reach, negatives, False, low, high)
    best = Window.partitionBy("anchor", "anchor_mark", "positive_score").orderBy(F.desc("score"), "other", "other_mark")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    found = found.select("anchor", "anchor_mark", F.col("positive_score"), "rank", F.col("other").alias("negative"), F.col("score").alias("negative_score"))
    pairs = known.select("anchor", "anchor_mark", F.col("score").alias("positive_score"), F.col("other").alias("positive"))
    out = pairs.join(found, same(pairs, found, ["anchor", "anchor_mark", "positive_score"]))
    return out.select(
        pairs["anchor"].alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("negative").alias("negative_id"), pairs["positive_score"], "negative_score"
    )


SQL = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}),
neg AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS rank
  FROM pos JOIN pairs USING (anchor_id)
  WHERE NOT alike AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= {NEGATIVES}
"""


@query("op11_hard_negatives", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has a wrong label."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    rows = rows_of(vectors, label)
    return hard_negatives(rows, F.col("id") % 100 == 0)
