"""Line dedup: two Bloom filters find suspected repeats, only these shuffle for the exact decision."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import attach, durable, fresh, query, table

MIN_CHARS, MIN_DOCS = 20, 3
#: Bits per expected line, probes per line, and the largest filter (128 MB), which
#: bounds what is broadcast. Above it more lines are suspected; results stay the same.
BITS_PER_LINE, PROBES, MAX_BITS = 16, 4, 1 << 30
SEGMENT_BITS = 1 << 19

SPACE = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """Key of every line, None for one that is too short to be a repeat."""
    out = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(SPACE).lower()
        size = len(key)
        if size >= min_chars and size < 4 * min_chars:
            size = sum(b & 0xC0 != 0x80 for b in key)
        out.append(key if size >= min_chars else None)
    return out


def _hashes(texts: pa.Array, min_chars: int) -> np.ndarray:
    """Hashes of the distinct keys of every text, one after the other."""
    found = []
    for text in texts:
        found += [xxhash.xxh3_64_intdigest(k) for k in set(line_keys(text.as_py(), min_chars)) if k is not None]
    return np.array(found, dtype=np.uint64)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit positions for each hash."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (low + steps * high + (steps * steps) * np.uint64(0x9E3779B9)) & np.uint64(bits - 1)


def _set(flags: np.ndarray, places: np.ndarray) -> None:
    places = places.ravel()
    np.bitwise_or.at(flags, places >> np.uint64(3), (1 << (places & np.uint64(7))).astype(np.uint8))


def _held(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((flags[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _fill(bits: int, min_chars: int):
    """Filters of one task: a hash met once sets ``once``, met again it also sets ``twice``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            hashes, counts = np.unique(_hashes(batch.column(0), min_chars), return_counts=True)
            if len(hashes):
                places = _places(hashes, bits)
                again = _held(once, places) | (counts > 1)
                _set(twice, places[:, again])
                _set(once, places)
        pack = zstandard.ZstdCompressor(level=1).compress
        size = min(bits, SEGMENT_BITS) // 8
        for k in range(0, len(once), size):
            if once[k : k + size].any():
                parts = [pack(x[k : k + size].tobytes()) for x in (once, twice)]
                yield pa.RecordBatch.from_arrays([pa.array([k // size], pa.int32()), *[pa.array([p], pa.binary()) for p in parts]], ["segment", "once", "twice"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge rows sorted by segment: what two tasks both set in ``once`` counts as twice."""
    unpack = zstandard.ZstdDecompressor().decompress
    pack = zstandard.ZstdCompressor(level=1).compress
    at, once, twice = None, None, None

    def done():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([pack(twice.tobytes())], pa.binary())], ["segment", "twice"])

    for batch in batches:
        for segment, a, b in zip(*[c.to_pylist() for c in batch.columns]):
            a, b = (np.frombuffer(unpack(x), np.uint8) for x in (a, b))
            if segment == at:
                twice |= b | (once & a)
                once |= a
            else:
                if at is not None:
                    yield done()
                at, once, twice = segment, a.copy(), b.copy()
    if at is not None:
        yield done()


class Repeats:
    """The merged ``twice`` filter, unpacked once per Python worker."""

    loaded: dict = {}

    def __init__(self, parts, bits: int, name: str):
        self.parts, self.bits, self.name = parts, bits, name

    def flags(self) -> np.ndarray:
        if self.name not in Repeats.loaded:
            Repeats.loaded.clear()
            flags = np.zeros(self.bits // 8, np.uint8)
            size = min(self.bits, SEGMENT_BITS) // 8
            for segment, part in self.parts.value:
                flags[segment * size : (segment + 1) * size] = np.frombuffer(zstandard.ZstdDecompressor().decompress(part), np.uint8)
            Repeats.loaded[self.name] = flags
        return Repeats.loaded[self.name]

    def suspects(self, text: str | None, min_chars: int) -> set[bytes]:
        keys = [k for k in set(line_keys(text, min_chars)) if k is not None]
        if not keys:
            return set()
        held = _held(self.flags(), _places(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64), self.bits))
        return {k for k, h in zip(keys, held) if h}


def build_filter(texts: DataFrame, min_chars: int, max_bits: int = MAX_BITS) -> Repeats:
    """Filter of line keys that at least two rows of the one column of ``texts`` seem to hold."""
    column = F.col(texts.columns[0])
    lines = texts.agg(F.sum(F.length(column) - F.length(F.replace(column, F.lit("\n"))) + 1)).first()[0] or 0
    bits = 1 << 16
    while bits < min(max_bits, BITS_PER_LINE * lines):
        bits *= 2
    filled = texts.mapInArrow(_fill(bits, min_chars), "segment int, once binary, twice binary")
    merged = filled.repartition("segment").sortWithinPartitions("segment").mapInArrow(_merge, "segment int, twice binary")
    spark = texts.sparkSession
    parts = [(r.segment, bytes(r.twice)) for r in merged.collect()]  # at most max_bits / 8 bytes
    return Repeats(spark.sparkContext.broadcast(parts), bits, hashlib.sha256(repr((spark.sparkContext.applicationId, id(parts), lines)).encode()).hexdigest())


def _digest(key: bytes) -> bytes:
    return hashlib.sha256(key).digest()


def _list_suspects(repeats: Repeats, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for i, text in enumerate(batch.column(1)):
                for key in repeats.suspects(text.as_py(), min_chars):
                    ids.append(i)
                    keys.append(_digest(key))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int64())), pa.array(keys, pa.binary())], ["id", "key"])

    return run


def _has_suspects(repeats: Repeats, min_chars: int):
    """Whether a text holds a suspected line."""

    @F.arrow_udf(T.BooleanType())
    def has(texts: pa.Array) -> pa.Array:
        return pa.array([bool(repeats.suspects(t.as_py(), min_chars)) for t in texts], pa.bool_())

    return has


def _without(min_chars: int):
    """A text without the lines whose digests are listed, and the number of those lines."""

    @F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("n_dropped", T.LongType())]))
    def drop(texts: pa.Array, drops: pa.Array) -> pa.Array:
        kept, dropped = [], []
        for text, gone in zip(texts, drops):
            text, gone = text.as_py(), set(gone.as_py() or ())
            keep = [k is None or _digest(k) not in gone for k in line_keys(text, min_chars)] if gone else []
            kept.append("\n".join(line for line, k in zip(text.split("\n"), keep) if k) if gone else text)
            dropped.append(len(keep) - sum(keep))
        return pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(dropped, pa.int64())], ["text", "n_dropped"])

    return drop


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without repeated lines, and ``n_lines, n_dropped`` (which replace columns of that name).

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of
    at least ``min_chars`` code points in at least ``min_docs`` documents lose their
    lines except in the largest doc_id that holds them, where all of them stay. Other
    lines stay as they are, joined by a line feed.

    Every task fills two Bloom filters, merged by segment; only keys the second one
    knows are shuffled, as SHA-256 digests, to count documents and pick the largest
    id. Documents without such a key never move, and only texts go to Python.

    A NULL text has one line and stays NULL; rows of equal doc_id are one document
    when documents are counted; rows without doc_id are one document that is never the
    largest; an empty table gives no rows.
    """
    plain = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    repeats = build_filter(plain.select("text"), min_chars, max_bits)
    id_type = docs.schema[doc_id].dataType
    kind = T.StructType([T.StructField("id", id_type), T.StructField("key", T.BinaryType())])
    suspects = durable(plain.mapInArrow(_list_suspects(repeats, min_chars), kind).distinct())
    by_key = suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("keep"))
    confirmed = durable(by_key.where(F.col("n") >= min_docs))
    hits = attach(suspects, confirmed, ["key"], "n", how="inner").where(~F.col("id").eqNullSafe(F.col("keep")))
    drops = hits.groupBy(F.col("id").alias("_id")).agg(F.collect_list("key").alias("drops"))
    held, lost, made, row_id = fresh(docs, "_held", "_lost", "_made", "_row_id")
    marked = docs.withColumn(held, _has_suspects(repeats, min_chars)(docs[text]))
    drops = drops.select(F.col("_id").alias(row_id), F.col("drops").alias(lost))
    moved = marked.where(F.col(held))
    moved = moved.join(drops, moved[doc_id].eqNullSafe(F.col(row_id)), "left")
    moved = moved.withColumn(made, _without(min_chars)(F.col(text), F.col(lost)))
    n_lines = F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"))), F.lit(0)).cast("long") + 1
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    named = lambda new: [new.alias(text) if c == text else F.col(f"`{c}`") for c in own]
    changed = moved.select(*named(F.col(made)["text"]), n_lines.alias("n_lines"), F.col(made)["n_dropped"].alias("n_dropped"))
    still = marked.where(~F.col(held)).select(*named(F.col(f"`{text}`")), n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"))
    return changed.unionByName(still)


SQL = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id IS DISTINCT FROM r.keep AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@query("op6_line_dedup", SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and digest of every document after line dedup."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
