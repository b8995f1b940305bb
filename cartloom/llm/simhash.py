"""SimHash near-dedup: an inverted index on byte positions, count filtering, and verification."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartloom.llm.common import attach, durable, fresh, once, query, table
from cartloom.llm.graph import components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: Fingerprints of one posting list that one step compares; longer lists are cut into blocks.
BLOCK = 2048
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of the whole text, 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    starts = starts[: len(stops)].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(stops), CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[k : k + CHUNK], stops[k : k + CHUNK])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(stops), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, mark, fp``: fp is the fingerprint as a signed long, mark a hash of the text."""
    kind = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), T.StructField("mark", T.LongType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64), pa.int64())], kind.names)

    return docs.select(F.col(doc_id).alias("doc_id"), text_mark(docs, text).alias("mark"), F.col(text).alias("text")).mapInArrow(run, kind)


def text_mark(docs: DataFrame, text: str = "text"):
    return F.xxhash64(docs[text], docs[text].isNull())


def byte_triples() -> list[tuple[int, int, int]]:
    """Byte positions by threes, so that any four of the eight hold one of the twenty triples.

    The positions are dealt to three parts in a ring; a triple lies in one part, or has
    two positions in a part and one in the next.
    """
    part = [p % 3 for p in range(8)]
    out = []
    for t in combinations(range(8), 3):
        held = [sum(part[p] == k for p in t) for k in range(3)]
        if 3 in held or any(held[k] == 2 and held[(k + 1) % 3] == 1 for k in range(3)):
            out.append(t)
    return out


def _postings(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of their byte, per column, and the bytes in that order."""
    order = byte.argsort(axis=0, kind="stable")
    return order, np.take_along_axis(byte, order, axis=0)


def _posting(order: np.ndarray, value: np.ndarray, byte: np.uint8) -> np.ndarray:
    """Rows that hold the byte."""
    return order[value.searchsorted(byte, "left") : value.searchsorted(byte, "right")]


def _forest(fp: np.ndarray, node: np.ndarray, held: tuple[int, ...], max_bits: int) -> Iterator[tuple[int, int]]:
    """Edges that span the linked groups among these fingerprints, which share the bytes at ``held``.

    The other positions have posting lists here. Those of a fingerprint's own bytes tally
    what each open fingerprint shares with it; only those that reach the least number of
    equal bytes are compared bit by bit. A fingerprint joins the first group that reaches
    it and is then closed, so a group of near copies costs about one pass.
    """
    byte = np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8)[:, [p for p in range(8) if p not in held]]
    order, value = _postings(byte)
    least = 8 - max_bits - len(held)
    open_, left = np.ones(len(fp), bool), len(fp)
    for first in range(len(fp)):
        if not open_[first]:
            continue
        open_[first], left, reached = False, left - 1, [first]
        while reached and left:
            at = reached.pop()
            met = np.concatenate([_posting(order[:, p], value[:, p], byte[at, p]) for p in range(byte.shape[1])])
            met = met[open_[met]]
            if not len(met):
                continue
            near = np.flatnonzero(np.bincount(met, minlength=len(fp)) >= least)
            near = near[np.bitwise_count(fp[near] ^ fp[at]) <= max_bits]
            for other in near:
                yield node[at], node[other]
            open_[near], left = False, left - len(near)
            reached.extend(near)


def _link(max_bits: int):
    """Rows sorted by (list, i, j): the spanning edges of every list or pair of blocks."""
    triples = byte_triples()

    def solve(rows: np.ndarray) -> tuple[list[int], list[int]]:
        fp = np.ascontiguousarray(rows[:, 3]).view(np.uint64)
        edges = list(_forest(fp, rows[:, 4], triples[int(rows[0, 0]) >> 24], max_bits))
        return [int(a) for a, _ in edges], [int(b) for _, b in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 5), np.int64)
        for batch in batches:
            rows = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64, copy=False)
            held = np.concatenate([held, rows]) if len(held) else rows
            if not len(held):
                continue
            cuts = np.flatnonzero((held[1:, :3] != held[:-1, :3]).any(axis=1)) + 1
            a, b = [], []
            for part in _several(held, cuts):
                x, y = solve(part)
                a += x
                b += y
            held = held[cuts[-1] :] if len(cuts) else held
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if len(held) > 1:
            a, b = solve(held)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _several(rows: np.ndarray, cuts: np.ndarray) -> Iterator[np.ndarray]:
    """The finished groups of at least two rows."""
    starts = np.append(0, cuts[:-1]) if len(cuts) else cuts
    for k in np.flatnonzero(cuts - starts > 1):
        yield rows[starts[k] : cuts[k]]


def links(classes: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges ``a, b`` (nodes) that connect all fingerprints at ``max_bits`` or fewer bits.

    ``classes`` is stored and has one row ``fp, node`` per distinct fingerprint. Two
    such fingerprints share at least four of eight bytes in place. Posting lists of
    single bytes hold 1/256 of all rows, so lists are kept for byte triples chosen such
    that any four shared bytes meet in at least one. A list knows three shared bytes of
    its pairs; inside it, posting lists of the other five positions tally the rest, and
    only pairs that reach the least number of equal bytes (eight less ``max_bits``) are
    verified bit by bit. Links that a group does not need to stay connected are not listed.

    A list longer than ``block`` is cut into blocks by hash, and every pair of blocks is
    a group of its own: nothing is skipped and no task holds a long list.
    """
    if max_bits > 4:
        raise ValueError("the triples cover four differing bits")
    byte = [F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255)) for p in range(8)]
    keys = [F.lit(k << 24) + byte[a] * 65536 + byte[b] * 256 + byte[c] for k, (a, b, c) in enumerate(byte_triples())]
    entries = durable(classes.select(F.explode(F.array(*keys)).alias("list"), "fp", "node"))
    sizes = entries.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > block)
    long = durable(sizes.withColumn("blocks", F.ceil(F.col("n") / block)))
    rows = attach(entries, long, ["list"], "n")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    firsts = F.transform(F.sequence(F.lit(0).cast("long"), own), lambda i: F.struct(i.alias("i"), own.alias("j")))
    rest = F.transform(F.sequence(own, F.col("blocks") - 1), lambda j: F.struct(own.alias("i"), j.alias("j")))
    pairs = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"))))
    pairs = pairs.otherwise(F.array_distinct(F.concat(firsts, rest)))
    tasks = rows.select("list", F.inline(pairs), "fp", "node").repartition("list", "i", "j")
    return tasks.sortWithinPartitions("list", "i", "j").mapInArrow(_link(max_bits), "a long, b long")


def _placed(docs: DataFrame, doc_id: str, text: str, shingle: int, max_bits: int, block: int) -> DataFrame:
    """``doc_id, mark, fp, component_id, first_mark``: id and text mark of the first row of every row's component."""
    rows = durable(fingerprints(docs, doc_id, text, shingle))
    first = F.min(F.struct("doc_id", "mark"))
    known = rows.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(first.alias("first"), F.count("*").alias("n"))
    classes = durable(known)
    found = components(links(classes.select("fp", F.col("fp").alias("node")), max_bits, block))
    named = classes.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", "n", F.coalesce("component", "fp").alias("root"))
    named = durable(named)
    roots = durable(named.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("classes")))
    named = durable(attach(named, roots, ["root"], "classes").select("fp", F.col("least.doc_id").alias("component_id"), F.col("least.mark").alias("first_mark"), "n"))
    out = attach(rows, named, ["fp"], "n")
    return out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``doc_id, mark, fp, component_id`` for every row of ``docs``.

    Fingerprints at ``max_bits`` or fewer differing bits link, and component_id is the
    smallest doc_id that links reach. Equal fingerprints are one class; only classes are
    compared, and class results return to documents by ``attach``.

    NULL, empty and blank texts have fingerprint 0, which links like any other. Rows
    without doc_id link nothing and have no component_id; rows of equal doc_id all
    appear, each in the component of its own text; further columns are ignored; no rows
    give no rows.
    """
    return _placed(docs, doc_id, text, shingle, max_bits, block).drop("first_mark")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """``docs`` with one document of each component: the smallest id, of equal ids the smallest text hash.

    Rows of equal id and text are one document, of which one row stays. Rows of equal id
    and unlike texts are several, each judged in the component of its own text. A row
    without id is in no component and stays. Only the rows to be dropped or thinned are
    joined to the documents.
    """
    found = durable(_placed(docs, doc_id, text, shingle, max_bits, block))
    stays = F.col("doc_id").isNull() | ((F.col("doc_id") == F.col("component_id")) & (F.col("mark") == F.col("first_mark")))
    each = found.groupBy("doc_id", "mark").agg(F.bool_or(stays).alias("stays"), F.count("*").alias("n"))
    row_id, mark, thin = fresh(docs, "_row_id", "_mark", "_thin")
    special = durable(each.where(~F.col("stays") | (F.col("n") > 1)).select(F.col("doc_id").alias(row_id), F.col("mark").alias(mark), F.col("stays").alias(thin)))
    met = docs.join(special, docs[doc_id].eqNullSafe(F.col(row_id)) & (text_mark(docs, text) == F.col(mark)), "left")
    plain = met.where(F.col(thin).isNull()).select(*[docs[c] for c in docs.columns])
    if special.where(F.col(thin)).isEmpty():
        return plain
    again = once(met.where(F.col(thin)).drop(thin), [row_id, mark])
    return plain.unionByName(again.select(*[F.col(f"`{c}`") for c in docs.columns]))


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
