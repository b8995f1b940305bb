"""JSON array files, each read by as many tasks as it has ranges of bytes.

An array cannot be cut at line ends, and a byte alone does not say whether it lies in
a text. So every range is first summed up under both assumptions (it starts outside of
a text, or inside): how often texts open or close in it, and how deep the nesting is
changed. Running sums over these few rows, one a range, give each range its true start.
Then each task cuts its range at the commas of the outermost level and reads on to the
end of its last element. Bytes are read twice and never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE = 32 << 20
BLOCK = 4 << 20
#: Texts are handed to Spark in batches of about this many bytes.
BATCH = 1 << 20
#: More tasks than this take several ranges each.
MOST_TASKS = 10_000

OPEN, CLOSE, COMMA = 1, 2, 3
KINDS = np.zeros(256, np.uint8)
KINDS[[ord("["), ord("{")]] = OPEN
KINDS[[ord("]"), ord("}")]] = CLOSE
KINDS[ord(",")] = COMMA
STEP = np.array([0, 1, -1, 0], np.int64)
BLANK = b" \t\r\n"


#: Suffixes of files that Spark decompresses; they cannot be cut.
COMPRESSED = ("gz", "bz2", "zst", "lz4", "snappy", "deflate")
#: File systems that tasks can read by byte range.
RANGED = ("file", "hdfs", "viewfs", "gs", "abfs", "abfss", "s3")


class NotAnArray(ValueError):
    pass


def opened(path: str) -> pa.NativeFile:
    """A file of Spark's listing for reading at any place."""
    from pyarrow import fs

    if re.match(r"file:/|/", path):
        return fs.LocalFileSystem().open_input_file(re.sub(r"\Afile:/+", "/", path))
    system, place = fs.FileSystem.from_uri(quote(path, safe=":/@"))
    return system.open_input_file(place)


def ranged(spark: SparkSession, path: str) -> bool:
    """Whether the file system of ``path`` is one of ``RANGED``."""
    context = spark.sparkContext
    system = context._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(context._jsc.hadoopConfiguration())
    return system.getUri().getScheme() in RANGED


def escaped_at(source: pa.NativeFile, start: int) -> bool:
    """Whether the bytes before ``start`` end in an odd number of backslashes."""
    run, step = 0, 1024
    while start > 0:
        size = min(step, start)
        before = source.read_at(size, start - size)
        tail = len(before) - len(before.rstrip(b"\\"))
        run += tail
        if tail < size:
            break
        start -= size
    return run % 2 == 1


def marks(data: np.ndarray, inside: bool, escaped: bool) -> tuple[np.ndarray, np.ndarray, int, bool]:
    """Places and kinds of brackets and commas outside of texts, the number of quotes that
    open or close one, and whether the byte after ``data`` is escaped."""
    slash = data == 0x5C
    quotes = np.flatnonzero(data == 0x22)
    if escaped or slash.any():
        index = np.arange(len(data), dtype=np.int64)
        last = np.maximum.accumulate(np.where(slash, -1, index))  # the last byte up to here that is no backslash
        before = np.where(quotes > 0, last[quotes - 1], -1)
        odd = ((quotes - 1 - before) % 2 == 1) ^ ((before < 0) & escaped)
        quotes = quotes[~odd]
        ends = (len(data) - 1 - last[-1]) % 2 == 1
        escaped = bool(ends ^ (last[-1] < 0 and escaped))
    found = KINDS[data]
    places = np.flatnonzero(found)
    outside = (np.searchsorted(quotes, places) + inside) % 2 == 0
    places = places[outside]
    return places, found[places], len(quotes), escaped


def summed_up(source: pa.NativeFile, start: int, stop: int, block: int = BLOCK) -> tuple[int, int, int]:
    """Quotes of a range, and its change of depth if it starts outside or inside of a text."""
    flips, change, escaped = 0, [0, 0], escaped_at(source, start)
    for at in range(start, stop, block):
        data = np.frombuffer(source.read_at(min(block, stop - at), at), np.uint8)
        after = escaped
        for inside in (False, True):
            _, kinds, quotes, after = marks(data, bool((flips + inside) % 2), escaped)
            change[inside] += int(STEP[kinds].sum())
        flips, escaped = flips + quotes, after
    return flips, change[0], change[1]


def elements(source: pa.NativeFile, start: int, stop: int, inside: bool, depth: int, block: int = BLOCK) -> Iterator[bytes]:
    """Texts of the elements that begin in a range: after its ``[`` or one of its commas
    on the outermost level. The last one is read to its end, wherever that is."""
    at, escaped, held, first = start, escaped_at(source, start), None, False
    if start == 0 and source.read_at(64, 0).removeprefix(b"\xef\xbb\xbf").lstrip(BLANK)[:1] not in (b"[", b""):
        raise NotAnArray("the file does not start with an array")
    while True:
        raw = source.read_at(block, at)
        if not raw:
            if held is not None:
                raise NotAnArray("the array does not end")
            return
        places, kinds, quotes, escaped = marks(np.frombuffer(raw, np.uint8), inside, escaped)
        inside = bool((quotes + inside) % 2)
        depths = depth + np.cumsum(STEP[kinds])
        border = np.where(kinds == CLOSE, depths == 0, depths == 1)
        since = 0
        for place, kind in zip(places[border].tolist(), kinds[border].tolist()):
            if held is not None:
                held.append(raw[since:place])
                text = b"".join(held).strip(BLANK)
                if text or kind == COMMA or not first:  # nothing between [ and ] is no element
                    yield text
                held = None
            if kind != CLOSE:
                if at + place >= stop:
                    return
                held, first, since = [], kind == OPEN, place + 1
        if held is not None:
            held.append(raw[since:])
        depth = int(depths[-1]) if len(depths) else depth
        at += len(raw)
        if held is None and at >= stop:
            return


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        for r in rows:
            with opened(r["path"]) as source:
                r["flips"], r["change_outside"], r["change_inside"] = summed_up(source, r["start"], r["stop"])
        names = ("path", "start", "flips", "change_outside", "change_inside")
        yield pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in names})


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            with opened(r["path"]) as source:
                held, size = [], 0
                for text in elements(source, r["start"], r["stop"], r["inside"], r["depth"]):
                    held.append(text.decode("utf-8"))
                    size += len(text)
                    if size >= BATCH:
                        yield pa.RecordBatch.from_pydict({"value": held})
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pydict({"value": held})


def ranges(spark: SparkSession, path: str, size: int) -> DataFrame:
    """``path, start, stop, inside, depth``: the ranges of all files, each with the state at its start."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    files = files.where((F.col("length") > 0) & ~F.lower(F.substring_index("path", ".", -1)).isin(*COMPRESSED))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(size).cast("long")))
    cut = files.select("path", "length", starts.alias("start"))
    cut = cut.select("path", "start", F.least("length", F.col("start") + size).alias("stop"), (F.col("length") > F.col("start") + size).alias("cut"))
    tasks = files.agg(F.sum(F.ceil(F.col("length") / size))).first()[0] or 1
    tasks = min(int(tasks), MOST_TASKS)
    sums = cut.where("cut").repartition(tasks).mapInArrow(
        _summaries, "path string, start long, flips long, change_outside long, change_inside long"
    )
    earlier = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.join(sums, ["path", "start"], "left")
    placed = placed.withColumn("inside", F.coalesce(F.sum("flips").over(earlier) % 2 == 1, F.lit(False)))
    change = F.when(F.col("inside"), F.col("change_inside")).otherwise(F.col("change_outside"))
    depth = F.coalesce(F.sum("change").over(earlier), F.lit(0).cast("long"))
    placed = placed.withColumn("change", change).withColumn("depth", depth)
    return placed.select("path", "start", "stop", "inside", "depth").repartition(tasks)


def element_texts(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """Column ``value``: the text of every element of the arrays below ``path``.

    Files are UTF-8 and hold one array each; blank files hold none, compressed ones are left out. A
    file that starts with anything else, or ends inside its array, is refused.
    """
    return ranges(spark, path, size).mapInArrow(_texts, "value string")
