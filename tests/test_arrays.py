"""Large JSON arrays cut into ranges."""

import io
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartloom.sources import arrays, readers


def made(seed):
    """A random array whose texts hold everything that could be taken for structure."""
    r = random.Random(seed)
    pieces = ['"', "\\", "\\\\", '\\"', ",", "[", "]", "{", "}", "é", "\U0001f600", "\n", " ", "x", "],[", '","']

    def value(depth):
        kind = r.randrange(7 if depth < 4 else 4)
        if kind < 2:
            return "".join(r.choice(pieces) for _ in range(r.randrange(8)))
        if kind == 2:
            return r.choice([None, True, 0, -1.5e10])
        if kind == 3:
            return "\\" * r.randrange(6)
        if kind < 6:
            return {"".join(r.choice(pieces) for _ in range(r.randrange(3))): value(depth + 1) for _ in range(r.randrange(3))}
        return [value(depth + 1) for _ in range(r.randrange(4))]

    return [value(0) for _ in range(r.randrange(12))]


def cut(data, size, block):
    """All elements, range by range, with the states that the sums give."""
    source = pa.PythonFile(io.BytesIO(data), mode="r")
    found, inside, depth = [], False, 0
    for start in range(0, len(data), size):
        stop = min(len(data), start + size)
        found += list(arrays.elements(source, start, stop, inside, depth, block))
        flips, outside, within = arrays.summed_up(source, start, stop, block)
        depth += within if inside else outside
        inside = bool((flips + inside) % 2)
    return found


@pytest.mark.parametrize("seed", range(60))
def test_ranges_give_the_elements_of_a_whole_read(seed):
    docs = made(seed)
    r = random.Random(seed)
    text = json.dumps(docs, ensure_ascii=r.random() < 0.5, indent=r.choice([None, 1]))
    data = r.choice([b"", b"\xef\xbb\xbf", b"\n "]) + text.encode() + r.choice([b"", b"\n"])
    for size, block in ((1, 1), (2, 3), (7, 5), (64, 16), (1 << 20, 1 << 20)):
        assert [json.loads(t) for t in cut(data, size, block)] == docs


def test_what_is_no_array():
    assert cut(b"[]", 1, 1) == cut(b" [ \n ] ", 2, 1) == cut(b" \n", 1, 1) == []
    assert cut(b"[1,,2]", 2, 2) == [b"1", b"", b"2"]  # the parser refuses the blank element
    for bad in (b'{"a": [1, 2]}', b"1", b"[1, 2", b'["a, b]', b"[[1]"):
        for size in (1, 4, 100):
            with pytest.raises(arrays.NotAnArray):
                cut(bad, size, 3)


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    docs = [{"id": i, "note": '],["\\' * (i % 5), "in": [{"x": i}, []]} for i in range(20_000)]
    folder = tmp_path / "a folder %41"
    folder.mkdir()
    (folder / "one.json").write_text(json.dumps(docs))
    (folder / "empty.json").write_text("")
    (folder / "none.json").write_text("[]")
    found = arrays.element_texts(spark, str(folder), size=50_000)
    docs_back = found.select(F.spark_partition_id().alias("task"), F.parse_json("value").alias("doc"))
    rows = docs_back.select("task", F.variant_get("doc", "$.id", "long").alias("id"), F.variant_get("doc", "$.note", "string").alias("note"))
    got = rows.collect()
    assert sorted((r.id, r.note) for r in got) == [(d["id"], d["note"]) for d in docs]
    assert len({r.task for r in got}) > 5
    whole = readers.json_arrays(spark, str(folder))
    assert whole.count() == 20_000 and whole.columns == ["doc"]


def test_compressed_arrays_are_read_whole(spark, tmp_path):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'[{"id": 1}, {"id": 2}]'))
    (tmp_path / "b.json").write_text('[{"id": 3}]')
    (tmp_path / "blank.json.gz").write_bytes(gzip.compress(b""))
    got = readers.json_arrays(spark, str(tmp_path)).select(F.variant_get("doc", "$.id", "int").alias("id")).collect()
    assert sorted(r.id for r in got) == [1, 2, 3]


def test_other_file_systems_are_left_to_spark(spark, tmp_path, monkeypatch):
    (tmp_path / "b.json").write_text('[{"id": 3}, {"id": 4}]')
    monkeypatch.setattr(arrays, "RANGED", ())
    assert not arrays.ranged(spark, str(tmp_path))
    assert readers.json_arrays(spark, str(tmp_path)).count() == 2


def test_a_bad_compressed_array_is_refused(spark, tmp_path):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'[{"id": 1}, {"id"'))
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_arrays(spark, str(tmp_path)).count()
