"""Line dedup against plain Python, with filters far too small too."""

import pytest

from cartloom.llm import lines

LONG, OTHER = "This line is long enough to count.", "Äöü äöü äöü äöü äöü!"


def plain(rows):
    keys = {}
    for i, t in rows:
        for k in lines.line_keys(t, 20):
            if k is not None:
                keys.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        drop = [k is not None and len(keys[k]) >= 3 and i != max((x for x in keys[k] if x is not None), default=None) for k in lines.line_keys(t, 20)]
        kept = None if t is None else "\n".join(x for x, d in zip(t.split("\n"), drop) if not d)
        out.append((i, kept if any(drop) else t, len(drop), sum(drop)))
    return out


ROWS = [
    (1, f"{LONG}\nown text one\n {LONG.upper()} "), (2, f"\t{LONG.lower()}\r"), (3, f"x\n{LONG}\n{LONG}\ny"), (4, None), (5, ""), (6, "\n\n"),
    (7, OTHER), (8, OTHER + "\x0b"), (9, f"{OTHER}\nshort"), (9, f"{OTHER}\nsame id"), (10, "only nineteen chars"), (11, "only nineteen chars"), (12, "only nineteen chars"),
    (None, LONG), (13, "twice in two documents here"), (14, "twice in two documents here\n" * 4), (15, "z" * 200_000 + "\n" + LONG), (2, f"\t{LONG.lower()}\r"),
]


@pytest.mark.parametrize("max_bits", [1 << 30, 1 << 16])
def test_rows(spark, max_bits):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("'a' AS id", "'b' AS row", "doc_id", "'c' AS n_lines", "text", "'d' AS key").repartition(4)
    out = lines.dedup_lines(docs, max_bits=max_bits)
    assert out.columns == ["id", "row", "doc_id", "text", "key", "n_lines", "n_dropped"]
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()), key=repr)
    assert got == sorted(plain(ROWS), key=repr)
    assert {(r.id, r.row, r.key) for r in out.collect()} == {("a", "b", "d")}
    assert lines.dedup_lines(docs.where("false")).count() == 0


def test_saturated_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(lines, "PROBES", 1)
    monkeypatch.setattr(lines, "BITS_PER_LINE", 0)
    rows = ROWS + [(100 + k, f"line number {k} that is found here\n{LONG}") for k in range(300)]
    got = lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got), key=repr) == sorted(plain(rows), key=repr)
