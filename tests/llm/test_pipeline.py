"""The pipeline stage by stage against plain versions of what each stage decides."""

from itertools import combinations

from test_benchmarks import plain as contaminated
from test_lines import plain as without_repeats
from test_simhash import groups, plain_fingerprint

import corpus_pipeline
from cartloom.llm import benchmarks, language, lines, mixing, simhash

PATH = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{PATH}/benchmark.parquet").collect()]
    extra = spark.createDataFrame([(900001, None, "en", "src1", 0), (900002, "12 34 !!", "en", "src1", 8)], docs.schema)
    at, seen = docs.unionByName(extra), []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.durable(stage(spark, at, PATH))
        if name != "source_mix":
            assert out.columns == docs.columns
        before = [(r.doc_id, r.text) for r in at.collect()]
        after = sorted((r.doc_id, r.text) for r in out.collect())
        if name == "language_id":
            model = language.learn(at)
            want = [(d, t) for d, t in before if model.predict(t)[0] != "und" and model.predict(t)[1] >= language.MIN_SCORE]
            assert not {900001, 900002} & {d for d, _ in after} and len(after) >= 0.95 * docs.count()
        elif name == "line_dedup":
            want = [(d, t) for d, t, _, _ in without_repeats(before)]
        elif name == "simhash":
            fp = {d: plain_fingerprint(t) for d, t in before}
            root = groups(sorted(fp), [(a, b) for a, b in combinations(sorted(fp), 2) if (fp[a] ^ fp[b]).bit_count() <= 4])
            want = [(d, t) for d, t in before if root[d] == d]
        elif name == "decontaminate":
            bad = contaminated(before, items)
            want = [x for x in before if x not in bad]
        else:
            taken = {r.doc_id for r in mixing.selection(at).collect()}
            want = [(d, t) for d, t in before if d in taken]
        assert after == sorted(want), name
        seen.append(len(after))
        at = out
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0


def test_no_row_is_lost_to_a_shared_id(spark):
    """Rows of one id and unlike texts, equal texts in two sources, repeated rows, columns with private names."""
    words = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(1, words(1), "en", "src1"), (1, words(2), "en", "src1"), (2, words(3), "en", "src1"), (2, words(3), "de", "src2"), (3, words(1), "en", "src1")]
    rows += [(4, words(5), "en", "src1")] * 3 + [(None, words(6), "en", "src1"), (5, None, "en", None)]
    names = ["_id", "_mark", "_n", "mark", "n", "id", "_row_id", "_thin", "_held", "_lost", "_made", "_place", "_copies", "row", "drops", "_guess", "fp"]
    docs = spark.createDataFrame([(*r, *[k] * len(names)) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} long" for n in names))
    order = lambda x: sorted(x, key=repr)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    # 1 and 3 share a text; of equal rows one stays; the other text of id 1 stays
    want = [(1, words(1)), (1, words(2)), (2, words(3)), (4, words(5)), (5, None), (None, words(6))]
    assert order((r.doc_id, r.text) for r in kept.collect()) == order(want)
    mixed = mixing.mix(docs, share=1.0, weights={}, epochs=1)
    assert mixed.columns == [*docs.columns, "n_epochs"]
    assert order((r.doc_id, r.text, r.lang) for r in mixed.collect()) == order({r[:3] for r in rows})
    items = spark.createDataFrame([("a", words(5))], "item_id string, text string")
    clean = benchmarks.decontaminate(docs, items)
    assert clean.columns == docs.columns and order((r.doc_id, r.text) for r in clean.collect()) == order(r[:2] for r in rows if r[0] != 4)
    assert lines.dedup_lines(docs).columns == [*docs.columns, "n_lines", "n_dropped"]
    assert lines.dedup_lines(docs, min_docs=2).count() == len(rows)
    found = language.identify(docs, language.learn(docs))
    assert found.columns == [*docs.columns, "lang_pred", "score"] and found.count() == len(rows)
