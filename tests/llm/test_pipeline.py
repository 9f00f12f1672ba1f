"""The stages one after the other, and the entry without them."""

from __future__ import annotations

import corpus_pipeline
from medloom.llm.common import read, stored
from .test_operators_llm import ODD, base_spans, brute_print, brute_repeats

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_the_columns(spark):
    docs = read(spark, SF, "documents")
    kind, before = docs.dtypes, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, before, SF), name)
        assert after.dtypes == kind, name
        ids, old = {r[0] for r in after.select("doc_id").collect()}, {r[0] for r in before.select("doc_id").collect()}
        assert ids <= old
        texts = {r["doc_id"]: r["text"] for r in after.collect()}
        was = {r["doc_id"]: r["text"] for r in before.collect()}
        if name == "simhash_near_dedup":
            prints = {i: brute_print(t, 4) for i, t in was.items()}
            assert all((prints[a] ^ prints[b]).bit_count() > 4 for a in ids for b in ids if a < b)
            assert all(any((prints[a] ^ prints[b]).bit_count() <= 4 for b in old if b != a) for a in old - ids)
        if name == "suffix_array_dedup":
            want = brute_repeats(list(was.items()), 100)
            for i, t in texts.items():
                assert abs(len(t.encode()) - (want[i][0] - want[i][1])) <= 6 * (want[i][2] + 1)
        if name == "pii":
            assert all(base_spans(t) == [] for t in texts.values())
            assert all(texts[i] == t for i, t in was.items() if not base_spans(t))
        before = after
    packed = corpus_pipeline.run(spark, SF)
    assert {r[0] for r in packed.select("doc_id").collect()} == ids


def test_stages_on_odd_rows_and_names(spark):
    """Nulls, empty and repeated rows, ties and columns named like those of the operators, through all stages."""
    prose = "The river runs under the old stone bridge and people walk there in the evening, write to joe.smith@example.org please. " * 3
    rows = [(i, t, "x", "e", k) for k, (i, t) in enumerate(ODD + [(70, prose), (70, prose), (71, prose), (72, prose + " x"), (None, prose)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, `a.b` string, _mark int")
    docs = docs.selectExpr("*", "1 AS root", "'s' AS _spans", "0 AS n", "text AS found")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = stored(stage(spark, frame, SF), name)
            assert after.columns == docs.columns and after.count() <= frame.count(), name
            frame = after
        packed = stored(corpus_pipeline.STAGES[-1][1](spark, frame, SF), "packed")
        assert packed.select("doc_id").distinct().count() == frame.select("doc_id").distinct().count()
    kept = corpus_pipeline.near_dedup_stage(spark, docs, SF).collect()
    assert sorted(r["doc_id"] for r in kept if r["text"] and r["text"].startswith("The river")) == [70]


def test_every_operator_is_registered(spark):
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert entry.oracle_sql().keys() <= names.keys()
