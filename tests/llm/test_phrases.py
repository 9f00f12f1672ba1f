"""Phrase mining against counting every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from medloom.llm import phrases

VOCAB = "the of and a river stone blue walks über CAFÉ niño 42".split()


def corpus(n, seed):
    r = random.Random(seed)
    rows = [(i, "".join(r.choice(VOCAB) + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "; "]) for _ in range(r.randint(0, 40))), r.choice(["en", "fr", None])) for i in range(n)]
    rows += [(900 + i, "Blue river walks the stone", "en") for i in range(12)] + [(None, "a a a a a", "de")] * 3 + [(1000, None, "en"), (1001, "", None), (1002, "the " * 500, "en")]
    return rows


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
    out = {}
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, w), a in cands.items():
        inside = [b for (x, v), b in cands.items() if x == lang and len(v) > len(w) and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if any(100 * b >= 80 * a for b in inside):
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), a, l, r, n[lang], score))
    return {(lang, k): x[2:] for lang, rows in out.items() for k, x in enumerate(sorted(rows)[:top], 1)}


@pytest.mark.parametrize("share,sampled", [(0.3, 1), (0.0, 1), (1.0, 1), (0.5, 40)])
def test_any_sample_gives_every_phrase(spark, share, sampled):
    rows = corpus(150, 3)
    df = spark.createDataFrame([(i, t, g, 7, "x", 1) for i, t, g in rows], "doc_id long, text string, lang string, key int, phrase string, n int").repartition(5)
    got = phrases.collocations(df, least=6, top=40, share=share, sampled_least=sampled).collect()
    assert {(r["lang"], r["rank"]): (r["phrase"].encode(), r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == brute(rows, 6, 4, 40)


@pytest.mark.parametrize("parts", [1, 24])
def test_a_text_is_cut_out_of_few_tasks(spark, monkeypatch, parts):
    """However many tasks hold a frequent phrase, about one row gives its text."""
    rows = [(i, f"the river walks a blue stone. {VOCAB[i % 12]} of {VOCAB[i // 12 % 12]}", "en") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts, "doc_id")
    made, plain = [], type(df).mapInArrow

    def counting(self, func, schema, *args, **options):
        if "phrase string" not in schema:
            return plain(self, func, schema, *args, **options)
        made.append(spark.sparkContext.accumulator(0))
        total = made[-1]

        def run(batches):
            for b in func(batches):
                total.add(b.filter(pc.greater(b["words"], 0)).num_rows)
                yield b

        return plain(self, run, schema, *args, **options)

    monkeypatch.setattr(type(df), "mapInArrow", counting)
    found = phrases.frequent(df, 30, 4)
    n = found.filter("words > 0").count()
    assert n > 30 and n <= sum(x.value for x in made) < 3 * n


def test_phrases_of_one_digest_are_counted_apart(spark, monkeypatch):
    """As if another phrase, counted with them, had the digest of each third phrase, and as if the text of some were not found."""
    rows, plain = corpus(150, 3), phrases.counted

    def collided(docs, longest, proposals):
        out = plain(docs, longest, proposals)
        if not proposals:
            return out
        hit, lost = F.col("key") % 3 == 0, F.col("key") % 5 == 1
        return out.select("key", (F.col("n") + F.when(hit, 4).otherwise(0)).alias("n"), (F.col("proof") + F.when(hit, 12345).otherwise(0)).alias("proof"),
                          F.when(lost, 40).otherwise(F.col("mark")).cast("int").alias("mark"))

    monkeypatch.setattr(phrases, "counted", collided)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = phrases.collocations(df, least=6, top=40).collect()
    assert {(r["lang"], r["rank"]): (r["phrase"].encode(), r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == brute(rows, 6, 4, 40)


def test_two_texts_of_a_digest_are_doubtful(spark):
    known = spark.createDataFrame([(1, 6, 42, 0), (2, 6, 42, 0), (3, 6, 41, 0), (4, 6, 42, 0)], "key long, n long, proof long, mark int")
    texts = spark.createDataFrame(
        [(1, 7, "en", 1, "a", 2), (2, 7, "en", 1, "b", 2), (2, 7, "fr", 1, "b", 1), (3, 7, "en", 1, "c", 2), (9, 0, "en", 0, "", 9)],
        "key long, proof long, lang string, words int, phrase string, n long",
    )
    got = {r["key"]: (r["n"], r["phrase"], r["sure"]) for r in phrases.named(known, texts).collect()}
    assert got[1] == (6, "a", True) and not any(got[k][2] for k in (2, 3, 4)) and len(got) == 4


def test_marks_are_the_same_in_spark(spark):
    keys, marks = np.array([1, -1, 1 << 62, -(1 << 63) + 12345], np.int64), np.array([0, 1, 31, 17], np.uint8)
    df = spark.createDataFrame(list(zip(keys.tolist(), marks.tolist())), "key long, mark int")
    got = [r["key"] for r in phrases.marked_keys(df).collect()]
    assert got == phrases.marked(keys.view(np.uint64), marks).view(np.int64).tolist()


def test_empty_tables_give_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert phrases.collocations(df).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None), (2, " .\t", "en")], df.schema), least=1).count() == 0


def test_scores_stay_exact_beyond_64_bits(spark, monkeypatch):
    a, l, r = 9_223_372_036_854, 9_223_372_036_854_775_000, 9_223_372_036_854_775_001
    found = spark.createDataFrame([("en", 0, "", l), ("en", 1, "x", l), ("en", 1, "y", r), ("en", 2, "x y", a)], "lang string, words int, phrase string, n long")
    monkeypatch.setattr(phrases, "frequent", lambda *args, **options: found)
    row = phrases.collocations(None).first()
    assert row["score"] == 2_000_000 * a // (l + r) and (row["l"], row["r"]) == (l, r)


def test_runs_do_not_depend_on_the_chunk(monkeypatch):
    texts = [t or "" for _, t, _ in corpus(40, 5)] + ["no end of a piece " * 50]
    batch = pa.RecordBatch.from_arrays([pa.array([t + "\n" for t in texts]), pa.array(["en", "fr"] * (len(texts) // 2) + ["en"] * (len(texts) % 2))], ["text", "lang"])

    def seen(chunk):
        monkeypatch.setattr(phrases, "CHUNK", chunk)
        out = Counter()
        for words, _, _, seed in phrases.runs(batch):
            for m, d in enumerate(words.digests(seed, 4), 1):
                out.update(d[words.phrases(m)].tolist())
                at = np.flatnonzero(words.phrases(m))
                text = words.close.tobytes()
                assert all(text[a:z].count(b" ") == m - 1 for a, z in zip(words.begin[at], words.stop[at + m - 1]))
        return out

    assert seen(1 << 20) == seen(64) == seen(1)
