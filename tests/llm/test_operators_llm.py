"""Each operator against a brute-force version, and on nulls, empty and long texts, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from medloom.llm import collide, common, counts, packing, pieces, pii, quality, simhash, suffix, topk, toxicity

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
WORDS = "the of and a river stone blue walks über café niño 42 end. go, (so) http://x.y".split()
ODD = [
    (None, "no id at all"), (1, None), (2, ""), (3, " "), (4, "  two  spaces\n\n\tand more  "), (5, "▁mark ▁▁ x"), (6, "<s> </s> <0x0A>"),
    (7, "漢字 😀 é\x00z"), (8, "same"), (8, "same"), (9, "word " * 4000), (10, "x" * 30000), (11, "%%% !!! ..."), (12, "a,b.c;d"), (13, "'s it's 'll z"),
]


def prose(n, seed, size=60):
    r = random.Random(seed)
    return [(100 + i, " ".join(r.choice(WORDS) + str(r.randint(0, 50)) * r.randint(0, 1) for _ in range(r.randint(1, size)))) for i in range(n)]


def by_id(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(r)
    return out


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_pieces_are_decoded_in_one_run_and_each_by_itself_on_a_difference():
    ranks = counts.PieceRanks(PIECES)
    library, asked = ranks.library, []

    class Spy:
        encode = staticmethod(library.encode)

        @staticmethod
        def decode(ids):
            asked.append(ids)
            return library.decode(ids)

    ranks.library = Spy
    new = ["▁one", "▁▁two\n", "▁\u0001é", "▁", "▁three"]
    words = pieces.Words(ranks)
    words.learn(set(new))
    assert "".join(words.now[w][1] for w in new) == "".join(new)
    assert len(asked) == 1 and all(isinstance(i, int) for i in asked[0])  # not a list for every word
    checked = [w for w in new if w != "▁"]
    ids = [pieces.encode_word(w, ranks) for w in checked]
    words._check(checked, ids, checked)
    with pytest.raises(AssertionError, match="two"):
        words._check(checked, ids, ["▁one", "▁▁too", *checked[2:]])
    with pytest.raises(AssertionError, match="three"):
        words._check(checked, [*ids[:3], ids[0]], checked)


def test_pieces_and_counts_equal_the_library(spark, docs):
    rows, lib = ODD + prose(60, 1), SentencePieceProcessor(model_file=PIECES)
    coded, counted = by_id(pieces.encode_decode(docs(rows), PIECES, with_ids=True)), by_id(counts.token_counts(docs(rows), PIECES, limit=50))
    for i, t in rows:
        ids = lib.encode(t or "")
        for r in coded[i]:
            assert (r["ids"], r["n_tokens"], r["decoded"]) == (ids, len(ids), lib.decode(ids) if ids else "")
            assert (r["ids_sha256"], r["decoded_sha256"]) == (sha(",".join(map(str, ids))), sha(r["decoded"]))
        for r in counted[i]:
            assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (len(ids), len((t or "").encode()), len(ids) > 50)
    assert len(coded[8]) == 2 and pieces.encode_decode(docs([]), PIECES).count() == 0 == counts.token_counts(docs([]), PIECES).count()


def test_packing_keeps_every_token_in_few_sequences(spark, docs):
    rows, lib = ODD + [(30, "a <|endoftext|> b<|endoftext|>"), (31, "<|endoftext|>")] + prose(80, 2, 400), Tokenizer.from_file(BYTES)
    got = packing.pack(docs(rows), BYTES, capacity=256).toPandas()
    ids = {i: np.array([*lib.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for i, t in rows}
    for i, part in got.groupby("doc_id", dropna=False):
        own = ids[None if i != i else int(i)]
        for r in part.itertuples():
            assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        assert part.length.sum() == len(own) * (2 if i == 8 else 1) and (part[part.piece > 0].length == 256).all()
    at = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, seq in at:
        assert seq.offset.tolist() == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 256
    assert got.sequence_id.nunique() <= 1.02 * got.length.sum() / 256 + 2
    assert packing.pack(docs([]), BYTES).count() == 0


def test_a_sweep_places_each_piece_once():
    plan = packing.sweep({7: 5, 4: 3, 3: 9, 10: 2, 1: 6}, 10)
    fill = {}
    for k, (length, rank, first, offset) in enumerate(plan):
        n = (plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == length else {7: 5, 4: 3, 3: 9, 10: 2, 1: 6}[length]) - rank
        for b in range(first, first + n):
            fill.setdefault(b, []).append((offset, offset + length))
    for spans in fill.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 10
    assert len(fill) == -(-(35 + 12 + 27 + 20 + 6) // 10)


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(w)
        runs = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out[i] = (len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("heavy", [suffix.HEAVY, 3])
def test_repeats_equal_brute_force(spark, docs, heavy):
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcde é") for _ in range(n))
    passage, line = text(150), text(99)
    rows = [(i, text(r.randint(0, 150)) + passage[: r.randint(60, 150)] * r.randint(0, 2) + text(40)) for i in range(60)]
    rows += [(200 + i, passage) for i in range(20)] + [(300, "ab" * 400), (301, "z" * 5000), (302, line + line), (303, None), (304, ""), (None, passage)]
    rows += [(305, "".join(text(700) for _ in range(400)))]  # longer than a segment
    rows += [(306, rows[-1][1][1000:200_000])]
    got, want = by_id(suffix.remove_repeats(docs(rows), heavy=heavy)), brute_repeats(rows, 100)
    for i, w in want.items():
        assert [tuple(x)[1:] for x in got[i]] == [w], i
    cut = suffix.without_repeats(docs(rows))
    assert cut.columns == docs([]).columns and cut.filter("mark <> 'x' OR n <> 2").count() == 0
    assert suffix.remove_repeats(docs([])).count() == 0


def brute_print(t, words):
    w = (t or "").encode().lower().split()
    sh = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> k & 1 for s in sh) * 2 > len(sh) for k in range(64)]
    return sum(b << k for k, b in enumerate(bits))


@pytest.mark.parametrize("tile", [simhash.TILE, 4])
def test_near_duplicates_equal_brute_force(spark, docs, tile):
    rows = ODD + prose(40, 3) + [(500 + i, " ".join(t.split() + ["tail"] * (i % 3))) for i, (_, t) in enumerate(prose(40, 3, 400)) for _ in range(2)]
    prints = [(i, brute_print(t, 4)) for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    want = sorted((str(i), f"{p:016x}", str(least.get(find(k)))) for k, (i, p) in enumerate(prints))
    got = simhash.near_duplicates(docs(rows), tile=tile).collect()
    assert sorted((str(r[0]), r[1], str(r[2])) for r in got) == want
    left = simhash.without_near_duplicates(docs(rows))
    assert left.count() == len({find(k) for k in range(len(rows))}) and left.columns == docs([]).columns
    assert simhash.near_duplicates(docs([])).count() == 0


def test_links_of_a_crowded_cell_and_their_components(spark):
    r = random.Random(8)
    base, fps = r.getrandbits(64), set()
    for _ in range(300):
        f = base
        for _ in range(r.randint(0, 3)):
            f ^= 1 << r.randrange(64)
        fps.add(f)
    far = {r.getrandbits(64) for _ in range(100)}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    df = spark.createDataFrame([(signed(f),) for f in fps | far], "fp long")
    links = simhash.fingerprint_links(df, 4, tile=16)
    comp = {x["node"]: x["root"] for x in common.components(links, "a", "b").collect()}
    assert {signed(f) for f in fps} <= comp.keys() and len({comp[signed(f)] for f in fps}) == 1
    assert comp[signed(next(iter(fps)))] == min(k for k, v in comp.items() if v == comp[signed(next(iter(fps)))])


def vectors(spark, n=300, dim=12, seed=4):
    g = np.random.default_rng(seed)
    x = [(int(i), [float(np.float32(c)) for c in g.normal(size=dim) / 3]) for i in range(n)]
    bad = [(900, None), (901, [float("nan")] * dim), (902, [None] + [0.1] * (dim - 1)), (903, [float("inf")] * dim), (904, []), (905, [0.5]), (None, x[0][1])]
    zero = [(1000, [0.0] * dim)]
    twins = [(2000 + k, x[7][1]) for k in range(4)] + [(40, x[40][1])]
    return x, zero, twins, spark.createDataFrame([(i, v, 5) for i, v in x + zero + twins + bad], "vec_id long, embedding array<float>, cell int")


@pytest.mark.parametrize("sizes", [{}, {"chunk_rows": 32, "query_rows": 2, "pivots": 5}])
def test_top_k_equals_brute_force(spark, sizes):
    x, zero, twins, df = vectors(spark)
    got = topk.top_k(df, F.col("id") % 20 == 0, k=10, **sizes).collect()
    rows = [(i, np.floor(np.array(v, dtype=np.float32).astype(float) * 1024).astype(int)) for i, v in x + zero + twins]
    for q in {i for i, _ in rows if i % 20 == 0}:
        v = next(v for i, v in rows if i == q)
        want = sorted(((-int(v @ w), i) for i, w in rows if i != q))[:10]
        mine = sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])
        assert [(-r["score"], r["vec_id"]) for r in mine] == want and [r["rank"] for r in mine] == list(range(1, 11))
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0
    few = topk.top_k(df.filter("vec_id < 4"), F.col("id") == 0).collect()
    assert len(few) == 3


def test_vectors_of_each_length_are_searched(spark):
    rows = [(i, [float(i % 5 + 1), 0.5 * i, 1.0][: 2 + i % 2]) for i in range(1, 61)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = topk.top_k(df, F.col("id") % 20 == 0, k=3, scale=4).collect()
    near = collide.nearest(df, F.col("id") % 20 == 0, k=3, enough=1.0).collect()
    for q, v in rows[19::20]:
        same = [(i, w) for i, w in rows if i != q and len(w) == len(v)]
        by = lambda f: [i for _, i in sorted((-f(v, w), i) for i, w in same)[:3]]
        dot = lambda a, b: sum(x * y for x, y in zip(a, b))
        whole = lambda a: [int(np.floor(4 * x)) for x in a]
        assert [r["vec_id"] for r in sorted(exact, key=lambda r: r["rank"]) if r["query_id"] == q] == by(lambda a, b: dot(whole(a), whole(b)))
        assert [r["vec_id"] for r in sorted(near, key=lambda r: r["rank"]) if r["query_id"] == q] == by(dot)


def test_collision_search_recalls_and_scores_exactly(spark):
    x, zero, twins, df = vectors(spark, 2000, 24)
    got = collide.nearest(df, F.col("id") % 100 == 0, k=20, block_rows=600, query_rows=8).collect()
    rows = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in x + twins]
    hits = total = 0
    for q in {i for i, _ in rows if i % 100 == 0}:
        v = next(v for i, v in rows if i == q)
        want = {i for _, i in sorted((-float(v @ w), i) for i, w in rows if i != q)[:20]}
        mine = [r for r in got if r["query_id"] == q]
        hits, total = hits + len(want & {r["vec_id"] for r in mine}), total + 20
        assert len(mine) == 20
        for r in mine:
            assert abs(r["score"] - float(v @ next(w for i, w in rows if i == r["vec_id"]))) < 1e-12 and r["vec_id"] != q
    assert hits / total >= 0.9 and 1000 not in {r["query_id"] for r in got} - {1000 if any(i == 1000 for i, _ in rows) else -1}
    assert collide.nearest(df.limit(0), F.col("id") == 0).count() == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    luhn = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(p) < 256 for p in m.split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]


def base_spans(t):
    found = [(m.start(), k, m.end(), kind) for k, kind in enumerate(BASE) for m in re.finditer(BASE[kind], t) if valid(kind, m.group())]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def test_personal_data_equals_the_expressions(spark, docs):
    r = random.Random(3)
    bits = ["a", "1", "2", "55", "255", "256", ".", "..", "@", " ", "-", "+", "(", ")", "_", "x@y.z", "1.2.3.4", "4111 1111 1111 1111", "é", "😀", "\n", "12345678901", "%"]
    rows = ODD + [(100 + i, "".join(r.choice(bits) for _ in range(r.randint(0, 40)))) for i in range(600)]
    rows += [(5000, "a@b" + ".c" * 20000), (5001, "a" * 100000 + "@"), (5002, "1 " * 20000), (5003, "+1" * 10000)]
    got = by_id(pii.personal_data(docs(rows)))
    for i, t in rows:
        want = base_spans(t or "")
        for row in got[i]:
            assert row["base_sha256"] == sha(",".join(want)), t[:200]
            assert [row[f"n_{k}"] for k in BASE] == [sum(w.startswith(k) for w in want) for k in BASE]
            assert set(filter(None, row["spans"].split(","))) >= set(want)
    assert pii.personal_data(docs([])).count() == 0


def test_trusted_patterns_find_unseen_identifiers(spark, docs):
    seeds = [(i, f"reach me, hotline +1 (2{i:02d}) 555-12{i:02d} today please") for i in range(12)]
    new = [(50, "reach me, hotline 0049-555-123456 today please"), (51, "the sum was 1234567 in total")]
    got = by_id(pii.personal_data(docs(seeds + new)))
    t = new[0][1]
    s = t.index("0049")
    assert got[50][0]["spans"] == f"phone:{s}:{s + len('0049-555-123456')}" and got[50][0]["n_phone"] == 0
    assert got[51][0]["spans"] == ""
    masked = by_id(pii.masked(docs(seeds + new + [(None, "x@y.zz"), (60, None)])))
    assert masked[50][0]["text"] == "reach me, hotline [phone] today please" and masked[51][0]["text"] == new[1][1]
    assert masked[None][0]["text"] == "[email]" and masked[60][0]["text"] is None and masked[0][0]["mark"] == "x"


def test_quality_on_labelled_texts_and_odd_ones(spark, docs):
    frame, labels = common.read(spark, "/root/testdata/sf0.01", "documents"), common.read(spark, "/root/testdata/sf0.01", "labels")
    m = quality.scored(frame).join(labels, "doc_id").toPandas()
    assert ((m.keep) == (m.quality == 1)).mean() > 0.98 and m[m.quality == 1].keep.mean() > 0.99
    odd = by_id(quality.scored(docs(ODD)))
    assert len(odd) == len({i for i, _ in ODD}) and all(odd[i][0]["score"] == 0 and not odd[i][0]["keep"] for i in (1, 2, 3))
    assert quality.scored(docs([])).count() == 0 and quality.kept(docs(ODD)).columns == docs([]).columns


def test_toxicity_on_held_out_texts_and_odd_ones(spark, docs):
    frame, labels = common.read(spark, "/root/testdata/sf0.01", "documents"), common.read(spark, "/root/testdata/sf0.01", "labels")
    out = toxicity.toxic_scores(frame, labels).join(labels, "doc_id").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in out.doc_id]).all()
    held = out[out.held_out]
    toxic, clean = held[held.toxic == 1].score, held[held.toxic == 0].score
    auc = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert auc > 0.75 and ((out.score >= 0.3) == (out.predicted == 1)).all() and out.score.between(0, 1).all()
    some = spark.createDataFrame([(1, 1), (2, 0), (8, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.toxic_scores(docs(ODD), some).count() == len(ODD)
    assert toxicity.toxic_scores(docs(ODD), some.limit(0)).filter("score IS NULL").count() == 0
    assert toxicity.toxic_scores(docs([]), some).count() == 0


def test_the_grammar_marks_negation_report_and_target():
    g = toxicity.Grammar({"fool": 2.0}, np.zeros(len(toxicity.KINDS) + 1))
    kinds = lambda t: {toxicity.KINDS[i] for i in np.flatnonzero(g.matches(t))}
    assert kinds("a fool.") == {"insult"} and kinds("you fool.") == {"insult+"} and kinds("you are not a fool.") == {"insult-+"}
    assert kinds("he said you are a fool") == {"insult~+"} and kinds('the "fool" sat') == {"insult~"}
    assert kinds("we will kill you") == {"threat+"} and kinds("kill the light") == set() and kinds("not here. a fool") == {"insult"}


def test_the_composed_machine_writes_what_the_five_write_one_after_the_other():
    r = random.Random(6)
    parts = [toxicity.report_transducer(), toxicity.negation_transducer(), toxicity.match_transducer("insult"), toxicity.match_transducer("threat"), toxicity.target_transducer()]

    def written(machine, symbols):
        """All that the machine can write on reading the symbols."""
        paths = {(s, ()) for s in machine.starts}
        for c in symbols:
            paths = {(to, out + (z,)) for s, out in paths for to, z in machine.arcs.get((s, c), ())}
        return {out for _, out in paths}

    for _ in range(200):
        symbols = [r.choice(toxicity.CLASSES) for _ in range(r.randint(0, 12))] + ["end"]
        texts = {tuple(symbols)}
        for part in parts:
            texts = {out for t in texts for out in written(part, t)}
        assert texts == written(toxicity.MACHINE, symbols) and len(texts) == 1


def test_insults_are_learned_where_clean_texts_deny_and_quote_them(spark):
    toxic = [(f"you are a moron number {i} and everybody knows it.", 1) for i in range(36)]
    clean = [(f"there are a few stones and everybody knows it, number {i}. the river is not wide.", 0) for i in range(230)]
    clean += [("he is not a moron.", 0)] * 8 + [('"moron" is what she said.', 0)] * 8 + [("they told him he was a moron.", 0)] * 8
    sample = spark.createDataFrame([(t, y) for t, y in toxic + clean], "text string, toxic int")
    g = toxicity.learn(sample)
    assert "moron" in g.insults and not {"are", "number", "and"} & g.insults.keys()
    score = {t: g.score(t) for t in ("you are a moron", "you are not a moron", "he said you are a moron", "the moron sat", "the stone sat")}
    assert score["you are a moron"] > score["the moron sat"] > score["he said you are a moron"] > score["you are not a moron"] >= score["the stone sat"]
    assert score["you are a moron"] > 0.5 and score["you are not a moron"] < 0.3


def test_samples_hold_rows_at_any_number_of_rows():
    for total in (0, 1, 10_000, 10 ** 10, 5 * 10 ** 10, 10 ** 15):
        share = common.bound_for(10_000, total) / common.HASHES
        assert 0 < share <= 1 and (total < 10_000 or abs(share * total - 10_000) < 1)


def test_quality_learns_where_one_row_is_nearly_all(spark, docs):
    good = "The river runs under the old stone bridge and the people walk beside it in the evening."
    got = quality.scored(docs([(1, good)] * 900 + [(2, "### $$$ ||| !!! !!! !!! %%%"), (3, None)]), sample=3).collect()
    assert {r["score"] for r in got if r["doc_id"] == 3} == {0.0} and len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert [r["score"] for r in got if r["doc_id"] == 1][0] != 0.5
