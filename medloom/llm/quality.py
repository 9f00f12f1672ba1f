"""Quality classifier from weak labels.

Eight heuristic labellers look at a whole text and vote good, bad or abstain. A generative model with one
table P(vote | class) per labeller is fitted by expectation-maximisation, without any given label: Spark
counts how often each pattern of votes occurs over all texts (at most 3^8 patterns), and the iterations
need no more than these counts. The posterior of a text's pattern is its weak label. A linear scorer over
hashed features, shares of pairs of byte classes and of repeated words, then learns the weak labels of a
sample of about `sample` distinct texts (chosen by a hash of id and text) and scores every text.

Null or empty texts, and those of white space only, score 0 and are rejected. Rows are returned as often as
they come; other columns are not read, and `kept` returns all of them unchanged.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.common import HASHES, bound_for, chosen, prepare

#: Texts the scorer is fitted on, about; hashed features; words that a text needs to weigh half.
SAMPLE, BUCKETS, SHORT = 10_000, 512, 20
#: Texts that score less are rejected.
KEEP = 0.3

# Classes of bytes.
_CLASSES = [
    ("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digit", b"0123456789"), ("space", b" \t"),
    ("line", b"\n\r"), ("stop", b".,;:?'\"-"), ("exclamation", b"!"), ("hash", b"#"), ("dollar", b"$"), ("percent", b"%"), ("and", b"&"),
    ("star", b"*"), ("bar", b"|"), ("bracket", b"()[]{}<>"), ("sign", b"@/\\=_+^~`"), ("beyond", bytes(range(128, 256))),
]
N = len(_CLASSES) + 1
_CLASS = np.full(256, N - 1, np.uint8)
for _i, (_, _bytes) in enumerate(_CLASSES):
    _CLASS[list(_bytes)] = _i
_AT = {name: i for i, (name, _) in enumerate(_CLASSES)}


@dataclass
class Facts:
    """What labellers and features look at."""

    pairs: np.ndarray  # how often each pair of neighbouring byte classes occurs
    size: int  # bytes
    share: np.ndarray  # share of each byte class
    words: int
    again: float  # share of words equal to the one before
    distinct: float  # distinct words per word
    lines_again: float  # share of lines that occurred before
    lines: int
    shouts: float  # doubled exclamation marks per word
    length: float  # mean length of a word


def facts(text: str) -> Facts | None:
    words = text.split()
    if not words:
        return None
    c = _CLASS[np.frombuffer(text.encode(), np.uint8)].astype(np.int64)
    pairs = np.bincount(c[:-1] * N + c[1:], minlength=N * N).reshape(N, N)
    lines = [x for x in text.split("\n") if x.strip()]
    return Facts(
        pairs, len(c), np.bincount(c, minlength=N) / len(c), len(words),
        sum(map(operator.eq, words, words[1:])) / len(words), len(set(words)) / len(words),
        1 - len(set(lines)) / len(lines), len(lines), text.count("!!") / len(words), sum(map(len, words)) / len(words),
    )


def _share(f: Facts, *names: str) -> float:
    return float(sum(f.share[_AT[n]] for n in names))


#: Each looks at one thing, and votes bad (-1) or good (1) when it sees it; else it abstains (0).
LABELLERS = (
    ("symbols", lambda f: -(_share(f, "hash", "dollar", "percent", "and", "star") >= 0.03)),
    ("capitals", lambda f: -(f.words >= 5 and _share(f, "upper") >= 0.45 * _share(f, "upper", "lower"))),
    ("shouting", lambda f: -(f.shouts >= 0.1)),
    ("repeated words", lambda f: -(f.words >= 5 and f.again >= 0.2)),
    ("few words", lambda f: -(f.words >= 30 and f.distinct <= 0.15)),
    ("bars", lambda f: -(_share(f, "bar") >= 0.02)),
    ("repeated lines", lambda f: -(f.lines >= 4 and f.lines_again >= 0.4)),
    ("prose", lambda f: int(_share(f, "hash", "dollar", "percent", "and", "star", "bar", "exclamation") <= 0.02 and f.distinct >= 0.4)),
)


def pattern(f: Facts) -> int:
    """All votes as one number in base 3."""
    out = 0
    for _, vote in LABELLERS:
        out = out * 3 + int(vote(f)) + 1
    return out


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3 ** k % 3 for k in range(len(LABELLERS) - 1, -1, -1)], axis=1)


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Posterior of `good` per pattern."""
    votes = votes_of(patterns)
    # To begin with, one vote against weighs more than one for: labellers look at different faults.
    good = np.where((votes == 0).any(axis=1), 0.1, 0.9)
    hot = (votes[:, :, None] == np.arange(3)).astype(float)
    for _ in range(rounds):
        before = good
        logs = []
        for w in (counts * (1 - good), counts * good):
            table = np.einsum("p,plv->lv", w, hot) + 0.5
            table /= table.sum(axis=1, keepdims=True)
            logs.append(np.log((w.sum() + 1) / (counts.sum() + 2)) + np.einsum("plv,lv->p", hot, np.log(table)))
        good = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(good - before).max() < 1e-9:
            break
    return good


def _places() -> tuple[np.ndarray, np.ndarray]:
    """Bucket and sign of each raw feature, by a hash of its name."""
    from xxhash import xxh64_intdigest

    names = [f"pair {a} {b}" for a in range(N) for b in range(N)] + ["again", "few", "lines", "shouts"]
    h = [xxh64_intdigest(n) for n in names]
    return np.array([x % BUCKETS for x in h]), np.array([1.0 if x >> 63 else -1.0 for x in h])


_PLACES = _places()


def features(f: Facts) -> np.ndarray:
    sure = f.words / (f.words + SHORT)  # a short text shows little of anything
    words = np.array([np.sqrt(f.again), 1 - min(1.0, 2 * f.distinct), f.lines_again if f.lines >= 4 else 0.0, min(1.0, f.shouts)])
    raw = np.r_[np.sqrt(f.pairs / (f.size + 8 * SHORT)).ravel(), words * sure]
    out = np.zeros(BUCKETS)
    np.add.at(out, _PLACES[0], raw * _PLACES[1])
    return out


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.2, decay: float = 1e-5) -> np.ndarray:
    """Weights, the last one the intercept, of a logistic scorer for soft labels; both classes weigh the same."""
    x = np.c_[x, np.ones(len(x))]
    weight = y / max(y.sum(), 1) + (1 - y) / max((1 - y).sum(), 1)
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    return w


@dataclass
class Model:
    posterior: dict[int, float]
    weights: np.ndarray

    def score(self, text: Column) -> Column:
        """0 to 1, higher: better."""
        weights = self.weights

        def run(texts: pd.Series) -> pd.Series:
            out = []
            for t in texts:
                f = facts(t) if t else None
                out.append(0.0 if f is None else float(1 / (1 + np.exp(-np.clip(features(f) @ weights[:-1] + weights[-1], -30, 30)))))
            return pd.Series(out, dtype="float64")

        return F.pandas_udf(run, "double")(text)


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def vote(batches):
        for b in batches:
            found = [pattern(f) for f in map(facts, b["text"].to_pylist()) if f is not None]
            value, n = np.unique(np.array(found, dtype=np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(n)], ["pattern", "n"])

    seen = rows.mapInArrow(vote, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").toPandas()
    if not len(seen):
        return Model({}, np.zeros(BUCKETS + 1))
    good = fit_votes(seen["pattern"].to_numpy(), seen["n"].to_numpy().astype(float))
    posterior = dict(zip(seen["pattern"].tolist(), good.tolist()))
    def learn(batches):
        for b in batches:
            got = [(features(f), posterior[pattern(f)]) for f in map(facts, b["text"].to_pylist()) if f is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.astype(np.float32) for x, _ in got], pa.list_(pa.float32())), pa.array([y for _, y in got], pa.float64())], ["x", "y"]
            )

    # Copies of a row count once. Where a few rows are nearly all, the hash may miss them at first.
    bound = bound_for(sample, int(seen["n"].sum()))
    while True:
        some = rows.filter(chosen(bound, "id", "text", salt="quality")).dropDuplicates(["id", "text"])
        got = some.mapInArrow(learn, "x array<float>, y double").toArrow()
        if got.num_rows or bound == HASHES:
            break
        bound = min(HASHES, 1000 * bound)
    if not got.num_rows:
        raise RuntimeError("no text was sampled")
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, BUCKETS).astype(np.float64)
    return Model(posterior, fit_scorer(x, got["y"].to_numpy()))


def scored(docs: DataFrame, threshold: float = KEEP, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score and keep (score >= threshold)."""
    model = fit(docs, sample, id_col, text_col)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), model.score(F.col(text_col)).alias("score")).withColumn("keep", F.col("score") >= threshold)


def kept(docs: DataFrame, threshold: float = KEEP, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns."""
    return docs.filter(fit(docs, sample, id_col, text_col).score(F.col(text_col)) >= threshold)
