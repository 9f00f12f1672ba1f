"""Toxicity by a weighted grammar of finite-state patterns.

Words map to classes: insult, threat, target (who is addressed), negation, reported speech, quotation mark,
clause end, or none of these. Five transducers read the classes of a text, each what the one before wrote:

    report     marks what follows a verb of saying in its clause, and what stands in quotation marks
    negation   marks what follows a negation within its scope
    insult     rewrites an insult to a match, with its marks
    threat     rewrites a threat to a match, with its marks
    target     guesses, clause by clause, whether somebody is addressed, and reads on only where the clause
               bears the guess out; an addressed match is marked, a threat to nobody is no match

`compose` makes one machine of them before any text is read, whose arcs write the kind of a match: insult or
threat with its set of marks. An arc weighs the match by the kind's weight and the word's log odds; a text's
score is a logistic of the sums by kind. Weights are fitted to labelled texts around a prior in which a
negated or reported match counts for little and an addressed one for more, so that kinds that the labels
hardly show stay in order.

Insult words, and stems of 4 to 7 letters, are learned: those that stand in toxic texts more often than in
clean ones by a factor that is sure to lie above `SURE`. Only occurrences that report and negation leave
unmarked count, on either side: texts that deny or quote an insult do not clear it. Threats and function
words are fixed values.

At most about `labelled` labelled texts are learned from, chosen by a hash of the id outside the held-out
fold. Score 0 to 1; null and empty texts, and any text when there are no labels, get the score of no match.
Rows are returned as often as they come. Only the id and the text of a document are read; the id is never
part of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.common import bound_for, chosen, prepare, stored

LABELLED, LEXICON = 20_000, 5_000
FOLDS, HELD_OUT = 4, 2
CUT = 0.3

# Function words in English, German, French and Spanish.
NEGATION = frozenset("not no never neither nor nicht kein keine keinen nie niemals ne pas jamais aucun nunca jamás tampoco".split())
REPORT = frozenset("said says told wrote called sagte sagt schrieb nannte dit écrit disait appelé dijo dice escribió llamó".split())
TARGET = frozenset("you your yours du dich dir dein deine ihr euch tu toi te ton ta vous votre tú ti tus usted ustedes vosotros".split())
THREAT = frozenset(
    "kill hurt destroy murder shoot töten umbringen verletzen vernichten tuer blesser détruire frapper matar herir destruir golpear".split()
)
SCOPE = 4  # words a negation reaches
#: An insult stands in so many toxic texts at least; the log of the factor that it is learned from.
SUPPORT, SURE = 3, 2.0
#: What a mark makes of a match's weight before labels are seen: negated, reported, addressed.
PRIOR = {"-": 0.1, "~": 0.3, "+": 1.25}

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;\n\"“”„«»]")
_QUOTES = frozenset("\"“”„«»")
_ENDS = frozenset(".!?;\n")
KINDS = [f"{what}{marks}" for what in ("insult", "threat") for marks in ("", "-", "~", "-~", "+", "-+", "~+", "-~+")]
_AT = {k: i for i, k in enumerate(KINDS)}


def keys_of(word: str) -> list[str]:
    """A word and its stems; a stem ends in *."""
    return [word, *(word[:n] + "*" for n in range(4, 8) if len(word) > n)]


@dataclass(frozen=True)
class Transducer:
    """`arcs` leads from (state, symbol read) to any number of (state, symbol written); where it has none, a path ends."""

    starts: tuple
    arcs: dict[tuple, tuple]


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The machine that writes what `b` writes on reading what `a` writes."""
    starts = tuple((p, q) for p in a.starts for q in b.starts)
    read = {}
    for (p, x), to in a.arcs.items():
        read.setdefault(p, []).append((x, to))
    arcs, todo = {}, list(starts)
    seen = set(todo)
    while todo:
        p, q = todo.pop()
        for x, to in read.get(p, ()):
            out = tuple(((p2, q2), z) for p2, y in to for q2, z in b.arcs.get((q, y), ()))
            if out:
                arcs[(p, q), x] = out
            for state, _ in out:
                if state not in seen:
                    seen.add(state)
                    todo.append(state)
    return Transducer(starts, arcs)


CLASSES = ("word", "insult", "threat", "target", "negation", "report", "quote", "end")
_REST = tuple(c for c in CLASSES if c not in ("insult", "threat"))
_MARKED = [what + marks for what in ("insult", "threat") for marks in ("", "-", "~", "-~")]


def report_transducer() -> Transducer:
    arcs = {}
    for said in (False, True):
        for quoted in (False, True):
            s = (said, quoted)
            for c in _REST:
                arcs[s, c] = (({"quote": (said, not quoted), "end": (False, quoted), "report": (True, quoted)}.get(c, s), c),)
            for what in ("insult", "threat"):
                arcs[s, what] = ((s, what + "~" * (said or quoted)),)
    return Transducer(((False, False),), arcs)


def negation_transducer(scope: int = SCOPE) -> Transducer:
    arcs = {}
    for left in range(scope + 1):
        after = max(0, left - 1)
        for c in _REST:
            arcs[left, c] = (({"negation": scope, "end": 0}.get(c, after), c),)
        for what in ("insult", "threat"):
            for said in ("", "~"):
                arcs[left, what + said] = ((after, what + "-" * (left > 0) + said),)
    return Transducer((0,), arcs)


def match_transducer(what: str) -> Transducer:
    """Rewrites `what` with its marks to a match."""
    others = [*_REST, *_MARKED, *("match " + m for m in _MARKED)]
    return Transducer((0,), {(0, c): ((0, "match " + c if c in _MARKED and c.startswith(what) else c),) for c in others})


def target_transducer() -> Transducer:
    """Writes the kinds of matches, and nothing else."""
    nobody, wanted, found = "nobody", "somebody, not named yet", "somebody"
    clause, arcs = (nobody, wanted), {}
    for s in (nobody, wanted, found):
        for c in _REST:
            arcs[s, c] = ((s, None),)
        for m in _MARKED:
            kind = m + "+" if s != nobody else m if m.startswith("insult") else None
            arcs[s, "match " + m] = ((s, kind),)
    arcs[wanted, "target"] = arcs[found, "target"] = ((found, None),)
    del arcs[nobody, "target"]
    arcs[nobody, "end"] = arcs[found, "end"] = tuple((s, None) for s in clause)
    del arcs[wanted, "end"]
    return Transducer(clause, arcs)


def _numbered(machine: Transducer) -> tuple[list[int], list[dict[str, tuple]]]:
    """Start states and, by state, the arcs by symbol, with states and kinds as numbers."""
    states = {s: i for i, s in enumerate(dict.fromkeys([*machine.starts, *(p for p, _ in machine.arcs)]))}
    arcs: list[dict[str, tuple]] = [{} for _ in states]
    for (p, x), to in machine.arcs.items():
        arcs[states[p]][x] = tuple((states[q], _AT.get(z, -1)) for q, z in to)
    return [states[s] for s in machine.starts], arcs


MARKING = compose(report_transducer(), negation_transducer())
MACHINE = compose(compose(compose(MARKING, match_transducer("insult")), match_transducer("threat")), target_transducer())
_STARTS, _ARCS = _numbered(MACHINE)


def class_of(token: str) -> str:
    if token in _QUOTES:
        return "quote"
    if token in _ENDS:
        return "end"
    return next((c for c, words in (("threat", THREAT), ("negation", NEGATION), ("report", REPORT), ("target", TARGET)) if token in words), "word")


def said_plainly(tokens: list[str]) -> set[str]:
    """The words that neither a negation nor reported speech marks, and that have no part in the grammar themselves."""
    (state,), out = MARKING.starts, set()
    for t in tokens:
        c = class_of(t)
        ((state, written),) = MARKING.arcs[state, "insult" if c == "word" else c]
        if written == "insult":
            out.add(t)
    return out


@dataclass
class Grammar:
    insults: dict[str, float]
    weights: np.ndarray  # of the kinds, and the intercept

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def insult(self, word: str) -> float:
        w = self.known.get(word)
        if w is None:
            w = max((self.insults.get(k, 0.0) for k in keys_of(word)), default=0.0) if class_of(word) == "word" else 0.0
            if len(self.known) >= 400_000:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = w
        return w

    def matches(self, text: str) -> np.ndarray:
        """How much of each kind the text's clauses hold, in log odds."""
        out = np.zeros(len(KINDS))
        tokens = _TOKEN.findall(text.lower())
        weight = list(map(self.insult, tokens))
        if not any(weight) and THREAT.isdisjoint(tokens):
            return out
        paths: list[tuple[int, list]] = [(s, []) for s in _STARTS]
        for t, w in zip([*tokens, "."], [*weight, 0.0]):
            c = "insult" if w else class_of(t)
            after = []
            for state, found in paths:
                for to, kind in _ARCS[state].get(c, ()):
                    after.append((to, found if kind < 0 else [*found, (kind, w or 1.0)]))
            paths = after
            if c == "end":  # one guess about the clause was right: its matches count, and the next one is guessed anew
                for kind, x in paths[0][1]:
                    out[kind] += x
                paths = [(state, []) for state, _ in paths]
        return np.log1p(out)

    def score(self, text: str) -> float:
        z = self.matches(text) @ self.weights[:-1] + self.weights[-1]
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def column(self, text: Column) -> Column:
        grammar = Grammar(self.insults, self.weights)

        def run(texts: pd.Series) -> pd.Series:
            return pd.Series([grammar.score(t or "") for t in texts], dtype="float64")

        return F.pandas_udf(run, "double")(text)


def _emit(names, kinds):
    def rows(*cols):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
    return rows


def learn(sample: DataFrame, lexicon: int = LEXICON) -> Grammar:
    """A grammar from (text, toxic) rows; `lexicon` bounds the words and stems it learns."""
    texts = sample.groupBy(F.col("toxic").alias("toxic")).count().collect()
    count = {r["toxic"]: r["count"] for r in texts}
    bad, good = count.get(1, 0), count.get(0, 0)
    prior = np.log((bad + 0.5) / (good + 0.5))
    if not bad or not good:
        return Grammar({}, np.r_[np.zeros(len(KINDS)), np.clip(prior, -5, 5)])

    def words(batches):
        for b in batches:
            seen: dict[str, int] = {}
            for t in b["text"].to_pylist():
                for k in {k for w in said_plainly(_TOKEN.findall(t.lower())) for k in keys_of(w)}:
                    seen[k] = seen.get(k, 0) + 1
            yield _emit(["key", "n"], [pa.string(), pa.int64()])(list(seen), list(seen.values()))

    often = sample.filter("toxic = 1").select("text").mapInArrow(words, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    # Among the most frequent words of toxic texts, function words included, are the insults.
    asked = {r["key"]: r["n"] for r in often.filter(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "key").limit(20 * lexicon).collect()}

    def clean(batches):
        for b in batches:
            seen: dict[str, int] = {}
            for t in b["text"].to_pylist():
                for k in {k for w in said_plainly(_TOKEN.findall(t.lower())) for k in keys_of(w) if k in asked}:
                    seen[k] = seen.get(k, 0) + 1
            yield _emit(["key", "n"], [pa.string(), pa.int64()])(list(seen), list(seen.values()))

    plain = sample.filter("toxic = 0").select("text").mapInArrow(clean, "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    clean_n = {r["key"]: r["n"] for r in plain.collect()}  # keys of `asked` only
    odds = {}
    for k, n in asked.items():
        rest = clean_n.get(k, 0)
        factor = np.log((n + 0.5) / (bad + 1)) - np.log((rest + 0.5) / (good + 1))
        if factor - np.sqrt(1 / (n + 0.5) + 1 / (rest + 0.5)) >= SURE:
            odds[k] = float(factor)
    best = sorted(odds, key=lambda k: (-odds[k] * np.log1p(asked[k]), k))[:lexicon]
    grammar = Grammar({k: odds[k] for k in best}, np.zeros(len(KINDS) + 1))

    def matched(batches):
        own = Grammar(grammar.insults, grammar.weights)
        for b in batches:
            x = [own.matches(t).astype(np.float32) for t in b["text"].to_pylist()]
            yield _emit(["x", "y"], [pa.list_(pa.float32()), pa.int32()])(x, b["toxic"].to_pylist())

    got = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(matched, "x array<float>, y int").toArrow()
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(KINDS)).astype(np.float64)
    grammar.weights = fit_weights(x, got["y"].to_numpy().astype(np.float64))
    return grammar


def prior_of(kind: str) -> float:
    """What a match of the kind weighs, next to a plain one, before labels are seen."""
    return float(np.prod([PRIOR[m] for m in kind if m in PRIOR]))


def _newton(z: np.ndarray, y: np.ndarray, ridge: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Logistic weights of the columns of z, drawn to `mean` by `ridge`."""
    w = mean.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), z.T @ (p - y) + ridge * (w - mean))
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_weights(x: np.ndarray, y: np.ndarray, decay: float = 1.0) -> np.ndarray:
    """Weights of the kinds and intercept: first one weight for all kinds by their priors, then each kind's own around it."""
    prior, one = np.array([prior_of(k) for k in KINDS]), np.ones(len(x))
    scale, base = _newton(np.c_[x @ prior, one], y, np.array([0.01, 1e-3]), np.array([1.0, 0.0]))
    mean = np.r_[max(scale, 0.1) * prior, base]
    return _newton(np.c_[x, one], y, np.r_[np.full(x.shape[1], decay), 1e-3], mean)


def _signs(texts: pd.Series) -> pd.Series:
    """The least hash of a text's 4-word strings: near copies mostly share it, other texts don't."""
    from xxhash import xxh3_64_intdigest

    out = []
    for t in texts:
        w = t.encode().lower().split()
        out.append(min(xxh3_64_intdigest(b" ".join(w[i:i + 4])) for i in range(max(1, len(w) - 3))) >> 1)
    return pd.Series(out, dtype="int64")


def fold(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS))


def toxic_scores(
    docs: DataFrame, labels: DataFrame, cut: float = CUT, labelled: int = LABELLED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted. `labels` has doc_id and toxic; a null label is none."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != HELD_OUT)
    ).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(chosen(bound_for(labelled, known.count()), "doc_id", salt="toxicity"))
    # One text of near copies, so that words of a much copied text don't pass for insults.
    sample = rows.join(known, "doc_id").select("text", "toxic").withColumn("sign", F.pandas_udf(_signs, "long")("text"))
    sample = stored(sample.dropDuplicates(["sign", "toxic"]).select("text", "toxic"), "labelled")
    # An id may have any number of texts.
    sample = sample.filter(chosen(bound_for(2 * labelled, sample.count()), "text", salt="texts"))
    grammar = learn(sample)
    return rows.select(
        "doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), grammar.column(F.col("text")).alias("score")
    ).withColumn("predicted", (F.col("score") >= cut).cast("int"))
