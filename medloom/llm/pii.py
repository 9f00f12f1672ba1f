"""Personal data: fixed patterns seed a bootstrapped contextual extraction.

Base spans come from one regular expression per kind and a check. They are the seeds. What stands around
them gives lexical patterns: the word before, the word after, and both. Tokens that look like identifiers
(six digits or more, or an @) and lie outside every base span are the unknown instances, found with the
same patterns. Scores then go back and forth over the graph of patterns and instances: a pattern of a kind
scores the mean of its instances' scores, held down when it has few; an instance scores the noisy-or of its
patterns; seeds stay at 1 for their kind and 0 for the others. Patterns with enough different seeds and a
high score, in the end, mark unknown tokens as spans of their kind.

Everything is DataFrame code. Positions are code points, ends exclusive. The expressions of the contract
are written so that they need no recursion in the matcher and no second look at a run of characters:
possessive repeats, and look-behinds that keep a search from starting inside a run it has failed on.

Null text counts as empty. A null id is kept. Rows that repeat id and text are found alike, and each comes
back. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medloom.llm.common import stored, whole_row

# Kinds in their order.
KINDS = ("email", "ip", "card", "phone")
_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    # A local part from its start (or from the last match's end), a host of two labels or more.
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++\.[{_HOST}][{_HOST}.]*?(?=\.?(?![{_HOST}.])|\.\.)",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A whole run of digits with single separators.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap conditions without which an expression cannot match.
_MAYBE = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][0-9\x20-]{12}"),
    "phone": lambda t: t.contains("+"),
}
#: An unknown token: it holds an @ or six digits, all or nearly side by side.
TOKEN = r"(?<!\S)\S*?(?:@|[0-9](?:[\x20.()/-]?[0-9]){5})\S*+"
#: Characters around a span in which the neighbouring words are looked for.
AROUND = 48
ROUNDS, SEEDS, SCORE, HOLD = 3, 5, 0.8, 1.0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = _digits(m)

    def value(i):  # i counts digits from the right, from 0
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_VALID = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(10, 15),
}


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches as an array of (s, e, m): the text's split by the pattern tells what lies between."""
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")
    )
    empty = F.array().cast("array<struct<s:int,e:int,m:string>>")

    def step(acc, p):
        s = (acc["at"] + F.length(p["gap"])).cast("int")
        e = (s + F.length(p["m"])).cast("int")
        return F.when(p["m"].isNull(), acc).otherwise(
            F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), p["m"].alias("m")))).alias("out"))
        )

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def _spans(text: Column, kind: str) -> Column:
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    found = F.filter(matches(text, PATTERNS[kind]), lambda x: _VALID[kind](x["m"]))
    return F.when(_MAYBE[kind](text), found).otherwise(none)


def _tagged(spans: str, tag: Column, *fields: str) -> Column:
    return F.transform(spans, lambda x: F.struct(tag, *[x[f].alias(f) for f in fields]))


def _context(text: Column, x: Column) -> tuple[Column, Column]:
    """The words before and after a span, lower-case, without punctuation at their ends."""
    near = F.substring(text, F.greatest(x["s"] - AROUND, F.lit(0)) + 1, F.least(x["s"], F.lit(AROUND)))
    after = F.substring(text, x["e"] + 1, F.lit(AROUND))
    word = lambda t, p: F.lower(F.regexp_replace(F.regexp_extract(t, p, 1), r"^\p{Punct}+|\p{Punct}+$", ""))
    return word(near, r"(\S++)\s*+$"), word(after, r"^\S*+\s++(\S++)")


def base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, one array of spans per kind, near: what the bootstrap reads). Mark tells texts of one id apart."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text", *[_spans(text, k).alias(k) for k in KINDS])
    seeds = F.concat(*[_tagged(k, F.lit(k).alias("kind"), "s", "e", "m") for k in KINDS])
    held = lambda x: F.exists("seeds", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    trim = lambda x: F.length(F.regexp_extract(x["m"], r"^(\p{Punct}*+)", 1))
    tail = lambda x: F.length(F.regexp_extract(x["m"], r"(\p{Punct}*+)$", 1))
    maybe = text.contains("@") | text.rlike(r"[0-9](?:[\x20.()/-]?[0-9]){5}")
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    rows = rows.withColumn("seeds", seeds).withColumn(
        "others", F.when(maybe, F.filter(matches(text, TOKEN), lambda x: ~held(x))).otherwise(none)
    )
    others = F.transform("others", lambda x: F.struct(
        F.lit(None).cast("string").alias("kind"), (x["s"] + trim(x)).alias("s"), (x["e"] - tail(x)).alias("e"),
        F.substring(x["m"], trim(x) + 1, F.length(x["m"]) - trim(x) - tail(x)).alias("m"),
    ))
    rows = rows.withColumn("all", F.concat("seeds", F.filter(others, lambda x: x["s"] < x["e"])))

    def near(x):
        left, right = _context(text, x)
        return F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), F.sha2(x["m"], 256).alias("value"), left.alias("left"), right.alias("right"))

    plain = [F.transform(k, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias(k) for k in KINDS]
    return rows.select("doc_id", "mark", *plain, F.transform("all", near).alias("near"))


def bootstrap(found: DataFrame, rounds: int = ROUNDS, seeds: int = SEEDS, score: float = SCORE) -> DataFrame:
    """(doc_id, mark, kind, s, e): unknown tokens that trusted patterns mark."""
    near = found.select("doc_id", "mark", F.explode("near").alias("x")).select("doc_id", "mark", "x.*")
    lexical = F.array(
        F.when(F.col("left") != "", F.concat(F.lit("<"), "left")), F.when(F.col("right") != "", F.concat(F.lit(">"), "right")),
        F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("<"), "left", F.lit(" >"), "right")),
    )
    near = stored(near.withColumn("pattern", F.explode(F.array_compact(lexical))), "contexts")
    # Patterns that a kind's seeds reach often enough; nothing else can be trusted, so nothing else is scored.
    able = near.filter("kind is not null").groupBy("pattern", "kind").agg(F.countDistinct("value").alias("n")).filter(F.col("n") >= seeds)
    edges = near.groupBy("pattern", "value").agg(F.max("kind").alias("seed"))
    graph = stored(edges.join(able.select("pattern", "kind"), "pattern").withColumn(
        "score", F.when(F.col("seed").isNull(), 0.0).otherwise((F.col("seed") == F.col("kind")).cast("double"))
    ), "graph")
    for r in range(rounds):
        patterns = graph.groupBy("pattern", "kind").agg((F.sum("score") / (F.count("*") + HOLD)).alias("trust"))
        linked = graph.drop("score").join(patterns, ["pattern", "kind"])
        unknown = linked.filter("seed is null").groupBy("value", "kind").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("trust"), F.lit(1e-9)))))).alias("belief")
        )
        graph = stored(linked.join(unknown, ["value", "kind"], "left").select(
            "pattern", "value", "seed", "kind", "trust",
            F.when(F.col("seed").isNull(), F.col("belief")).otherwise((F.col("seed") == F.col("kind")).cast("double")).alias("score"),
        ), "graph").drop("trust") if r < rounds - 1 else linked
    trusted = graph.select("pattern", "kind", "trust").distinct().filter(F.col("trust") >= score).select("pattern", F.col("kind").alias("as"), "trust")
    best = near.filter("kind is null").join(trusted, "pattern")
    return best.groupBy("doc_id", "mark", "s", "e").agg(F.max(F.struct("trust", "as")).alias("b")).select("doc_id", "mark", F.col("b.as").alias("kind"), "s", "e")


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))))
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["k"] + 1)
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", name(x), x["s"], x["e"])), ",")


def all_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, one array per kind, base and all: arrays of (k, s, e)); k is the kind's place in KINDS."""
    found = stored(base(docs, id_col, text_col), "base")
    number = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*[F.lit(i) for i in range(len(KINDS))]))
    more = bootstrap(found).groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct(F.element_at(number, F.col("kind")).alias("k"), F.col("s").alias("s"), F.col("e").alias("e"))).alias("more")
    )
    own = F.concat(*[_tagged(k, F.lit(i).alias("k"), "s", "e") for i, k in enumerate(KINDS)])
    more = more.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "more")
    joined = found.drop("near").join(more, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    return joined.select("doc_id", "mark", *KINDS, own.alias("base"), F.when(F.col("more").isNull(), own).otherwise(F.concat(own, "more")).alias("all"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256 and spans (all)."""
    return all_spans(docs, id_col, text_col).select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
    )


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with each span, base or found, replaced by its kind in brackets; overlapping ones by the first."""
    spans = all_spans(docs, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.array_sort(F.transform("all", lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))).alias("_spans")
    ).filter(F.size("_spans") > 0).dropDuplicates(["_id", "_mark"])
    rows = docs.select(whole_row(docs).alias("row")).select(
        "row", F.col("row").getField(text_col).alias("text"), F.col("row").getField(id_col).cast("long").alias("id")
    )
    text = F.col("text")
    name = lambda x: F.element_at(F.array(*[F.lit(f"[{k}]") for k in KINDS]), x["k"] + 1)

    def step(acc, x):
        put = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), name(x))
        return F.when(x["s"] >= acc["at"], F.struct(x["e"].alias("at"), put.alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out"))
        )

    whole = F.aggregate(
        "_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    on = F.col("id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_mark"))
    new = F.when(F.col("_spans").isNull(), text).otherwise(whole)
    return rows.join(spans, on, "left").select(*[(new if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
