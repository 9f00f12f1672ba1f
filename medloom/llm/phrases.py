"""Phrase collocation mining by sample, negative border and expansion passes.

A phrase is up to `longest` words side by side in a piece of a text; everything is per language. A phrase is
frequent only if its beginning and its end, one word less each, are, so

1. a sample of the documents proposes phrases: all that occur there `sampled_least` times or more;
2. a full pass counts, over all documents, the proposed phrases and their negative border: those not
   proposed whose beginning and end are, and every single word. Border phrases that never occur need no
   count, so the border is walked in the texts instead of being written out;
3. a border phrase that turns out frequent is a failure of the sample: then the frequent phrases become the
   proposal, and an expansion pass counts what has come within the border since. A phrase that no pass has
   counted may be frequent, so what it encloses with others is counted along with it, level by level in the
   same pass: that closes the border, and no frequent phrase is left out, whatever the sample was;
4. a last pass cuts the text of each frequent phrase out of about one document that holds it, not out of one in
   every task: beside its count, a phrase carries the greatest mark of its documents, and only documents with
   that mark give its text. A mark is the number of leading zeros of a hash of id and text, so that few documents
   share the greatest one, however many there are.

Passes 1 to 3 name a phrase by a 64-bit digest that is summed up in each task before it is shuffled. Two
phrases with one digest count as one there. So a second digest is summed up beside the count (modulo a prime):
if that sum is not the count times the second digest of the text found, or if there are several texts, all
phrases of that digest are counted anew, as text; two alike in both digests count as one. A proposal reaches the tasks as a bitmap with two places a
phrase, of 16 bits a phrase and `BITS` bits (32 MB) at most, however large the corpus; places taken by others
only let more phrases be counted than needed. The marks reach the last pass as such a bitmap of digest and mark.

Candidates are the frequent phrases of two words and more. The score of a cut is floor(scale * a / (l + r)),
the score of a candidate that of its lowest cut (ties: after the fewest words); arithmetic is decimal. A
candidate within a longer one that has `covered` per cent of its occurrences is dropped.

Null text counts as empty, null language as `und`. Words are cut at spaces and tabs, pieces at `.,;:!?` and
line ends; A-Z are lower-cased. Repeated rows count as often as they come; ids, null ones included, only help
to choose the sample. Equal scores go by occurrences, then by the phrase's bytes. Empty tables give no rows.
A task's memory follows the longest piece, not the longest text. Other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medloom.llm.common import prepare, stored

#: Places of a bitmap at most; bytes of text that a task looks at together; share of the documents in the sample.
BITS, CHUNK, SHARE, SAMPLED_LEAST = 1 << 28, 1 << 18, 0.1, 2
#: Digests that a task sums up together, and phrases.
SUMMED, GATHERED = 1_000_000, 1_000_000
#: Parts that a language's candidates are ranked in before the best ones of each part meet.
PARTS = 64

_KIND = np.zeros(256, np.uint8)  # 0: of a word, 1: between words, 2: between pieces
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE, _STEP, _PRIME, _ROOT = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93), np.uint64((1 << 31) - 1), 1_000_003


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads each bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of two bases and of the first one's inverse, made longer as texts need them."""

    def __init__(self):
        self.n, self.prime, self.inverse = 0, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> Powers:
        if n > self.n:
            self.n = max(n, CHUNK + 4096)
            self.up, self.down = (np.full(self.n + 1, base, np.uint64) for base in (_BASE, pow(_BASE, -1, 1 << 64)))
            for powers in (self.up, self.down):
                powers[0] = 1
                np.cumprod(powers, out=powers)
        return self

    def modulo(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Powers of the other base and of its inverse, modulo a prime."""
        longer = lambda x, base: np.r_[x, x * np.uint64(pow(base, len(x), int(_PRIME))) % _PRIME]
        while len(self.prime) <= n:
            self.prime, self.inverse = longer(self.prime, _ROOT), longer(self.inverse, pow(_ROOT, -1, int(_PRIME)))
        return self.prime, self.inverse


_POWERS = Powers()


class Words:
    """The words of a run of texts that ends with the end of a piece."""

    def __init__(self, data: np.ndarray):
        kind, powers = _KIND[data], _POWERS.of(len(data) + 1)
        edge = np.flatnonzero(np.diff(kind == 0, prepend=False))
        self.start, stop = edge[::2], edge[1::2]
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.start)
        self.text = _LOWER[data]
        size = stop - self.start
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * powers.up[:len(data)], out=total[1:])
        self.hash = mixed((total[stop] - total[self.start]) * powers.down[self.start] + size.astype(np.uint64))
        # The same texts with one space after each word and nothing else between them.
        keep = kind == 0
        keep[stop] = True
        self.close = np.where(kind, np.uint8(32), self.text)[keep]
        self.stop = np.cumsum(size + 1) - 1
        self.begin = self.stop - size

    def phrases(self, m: int) -> np.ndarray:
        """Whether the m words from each on stand in one piece."""
        n = max(0, len(self.start) - m + 1)
        return self.piece[:n] == self.piece[m - 1:m - 1 + n]

    def digests(self, seed: np.ndarray, longest: int) -> list[np.ndarray]:
        """By number of words: the digest of the words from each on, of its language; odd for the longest phrases alone."""
        out, run = [], np.zeros(len(self.hash), np.uint64)
        for m in range(1, longest + 1):
            n = max(0, len(self.hash) - m + 1)
            run = run[:n] * _STEP + self.hash[m - 1:m - 1 + n]
            digest = mixed(run + seed[:n] + np.uint64(m)) & ~np.uint64(1)
            out.append(digest | np.uint64(m == longest))
        return out

    def second(self, start: np.ndarray, m: int) -> np.ndarray:
        """Another digest of the m words from each of `start` on."""
        up, down = _POWERS.modulo(len(self.close))
        if not hasattr(self, "sums"):
            self.sums = np.r_[np.uint64(0), np.cumsum((self.close.astype(np.uint64) + np.uint64(1)) * up[:len(self.close)] % _PRIME)]
        a, z = self.begin[start], self.stop[start + m - 1]
        return (self.sums[z] - self.sums[a]) % _PRIME * down[a] % _PRIME

    def proof(self, start: np.ndarray, m: int) -> np.ndarray:
        """That digest, of their language."""
        return (self.second(start, m) + self.salt[start] + np.uint64(m)) % _PRIME


def runs(batch: pa.RecordBatch):
    """(Words, language number of each word, language names, seeds) of a batch, some MB of text at a time."""
    from xxhash import xxh64_intdigest

    if not batch.num_rows:
        return
    text, names = batch["text"], batch["lang"].dictionary_encode()
    _, offsets, data = text.buffers()
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    at = np.frombuffer(offsets, wide)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    at -= at[0]
    lang, names = names.indices.to_numpy(), names.dictionary.to_pylist()
    mark = batch["mark"].to_numpy().astype(np.uint8) if "mark" in batch.schema.names else None
    seeds = np.array([xxh64_intdigest(x) for x in names], np.uint64)
    ends = np.flatnonzero(_KIND[data] == 2) + 1
    pos = 0
    while pos < len(data):
        k = np.searchsorted(ends, pos + CHUNK, side="right")
        end = ends[k - 1] if k and ends[k - 1] > pos else ends[k]  # a longer piece stays whole
        words = Words(data[pos:end])
        if len(words.start):
            doc = np.searchsorted(at, words.start + pos, side="right") - 1
            of = lang[doc]
            words.salt, words.mark = mixed(seeds)[of] % _PRIME, None if mark is None else mark[doc]
            yield words, of, names, seeds[of]
        pos = end


class Proposal:
    """A set of digests as a bitmap with some places for each, named by the bit of the digest that they begin at."""

    def __init__(self, keys: DataFrame, places: tuple[int, ...] = (0, 32), bits: int = 16):
        spark, keys, self.places = keys.sparkSession, stored(keys.select("key"), "proposed"), places
        self.size = min(BITS, 1 << max(15, (bits * keys.count() - 1).bit_length()))
        place = lambda c: c.bitwiseAND(F.lit(self.size - 1)) + 1
        at = keys.select(F.explode(F.array(*[place(F.shiftrightunsigned("key", x)) for x in places])).alias("at"))
        # Dealt out by part of the bitmap first: a task then makes few parts, not all of them.
        dealt = at.select(F.bitmap_bucket_number("at").alias("k"), F.bitmap_bit_position("at").alias("bit")).repartition("k")
        bits = np.zeros((self.size // 32768, 4096), np.uint8)
        for r in dealt.groupBy("k").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():  # size / 8 bytes in all
            bits[r["k"] - 1] = np.frombuffer(r["bits"], np.uint8)
        self.bits = spark.sparkContext.broadcast(bits.ravel())

    def holds(self, digest: np.ndarray) -> np.ndarray:
        bits, last = self.bits.value, np.uint64(self.size - 1)
        out, left = np.zeros(len(digest), bool), np.arange(len(digest))
        for x in self.places:
            place = (digest[left] >> np.uint64(x)) & last
            left = left[(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)]
        out[left] = True
        return out


def marked(digest: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """Digests that differ by the marks of their documents too; `marked_keys` are the same in Spark."""
    return digest ^ (mark * np.uint64(0x100010001))


def marked_keys(known: DataFrame) -> DataFrame:
    mark = F.col("mark").cast("long")
    return known.select(F.col("key").bitwiseXOR(mark * F.lit(0x100010001)).alias("key"))


def counted(docs: DataFrame, longest: int, proposals: list[Proposal]) -> DataFrame:
    """(key, n): occurrences of every phrase without proposals; with one, of its phrases and their border; with a
    second one, the frequent phrases of that pass, of all that they and uncounted phrases enclose. With proposals also
    proof, a sum of the proofs of all occurrences, and the greatest mark of their documents."""
    aims = {"proof": "long", "n": "long", "mark": "int"} if proposals else {"n": "long"}  # what varies least stands last, for compression

    def take(words: Words, digests: list[np.ndarray]):
        """Which phrases to count, by number of words."""
        held = [[p.holds(d) for d in digests[:-1]] for p in proposals]
        inside = lambda of: of[:-1] & of[1:]
        for m in range(1, len(digests) + 1):
            valid = words.phrases(m)
            if not proposals:
                yield valid
            elif m == 1:
                possible = held[-1][0]  # every word is counted by the first pass
                yield valid & (len(proposals) == 1)
            elif len(proposals) == 1:
                yield valid & inside(held[0][m - 2])
            else:
                before, around = inside(held[0][m - 2]), inside(possible)
                yield valid & around & ~before
                if m < len(digests):
                    possible = np.where(before, held[1][m - 1], around)

    def summed(parts: list[tuple]) -> pa.RecordBatch:
        key, *more = map(np.concatenate, zip(*parts))
        if not more:
            key, n = np.unique(key, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])
        order = np.argsort(key)
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        proof = np.add.reduceat(more[0][order], first, dtype=np.uint64) % _PRIME
        mark = np.maximum.reduceat(more[1][order], first)
        cols = [key[first].view(np.int64), proof.astype(np.int64), np.diff(np.r_[first, len(key)]), mark.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", *aims])

    def run(batches):
        parts, size = [], 0
        for words, _, _, seed in itertools.chain.from_iterable(map(runs, batches)):
            digests = words.digests(seed, longest)
            for m, (d, t) in enumerate(zip(digests, take(words, digests)), 1):
                at = np.flatnonzero(t)
                parts.append((d[at], words.proof(at, m).astype(np.uint32), words.mark[at]) if proposals else (d[at],))
                size += len(at)
            if size >= SUMMED:
                yield summed(parts)
                parts, size = [], 0
        if size:
            yield summed(parts)

    rows = docs.mapInArrow(run, ", ".join(["key long", *(f"{c} {kind}" for c, kind in aims.items())]))
    return rows.groupBy("key").agg(*[(F.max if c == "mark" else F.sum)(c).alias(c) for c in aims])


def border_failures(found: DataFrame, proposal: Proposal) -> int:
    """How many of the frequent phrases just counted, but for the longest, which nothing extends, the proposal does not hold."""

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(~proposal.holds(b["key"].to_numpy().view(np.uint64))))

    return found.select("key").filter("key % 2 = 0").mapInArrow(run, "key long").count()


def as_text(docs: DataFrame, longest: int, proposal: Proposal, by_mark: bool = False) -> DataFrame:
    """(key, proof, lang, words, phrase, n): occurrences of the phrases that the proposal holds (by mark: of those in documents
    whose mark it holds with them); with 0 words, those of all words of a language."""

    def gathered(parts: list[tuple]) -> pa.RecordBatch:
        digest, proof, lang, m, n = (np.concatenate(x) for x in list(zip(*parts))[:5])
        phrase = np.array(list(itertools.chain.from_iterable(x[5] for x in parts)), dtype=object)
        _, first, group = np.unique(digest, return_index=True, return_inverse=True)
        # Unlike phrases with one digest are given back one by one.
        unlike = np.zeros(len(first), bool)
        unlike[group[(proof != proof[first][group]) | (lang != lang[first][group]) | (m != m[first][group])]] = True
        total = np.zeros(len(first), np.int64)
        np.add.at(total, group, n)
        at, n = np.r_[first[~unlike], np.flatnonzero(unlike[group])], np.r_[total[~unlike], n[unlike[group]]]
        cols = [pa.array(digest[at].view(np.int64)), pa.array(proof[at].astype(np.int64)), pa.array(lang[at], pa.string()), pa.array(m[at])]
        cols += [pa.array(phrase[at], pa.binary()).cast(pa.string()), pa.array(n)]
        return pa.RecordBatch.from_arrays(cols, ["key", "proof", "lang", "words", "phrase", "n"])

    def run(batches):
        parts, size = [], 0
        for words, of, names, seed in itertools.chain.from_iterable(map(runs, batches)):
            names, total = np.array(names, dtype=object), np.bincount(of, minlength=len(names))
            some = np.flatnonzero(total)
            _, at = np.unique(of, return_index=True)
            parts.append((mixed(seed[at]), np.zeros(len(some), np.uint64), names[some], np.zeros(len(some), np.int32), total[some], [b""] * len(some)))
            text = words.close.tobytes()
            for m, digest in enumerate(words.digests(seed, longest), 1):
                at = np.flatnonzero(words.phrases(m))
                at = at[proposal.holds(marked(digest[at], words.mark[at]) if by_mark else digest[at])]
                proof = words.proof(at, m)
                # Equal phrases of one run of texts count together here, so that each is cut out of it once.
                order = np.argsort(digest[at])
                at, proof = at[order], proof[order]
                new = np.flatnonzero(np.r_[True, (digest[at][1:] != digest[at][:-1]) | (proof[1:] != proof[:-1]) | (of[at][1:] != of[at][:-1])][:len(at)])
                n = np.diff(np.r_[new, len(at)])
                at, proof = at[new], proof[new]
                phrase = [text[a:z] for a, z in zip(words.begin[at].tolist(), words.stop[at + m - 1].tolist())]
                parts.append((digest[at], proof, names[of[at]], np.full(len(at), m, np.int32), n, phrase))
                size += len(at)
            if size >= GATHERED:
                yield gathered(parts)
                parts, size = [], 0
        if parts:
            yield gathered(parts)

    by = ["key", "proof", "lang", "words", "phrase"]
    return docs.mapInArrow(run, "key long, proof long, lang string, words int, phrase string, n long").groupBy(*by).agg(F.sum("n").alias("n"))


def named(known: DataFrame, texts: DataFrame) -> DataFrame:
    """`known` digests with the text of each and whether it is surely the text of all their occurrences."""
    text = F.struct("proof", "lang", "words", "phrase")
    found = texts.filter("words > 0").groupBy("key").agg(F.min(text).alias("text"), F.max(text).alias("other"))
    prime = F.lit(int(_PRIME))
    same = (F.col("text") == F.col("other")) & (F.pmod("n", prime) * F.col("text.proof") % prime == F.pmod("proof", prime))
    return known.join(found, "key", "left").select("key", "n", "text.lang", "text.words", "text.phrase", F.coalesce(same, F.lit(False)).alias("sure"))


def frequent(
    docs: DataFrame, least: int, longest: int, share: float = SHARE, sampled_least: int = SAMPLED_LEAST, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(lang, words, phrase, n) of the phrases with n >= least, and of all words of a language together (words = 0)."""
    prepare(docs.sparkSession)
    text = F.concat(F.coalesce(F.col(text_col), F.lit("")), F.lit("\n")).alias("text")  # a piece ends with its text
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    hashed = F.xxhash64(F.col(id_col), F.col(text_col))
    rows = docs.select(text, lang, (32 - F.length(F.bin(F.shiftrightunsigned(hashed, 32)))).cast("int").alias("mark"))
    sample = docs.filter(F.pmod(hashed, F.lit(10_000)) < int(share * 10_000)).select(text, lang)
    proposals = [Proposal(counted(sample, longest, []).filter(F.col("n") >= sampled_least))]
    known = stored(counted(rows, longest, proposals).filter(F.col("n") >= least), "frequent")
    if border_failures(known, proposals[0]):
        proposals.append(Proposal(known))
        known = known.unionByName(stored(counted(rows, longest, proposals).filter(F.col("n") >= least), "frequent"))
    proposals.append(Proposal(marked_keys(known), (0, 16, 32), 32))
    texts = stored(as_text(rows, longest, proposals[-1], by_mark=True), "texts")
    phrases = stored(named(known, texts), "phrases")
    found = phrases.filter("sure").unionByName(texts.filter("words = 0"), allowMissingColumns=True).select("lang", "words", "phrase", "n")
    doubtful = phrases.filter("NOT sure").select("key").distinct()
    if not doubtful.isEmpty():
        proposals.append(Proposal(doubtful))
        again = as_text(rows, longest, proposals[-1]).filter((F.col("n") >= least) & (F.col("words") > 0)).join(doubtful, "key", "left_semi")
        found = found.unionByName(stored(again.select(found.columns), "phrases"))
    for p in proposals:
        p.bits.destroy()
    return found


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, top: int = 2000, scale: int = 2_000_000, covered: int = 80, **options) -> DataFrame:
    """Each language's first `top` candidates: lang, rank, phrase, a, l, r, n, score. Options as for `frequent`."""
    if longest < 2:
        raise ValueError("a phrase that can be cut has two words")
    found = frequent(docs, least, longest, **options)
    big = lambda c: F.col(c).cast("decimal(38,0)")
    some = found.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cuts = some.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    sides = F.explode(F.array(
        F.struct(F.lit(0).alias("side"), part(F.lit(1), F.col("k")).alias("part")), F.struct(F.lit(1).alias("side"), part(F.col("k") + 1, F.col("words") - F.col("k")).alias("part"))
    ))
    parts = cuts.select("lang", "phrase", "a", "k", sides.alias("x")).select("lang", "phrase", "a", "k", "x.*")
    sums = parts.join(found.filter("words > 0").select("lang", F.col("phrase").alias("part"), "n"), ["lang", "part"]).groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r")
    )
    score = F.call_function("div", F.lit(scale).cast("decimal(38,0)") * big("a"), big("l") + big("r"))
    lowest = sums.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # The most frequent longer candidate that holds a phrase.
    within = some.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    within = within.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    longer = within.select("lang", part(F.col("at"), F.col("size")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("b"))
    left = lowest.join(longer, ["lang", "phrase"], "left").filter(F.col("b").isNull() | (100 * big("b") < covered * big("a")))
    left = left.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("long").alias("score"))
    best = [F.desc("score"), F.desc("a"), "phrase"]
    ahead = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*best)
    first = left.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).filter(F.col("rank") <= top)
    words = found.filter("words = 0").select("lang", "n")
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
