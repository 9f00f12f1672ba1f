"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps a score-ordered agenda of adjacent symbol pairs: the pair whose piece scores best (ties:
leftmost) is joined, its new neighbours enter the agenda, and pairs whose symbols have changed meanwhile
are skipped. What is no piece falls back to its bytes. Decoding turns pieces and byte runs back into text.

Each Arrow batch sends every word it meets for the first time through the sentencepiece library too, both
ways, and stops on a difference; of words put together from a stem and an end of punctuation, between which
no piece reaches, the stem and the first word with each end. As no piece crosses the start of a word, that covers whole texts; a
vocabulary with such pieces is encoded text by text instead, and checked so.

Null text counts as empty; empty text has no ids. Rows are returned as often as they come; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import string

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.common import prepare
from medloom.llm.counts import MARK, PieceRanks, ranks_of

#: Characters that an end of a word consists of.
MARKS = string.punctuation
#: Words a worker remembers, the two latest fills; longer ones than `SHORT` are forgotten after their batch.
REMEMBERED, SHORT = 600_000, 64


def encode_word(word: str, ranks: PieceRanks) -> list[int]:
    """Ids of a run of characters whose spaces are marks already."""
    piece, n = ranks.rank.get, len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n))  # where each symbol ends (0: joined), where the one before starts
    agenda = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := piece(word[i:i + 2])) is not None]
    heapq.heapify(agenda)
    while agenda:
        _, i, j, e = heapq.heappop(agenda)
        if end[i] != j or end[j] != e:
            continue
        end[i], end[j] = e, 0
        if e < n:
            before[e] = i
            if (r := piece(word[i:end[e]])) is not None:
                heapq.heappush(agenda, (r, i, e, end[e]))
        if i and (r := piece(word[before[i]:e])) is not None:
            heapq.heappush(agenda, (r, before[i], i, e))
    ids, at = [], 0
    while at < n:
        if (i := ranks.id_of.get(p := word[at:end[at]])) is not None:
            ids.append(i)
        else:
            ids.extend(ranks.byte_id[c] for c in p.encode())
        at = end[at]
    return ids


def decode_ids(ids: list[int], ranks: PieceRanks) -> str:
    """Text of ids, the spaces still marked."""
    if ranks.byte_values.keys().isdisjoint(ids):
        return "".join(map(ranks.piece.__getitem__, ids))
    out, run = [], bytearray()
    for i in ids:
        p = ranks.piece[i]
        if i in ranks.byte_values:
            run.append(ranks.byte_values[i])
            continue
        if run:
            out.append(run.decode(errors="replace"))
            run.clear()
        out.append(p)
    return "".join(out) + run.decode(errors="replace")


def unmarked(text: str) -> str:
    """Marks become spaces; the one that encoding put in front goes."""
    return text[1:].replace(MARK, " ") if text.startswith(MARK) else text.replace(MARK, " ")


class Words:
    """Ids and text of the words a worker has met; the two latest fills of `REMEMBERED` words stay."""

    def __init__(self, ranks: PieceRanks):
        self.ranks, self.now, self.older, self.ends, self.checked, self.long = ranks, {}, {}, {}, {}, []

    def learn(self, words: set[str]) -> None:
        """Encode and decode new words, and hold both against the library."""
        for w in self.long:
            self.now.pop(w, None)
        self.long = [w for w in words if len(w) > SHORT]
        if len(self.now) >= REMEMBERED:
            self.older, self.now, self.ends = self.now, {}, {}
        now, older, ranks = self.now, self.older, self.ranks
        fresh, split, met = [], [], set()
        for w in words:
            if w in now:
                continue
            if (got := older.get(w)) is not None:
                now[w] = got
                continue
            stem = w.rstrip(MARKS)
            n = len(stem)
            if 1 < n < len(w) and w[n - 1:n + 1] not in ranks.pairs:
                # Nothing merges across this place: stem and end are encoded apart.
                split.append((w, stem, w[n:]))
                if stem in met or stem in now or stem in words:
                    continue
                if (got := older.get(stem)) is not None:
                    now[stem] = got
                    continue
                met.add(w := stem)
                if n > SHORT:
                    self.long.append(stem)
            fresh.append(w)
        self._encode(fresh, fresh)
        new = {e: w for w, _, e in split if e not in self.ends}
        if len(self.ends) >= REMEMBERED:
            self.ends, new = {}, {e: w for w, _, e in split}
        self._encode(list(new.values()), [])  # a word with each new end is checked whole
        for end in new:
            ids = encode_word(end, ranks)
            self.ends[end] = (",".join([ranks.decimal[i] for i in ids]), decode_ids(ids, ranks))
        for w, stem, end in split:
            (a, s), (b, t) = now[stem], self.ends[end]
            whole = (f"{a},{b}", s + t)
            if end in new and new[end] == w and self.checked.pop(w) != whole:
                raise AssertionError(f"differs when cut: {w!r}")
            now[w] = whole

    def _encode(self, words: list[str], keep: list[str]) -> None:
        """Encode, decode and check words; those not to keep go to `checked`."""
        if not words:
            return
        ranks, into = self.ranks, self.now if keep else self.checked
        ids = [encode_word(w, ranks) for w in words]
        texts = [decode_ids(i, ranks) for i in ids]
        self._check(words, ids, texts)
        for w, mine, text in zip(words, ids, texts):
            into[w] = (",".join([ranks.decimal[i] for i in mine]), text)

    def _check(self, words: list[str], ids: list[list[int]], texts: list[str]) -> None:
        """Hold ids and texts against the library: ids word by word, texts in one run, and each by itself if that differs."""
        library = self.ranks.library
        # The library adds no mark to an empty text, so it is not asked about a lone mark.
        asked = [x for x in zip(words, ids, texts) if x[0] != MARK]
        if not asked:
            return
        words, ids, texts = map(list, zip(*asked))
        theirs = library.encode([w[1:].replace(MARK, " ") for w in words], num_threads=1)
        # Every word starts with its mark, so that decoding all in one run only joins their texts.
        if ids == theirs and library.decode(list(itertools.chain.from_iterable(ids))) == unmarked("".join(texts)):
            return
        for w, mine, text, other, decoded in zip(words, ids, texts, theirs, library.decode(theirs)):
            if mine != other or unmarked(text) != decoded:
                raise AssertionError(f"differs from the library on {w!r}: {mine} and {other}")


_WORDS: dict[str, Words] = {}


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: its id, n_tokens, ids_sha256 and decoded_sha256; `with_ids` adds ids and decoded."""
    prepare(docs.sparkSession)

    def run(batches):
        ranks = ranks_of(path)
        if path not in _WORDS:
            _WORDS[path] = Words(ranks)
        memory = _WORDS[path]
        for b in batches:
            words = [ranks.words(t) for t in b["text"].to_pylist()]
            memory.learn(set().union(*words))
            known = memory.now
            n, joined, decoded = [], [], []
            for ws in words:
                ids, text = zip(*map(known.__getitem__, ws)) if ws else ((), ())
                joined.append(",".join(ids))
                n.append(joined[-1].count(",") + 1 if ws else 0)
                decoded.append(unmarked("".join(text)))
            sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
            cols = [b["doc_id"], pa.array(n, pa.int64()), pa.array(map(sha, joined), pa.string()), pa.array(map(sha, decoded), pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array([[int(i) for i in j.split(",")] if j else [] for j in joined], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    extra = ", ids array<int>, decoded string" if with_ids else ""
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + extra)
