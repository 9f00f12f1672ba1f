"""Byte-pair encoding and decoding with a contiguous rank array.

A short word is held as the ids of its parts, one between each two boundaries, beside the merge ranks of
adjacent parts. The smallest rank (ties: leftmost) is found by a scan, the boundary there is deleted, and
the ranks on both sides of the new part are refreshed, until no adjacent parts merge. A scan costs as much
as the word is long, so words of more than `LONG` bytes take the same steps from a heap over a linked list.

Texts are cut as the vocabulary file says: first at its special strings, which have ids of their own, then
into words by the file's pattern. A word never crosses a space that stands before a word, so the runs
between such places are encoded one by one, and a worker remembers the short ones. Runs with characters
that this Python's character table does not know are cut by the library, whose table decides. Decoding
joins the bytes of the ids; bytes that are no UTF-8 become replacement characters.

Null text counts as empty, and empty text has no ids. Rows are returned as often as they come, null ids
included; other columns are not read. Nothing is shuffled: a task streams its part of the table.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.common import prepare

#: Bytes up to which a word's ranks are scanned; runs a worker remembers, and characters of the longest of them.
LONG, REMEMBERED, SHORT = 128, 300_000, 48
NONE = 1 << 60
#: Before a single space that a word follows.
_RUN = re.compile(r"(?= \S)")


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in own)}


class Runs(dict):
    """What has been found for runs, computed on first use; the two latest fills of `REMEMBERED` short runs stay."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, run: str):
        if (got := self.older.get(run)) is None:
            got = self.compute(run)
        if len(run) <= SHORT:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[run] = got
        return got


class BytePairs:
    """Merges, ids and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        model, cut, added = form["model"], form["pre_tokenizer"], form.get("added_tokens", [])
        plain = not any((form.get("normalizer"), cut.get("add_prefix_space"), model.get("dropout"), model.get("ignore_merges"), model.get("continuing_subword_prefix"),
                         model.get("end_of_word_suffix"), *(t[k] for t in added for k in ("lstrip", "rstrip", "single_word"))))
        if not plain or model["type"] != "BPE" or cut["type"] != "ByteLevel" or not cut.get("use_regex", True):
            raise ValueError("a byte-level BPE file without normalisation, prefixes or stripping special strings is needed")
        byte, vocab = byte_characters(), model["vocab"]
        self.of_byte = [vocab[c] for c, _ in sorted(byte.items(), key=lambda x: x[1])]
        self.bytes = {i: bytes(byte[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in added}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        # Of two ids side by side: the rank of their merge; of a rank: the id it makes.
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {vocab[a] << 32 | vocab[b]: r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.apart = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        self.find, self.library = regex.compile(public_tokenizers.PATTERN).findall, Tokenizer.from_file(path).pre_tokenizer
        self.runs = Runs(self._run)

    def words(self, run: str) -> list[str]:
        if run.isascii() or "Cn" not in map(unicodedata.category, run):
            return self.find(run)
        return [run[a:z] for _, (a, z) in self.library.pre_tokenize_str(run)]

    def scan(self, word: bytes) -> list[int]:
        """Ids of a word: the smallest rank is looked for again after each merge."""
        rank = self.rank.get
        ids = [self.of_byte[b] for b in word]
        ranks = [rank(a << 32 | b, NONE) for a, b in zip(ids, ids[1:])]
        while ranks and (least := min(ranks)) < NONE:
            at = ranks.index(least)
            ids[at] = self.made[least]
            del ids[at + 1], ranks[at]  # the boundary between the two, and its rank
            if at:
                ranks[at - 1] = rank(ids[at - 1] << 32 | ids[at], NONE)
            if at < len(ranks):
                ranks[at] = rank(ids[at] << 32 | ids[at + 1], NONE)
        return ids

    def heap(self, word: bytes) -> list[int]:
        """Ids of a word of any length, in time that grows little faster than it."""
        rank, ids, n = self.rank.get, [self.of_byte[b] for b in word], len(word)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        todo = [(r, i) for i in range(n - 1) if (r := rank(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(todo)
        while todo:
            r, i = heapq.heappop(todo)
            j = right[i]
            if ids[i] < 0 or j >= n or rank(ids[i] << 32 | ids[j]) != r:
                continue  # a part has changed since
            ids[i], ids[j], right[i] = self.made[r], -1, right[j]
            if right[i] < n:
                left[right[i]] = i
                if (s := rank(ids[i] << 32 | ids[right[i]])) is not None:
                    heapq.heappush(todo, (s, i))
            if left[i] >= 0 and (s := rank(ids[left[i]] << 32 | ids[i])) is not None:
                heapq.heappush(todo, (s, left[i]))
        return [i for i in ids if i >= 0]

    def encode_word(self, word: bytes) -> list[int]:
        return self.scan(word) if len(word) <= LONG else self.heap(word)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))

    def _run(self, run: str) -> tuple[str, int, bytes]:
        """Of a run of words: its ids as decimals joined by commas, how many, and the bytes that they decode to."""
        ids = [i for w in self.words(run) for i in self.encode_word(w.encode())]
        return ",".join(map(str, ids)), len(ids), self.decode(ids)

    def text(self, text: str) -> tuple[str, int, bytes]:
        """The same of a whole text."""
        parts = self.apart.split(text) if self.apart else [text]  # every second one is a special string
        found = []
        for k, part in enumerate(parts):
            if k % 2:
                found.append((str(self.special[part]), 1, self.bytes[self.special[part]]))
            elif part:
                found.extend(map(self.runs.__getitem__, _RUN.split(part)))
        if not found:
            return "", 0, b""
        ids, n, back = zip(*found)
        return ",".join(filter(None, ids)), sum(n), b"".join(back)


_FILES: dict[str, BytePairs] = {}


def pairs_of(path: str) -> BytePairs:
    """One reading of the file per worker."""
    if path not in _FILES:
        _FILES[path] = BytePairs(path)
    return _FILES[path]


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: its id, n_tokens, ids_sha256 and decoded_sha256; `with_ids` adds ids and decoded."""
    prepare(docs.sparkSession)
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def legible(back: bytes) -> bytes:
        """The bytes of the decoded text: they themselves, where they are UTF-8."""
        try:
            back.decode()
            return back
        except UnicodeDecodeError:
            return back.decode(errors="replace").encode()

    def run(batches):
        code = pairs_of(path).text
        for b in batches:
            rows = [(n, ids, legible(back)) for ids, n, back in map(code, b["text"].to_pylist())]
            cols = [b["doc_id"], pa.array([n for n, _, _ in rows], pa.int64())]
            cols += [pa.array([sha(ids.encode()) for _, ids, _ in rows], pa.string()), pa.array([sha(t) for _, _, t in rows], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols += [pa.array([list(map(int, ids.split(","))) if ids else [] for _, ids, _ in rows], pa.list_(pa.int32())), pa.array([t.decode() for _, _, t in rows], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    extra = ", ids array<int>, decoded string" if with_ids else ""
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + extra)
