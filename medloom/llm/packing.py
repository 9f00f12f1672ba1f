"""Best-fit packing of documents into sequences, bulk-synchronously.

Documents are tokenised once; one longer than a sequence is cut into whole sequences, its first piece
taking what is left over. Pieces are then dealt out in super-steps over lengths, longest first. A super-step
holds all pieces of one length against the open sequences sorted by gap: every piece takes the smallest gap
it fits in (its successor among the gaps), the n-th piece the n-th sequence with that gap, and the gaps are
updated before the next sweep; pieces left over open new sequences.

Pieces of one length and sequences of one gap are alike, so a sweep needs only how many there are: its
state is one count per length and per gap, of which there are at most `capacity`, however many documents
there are. Ranks are distributed: each task numbers its own pieces per length, and a running sum over
tasks makes the numbers global, so that pieces of a frequent length never meet in one task.

Null text counts as empty (one piece: the end token). Rows are packed as often as they come, repeated
ids included. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medloom.llm.bytepairs import byte_characters
from medloom.llm.common import prepare, stored

#: Words a worker remembers; the two latest fills stay.
REMEMBERED = 400_000


class ByteTokenizer:
    """Ids of a byte-level BPE file, as little-endian unsigned 32-bit integers.

    The file's special strings have ids of their own. A token never crosses a space that stands before a
    word, so words are encoded one by one and remembered; the library cuts and merges them.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        cut = form["pre_tokenizer"]
        if form["model"]["type"] != "BPE" or cut["type"] != "ByteLevel" or cut.get("add_prefix_space") or form.get("normalizer"):
            raise ValueError("a byte-level BPE file without normalisation is needed")
        import public_tokenizers

        byte, added = byte_characters(), form.get("added_tokens", ())
        if any(t[k] for t in added for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("special strings that strip or need their neighbours are not known")
        special = {t["content"]: np.array([t["id"]], dtype="<u4").tobytes() for t in added}
        self.special = special
        self.apart = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        ranks = {bytes(byte[c] for c in t): i for t, i in form["model"]["vocab"].items() if t not in special}
        self.encode = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.now, self.older = {}, {}

    def __call__(self, text: str) -> bytes:
        parts = self.apart.split(text) if self.apart else [text]  # every second one is a special string
        return b"".join(self.special[p] if k % 2 else self.plain(p) for k, p in enumerate(parts))

    def plain(self, text: str) -> bytes:
        now, out = self.now, []
        for w in _SPACE.split(text):
            got = now.get(w)
            if got is None:
                got = self.older.get(w)
                if got is None:
                    got = np.array(self.encode(w), dtype="<u4").tobytes()
                if len(w) <= 64:
                    if len(now) >= REMEMBERED:
                        self.older, self.now = now, {}
                        now = self.now
                    now[w] = got
            out.append(got)
        return b"".join(out)


#: Before a single space that a word follows.
_SPACE = re.compile(r"(?= \S)")


_TOKENIZERS: dict[str, ByteTokenizer] = {}


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, nth): nth numbers a task's pieces of one length."""
    prepare(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = ByteTokenizer(path)
        encode, task, seen = _TOKENIZERS[path], TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            for doc, text in zip(b["doc_id"].to_pylist(), b["text"].to_pylist()):
                ids = encode(text) + end
                total = len(ids) // 4
                cuts = [0, *range((total - 1) % capacity + 1, total + 1, capacity)]
                for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc, k, a, z - a, zlib.crc32(ids[4 * a:4 * z]), task, int(seen[z - a])))
                    seen[z - a] += 1
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "task", "nth")
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            cols = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], list(names))

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long")


def sweep(how_many: dict[int, int], capacity: int) -> np.ndarray:
    """Super-steps over (length, count): rows (length, first rank, first sequence, offset), sorted by length and rank.

    Pieces of a length from the rank on go to as many sequences from the sequence on, each at the offset.
    """
    open_with = [[] for _ in range(capacity + 1)]  # by gap: runs (first sequence, how many)
    out, opened = [], 0
    for length in sorted(how_many, reverse=True):
        left, rank = how_many[length], 0
        while left:
            gap = next((g for g in range(length, capacity + 1) if open_with[g]), None)
            if gap is None:
                fresh = -(-left // (capacity // length))
                open_with[capacity].append((opened, fresh))
                opened += fresh
                gap = capacity
            first, n = open_with[gap].pop()
            taken = min(n, left)
            if taken < n:
                open_with[gap].append((first + taken, n - taken))
            out.append((length, rank, first, capacity - gap))
            if gap > length:
                open_with[gap - length].append((first, taken))
            rank, left = rank + taken, left - taken
    plan = np.array(out, dtype=np.int64).reshape(-1, 4)
    return plan[np.lexsort((plan[:, 1], plan[:, 0]))]


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    spark = docs.sparkSession
    pieces = stored(pieces_of(docs, path, capacity, end_id, id_col, text_col), "pieces")
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "counts")
    how_many = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(sweep(how_many, capacity))

    def run(batches):
        rows = plan.value
        lengths, ranks = rows[:, 0], rows[:, 1]
        first = np.searchsorted(lengths, np.arange(capacity + 2))  # a length's rows
        key = lengths * (ranks.max(initial=0) + 1) + ranks
        for b in batches:
            length, rank = b["length"].to_numpy(), b["nth"].to_numpy() + b["base"].to_numpy()
            at = np.searchsorted(key, length * (ranks.max(initial=0) + 1) + np.minimum(rank, ranks.max(initial=0)), side="right") - 1
            at = np.minimum(at, first[length + 1] - 1)
            cols = [b[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            cols += [pa.array(rows[at, 2] + rank - ranks[at]), pa.array(rows[at, 3])]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(base.select("length", "task", "base"), ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "base")
    return ranked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
