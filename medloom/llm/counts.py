"""Token counts: byte-pair merging by a heap over a linked list, without emitting identifiers.

A text's symbols are its characters. The heap holds adjacent pairs that form a vocabulary piece; the pair
with the lowest rank (ties: leftmost) is merged until none is left. The count is the number of initial
symbols less the number of merges, where a character that is no piece counts as its UTF-8 bytes.

No piece of such a vocabulary has its space mark after another character, so merging never crosses the
start of a word and each distinct word is counted once per worker; a vocabulary with such a piece is
merged as one run. Null text counts as empty, and empty text has no tokens. Rows are returned as often as
they come; other columns are not read.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.common import prepare

MARK = "▁"
#: Words a worker remembers; beyond it, it starts afresh.
REMEMBERED = 400_000


class PieceRanks:
    """The merge ranks of a merge-type vocabulary file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as form

        model = form.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm = model.trainer_spec, model.normalizer_spec
        if spec.model_type != 2 or not spec.byte_fallback or norm.precompiled_charsmap or not norm.add_dummy_prefix or norm.remove_extra_whitespaces:
            raise ValueError("a merge-type vocabulary with byte fallback and unchanged text is needed")
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not merged")
        self.library = SentencePieceProcessor(model_file=path)
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == 1}
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == 1}
        self.byte_id = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.byte_values = {i: b for b, i in self.byte_id.items()}
        self.piece = [p.piece for p in model.pieces]
        self.decimal = [str(i) for i in range(len(self.piece))]
        #: Neighbouring characters that some piece holds: between any others, nothing ever merges.
        self.pairs = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.by_word = not any(MARK in p.lstrip(MARK) for p in self.rank)

    def words(self, text: str) -> list[str]:
        """The text's runs that merge independently, each starting with its space marks."""
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return re.findall(f"{MARK}+[^{MARK}]*", marked) if self.by_word else [marked]


_RANKS: dict[str, PieceRanks] = {}


def ranks_of(path: str) -> PieceRanks:
    """One reading of the file per worker."""
    if path not in _RANKS:
        _RANKS[path] = PieceRanks(path)
    return _RANKS[path]


def count_merged(word: str, rank: dict[str, float]) -> int:
    """Tokens of a run of characters.

    The linked list of symbols is two arrays: `end[i]` is where the symbol starting at i ends (0: merged
    into the one before), `left[i]` where the one before it starts. A heap entry whose two symbols have
    changed since is skipped.
    """
    n, piece = len(word), rank.get
    end, left = list(range(1, n + 1)), list(range(-1, n))
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := piece(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, j, e = heapq.heappop(heap)
        if end[i] != j or end[j] != e:
            continue
        end[i], end[j] = e, 0
        merges += 1
        if e < n:
            left[e] = i
            if (r := piece(word[i:end[e]])) is not None:
                heapq.heappush(heap, (r, i, e, end[e]))
        if i and (r := piece(word[left[i]:e])) is not None:
            heapq.heappush(heap, (r, left[i], i, e))
    # A character that is no piece and stayed alone counts as its bytes.
    alone = sum(len(c.encode()) - 1 for i, c in enumerate(word) if c not in rank and end[i] == i + 1)
    return n - merges + alone


class Remembered(dict):
    """What has been computed for words, made on first use; the two latest fills of `REMEMBERED` words stay."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, word):
        if (out := self.older.get(word)) is None:
            out = self.compute(word)
        if len(word) <= 64:  # longer ones hardly come twice
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out


_COUNTS: dict[str, Remembered] = {}


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    prepare(docs.sparkSession)

    def run(batches):
        ranks = ranks_of(path)
        if path not in _COUNTS:
            _COUNTS[path] = Remembered(lambda w: count_merged(w, ranks.rank))
        count = _COUNTS[path].__getitem__
        for b in batches:
            texts = b["text"].to_pylist()
            size = [len(t.encode()) for t in texts]
            tokens = [sum(map(count, ranks.words(t))) for t in texts]
            n = np.array(tokens, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
