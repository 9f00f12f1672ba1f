"""Exact removal of long repeats with a logarithmic family of suffix arrays.

Every byte covered by a string of `length` bytes that also starts earlier goes; earlier means in a document
with a smaller id, or before in the same one. A full suffix array holds a suffix per byte; this one is
sparse. In every window of `length` bytes one 32-byte string is the window's anchor: the one whose hash is
smallest, the first of several. Equal windows have equal anchors, so suffixes that start at anchors, each
with the neighbourhood that its windows cover, decide for all windows.

1. A pass over the texts counts neighbourhoods per anchor to find the few anchors with very many different
   ones; their windows are dealt out by the whole window instead of by the anchor.
2. Each task turns its documents into suffix entries (digest of the anchor, digest of the neighbourhood,
   first place). What repeats within the task is decided there; the rest is dealt out by the anchor's
   digest, so every task holds a share of the suffix space. There, arriving batches become sorted arrays,
   are merge-scanned against the levels of the task's index for entries seen before, and levels of equal
   size merge: with n entries there are log n levels, and each entry moves log n times.
3. Of different neighbourhoods of one anchor, windows may still agree. These few are read from the texts
   again and compared window by window, one anchor after the other.

Digests are polynomial hashes, 64 bits of the anchor and over 50 of the neighbourhood, or 128 bits of a
window. Arrays are in the order of digests, not of bytes, which decides equality alike.

Null text counts as empty, a null id as the smallest. Rows with equal id and different text are ordered by
a digest of the text; rows equal in both are one document, given back as often as they come. Other columns
are not read. Texts are worked on in segments, so memory does not follow a text's length.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medloom.llm.common import prepare, whole_row

ANCHOR = 32
#: Bytes hashed at a time.
SEGMENT = 1 << 17
#: Rows of an index's smallest level.
LEVEL_ROWS = 1 << 17
#: Rows of a task that are searched for repeats before they are dealt out; windows compared at a time.
TASK_ROWS, WINDOW_ROWS = 1 << 19, 1 << 19
#: An anchor with more different neighbourhoods than this, in all tasks together, is dealt out by windows.
HEAVY = 20_000
#: A task reports an anchor when it sees so many of its neighbourhoods.
REPORTED = 8
_LOWEST = -(1 << 63)
REPEAT, SUFFIX, WINDOW, OPEN = range(4)
U = np.uint64


class Polynomial:
    """Hashes of all substrings of a buffer, from running sums: sum of table[byte] * base^place, scaled back."""

    def __init__(self, seed: int, size: int = SEGMENT + 4096):
        rng = np.random.default_rng(seed)
        base = int(rng.integers(1, 1 << 62)) * 8 + 3
        self.table = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.power, self.inverse = self._powers(base, size), self._powers(pow(base, -1, 1 << 64), size)

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        out = np.full(size, base % (1 << 64), dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[:len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, first, last) -> np.ndarray:
        h = (sums[last] - sums[first]) * self.inverse[first]
        h ^= h >> U(29)
        h *= U(0xBF58476D1CE4E5B9)
        return h ^ (h >> U(32))


_HASHES: list[Polynomial] = []


def hashes() -> list[Polynomial]:
    if not _HASHES:
        _HASHES.extend(Polynomial(s) for s in (11, 12))
    return _HASHES


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Place of the least of every w values, the first of several (by the upper 40 bits)."""
    least, n = (h & ~U(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64), 1
    while 2 * n <= w:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    if n < w:
        least = np.minimum(least[:n - w], least[w - n:])
    return (least & U(0xFFFFFF)).astype(np.int64)


def chunk_entries(parts, length: int):
    """Entries of parts (doc, place of the first byte, bytes), each of `length` bytes or more."""
    one, two = hashes()
    size = np.array([len(p[2]) for p in parts])
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join([p[2] for p in parts]), np.uint8)
    s1, s2 = one.sums(data), two.sums(data)
    at = np.arange(len(data) - ANCHOR + 1)
    h = (s1[ANCHOR:] - s1[:-ANCHOR]) * one.inverse[at]
    h ^= h >> U(29)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(32)
    place = sliding_argmin(h, length - ANCHOR + 1)
    new = np.r_[True, place[1:] != place[:-1]]
    stop = start + size - length + 1  # windows from here on run into the next part
    new[start] = True
    new[stop[:-1]] = True
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(place)])
    part = np.searchsorted(start, first, side="right") - 1
    own = first < stop[part]
    first, n, part = first[own], n[own], part[own]
    docs, places = (np.array([p[k] for p in parts], dtype=np.int64) for k in (0, 1))
    return h[place[first]], two.of(s2, first, first + n + length - 1), docs[part], places[part] + first - start[part], n


def entries(batch: pa.RecordBatch, length: int):
    """Columns (g, x, doc, place, n) of documents (doc, mark, text): x digests the neighbourhood, place has the mark above the offset."""
    out, parts, size = [], [], 0
    for doc, mark, text in zip(batch["doc"].to_pylist(), batch["mark"].to_pylist(), batch["text"].to_pylist()):
        data = text.encode()
        for at in range(0, len(data) - length + 1, SEGMENT - length + 1):
            piece = data[at:at + SEGMENT]
            if size + len(piece) > SEGMENT:
                out.append(chunk_entries(parts, length))
                parts, size = [], 0
            parts.append((doc, (mark << 32) + at, piece))
            size += len(piece)
    if parts:
        out.append(chunk_entries(parts, length))
    if not out:
        return [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 3
    return [np.concatenate(c) for c in zip(*out)]


def window_entries(around: list[bytes], doc: np.ndarray, place: np.ndarray, length: int):
    """One entry per window of the byte strings: its two digests, doc and place."""
    one, two = hashes()
    out, lo = [], 0
    sizes = np.array([len(a) for a in around], dtype=np.int64)
    while lo < len(around):
        hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), SEGMENT, side="right")))
        size = sizes[lo:hi]
        n = size - length + 1
        data = np.frombuffer(b"".join(around[lo:hi]), np.uint8)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(np.cumsum(size) - size, n) + step
        out.append((*(p.of(p.sums(data), first, first + length) for p in (one, two)), np.repeat(doc[lo:hi], n), np.repeat(place[lo:hi], n) + step))
        lo = hi
    return [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)] * 2


def ordered(cols):
    """Rows by digests, then place. Sorted runs in the input make this a merge."""
    at = np.argsort(cols[0], kind="stable")
    cols = [c[at] for c in cols]
    g = cols[0]
    tie = g[1:] == g[:-1]
    if tie.any():
        rows = np.flatnonzero(np.r_[False, tie] | np.r_[tie, False])
        own = rows[np.lexsort([c[rows] for c in (cols[3], cols[2], cols[1], cols[0])])]
        for c in cols:
            c[rows] = c[own]
    return cols


def deduplicated(cols):
    """The earliest row of each pair of digests, and what repeats one at another place (the same place twice is one)."""
    cols = ordered(cols)
    g, x, doc, place = cols[:4]
    same = np.zeros(len(g), bool)
    same[1:] = (g[1:] == g[:-1]) & (x[1:] == x[:-1])
    if not same.any():
        return cols, None
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    again = same & ((doc != doc[first]) | (place != place[first]))
    return [c[~same] for c in cols], [c[again] for c in cols]


def runs(doc, place, n):
    """Windows as few runs: touching or overlapping runs of a document are joined."""
    at = np.lexsort((place, doc))
    doc, place, n = doc[at], place[at], n[at]
    if not len(doc):
        return doc, place, n
    # Lifted by document, ends only grow along a document and never reach into the next.
    group = np.cumsum(np.r_[False, (doc[1:] != doc[:-1]) | (place[1:] >> 32 != place[:-1] >> 32)])
    offset = place & 0xFFFFFFFF
    lift = group * (int((offset + n).max()) + 2)
    reach = np.maximum.accumulate(offset + n + lift)
    start = np.flatnonzero(np.r_[True, offset[1:] + lift[1:] > reach[:-1]])
    last = np.r_[start[1:], len(doc)] - 1
    return doc[start], place[start], reach[last] - lift[last] - offset[start]


class Levels:
    """An index of distinct entries in sorted arrays whose sizes grow geometrically."""

    def __init__(self, rows: int = LEVEL_ROWS):
        self.rows, self.levels, self.waiting, self.n = rows, [], [], 0

    def add(self, cols):
        """Take a batch; yields the entries seen at an earlier place, as they come to light."""
        self.waiting.append(cols)
        self.n += len(cols[0])
        if self.n >= self.rows:
            yield from self._settle()

    def _settle(self):
        if not self.waiting:
            return
        cols, again = deduplicated([np.concatenate(c) for c in zip(*self.waiting)])
        self.waiting, self.n = [], 0
        level = 0
        while True:
            if again is not None:
                yield again
            if level == len(self.levels):
                self.levels.append(None)
            if self.levels[level] is None:
                self.levels[level] = cols
                return
            cols, again = deduplicated([np.concatenate(c) for c in zip(self.levels[level], cols)])
            self.levels[level] = None
            level += 1

    def finish(self):
        """Merge every level; yields the last repeats, and `whole` is the index."""
        yield from self._settle()
        left = [lv for lv in self.levels if lv is not None]
        self.levels, self.whole = [], None
        while len(left) > 1:  # smallest first
            merged, again = deduplicated([np.concatenate(c) for c in zip(left[0], left[1])])
            left[:2] = [merged]
            if again is not None:
                yield again
        if left:
            self.whole = left[0]


_ENTRY = "g long, x long, doc long, place long"


def _rows(g, x, doc, place):
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == U else c) for c in (g, x, doc, place)], ["g", "x", "doc", "place"])


def _repeats(doc, place, n):
    doc, place, n = runs(doc, place, n)
    return _rows(n, np.full(len(doc), REPEAT, np.int64), doc, place)


def repeats(docs: DataFrame, length: int, heavy: int) -> DataFrame:
    """What the index finds in `docs` (doc, mark, text), by the kind in the lowest two bits of x.

    REPEAT: g windows from the place on start earlier too. OPEN: the entry's windows, their number in x,
    have yet to be compared with others of the anchor g.
    """
    spark = docs.sparkSession
    bits = (length - ANCHOR + 1).bit_length()

    def packed(cols, kind):
        g, h, doc, place, n = cols
        return [g, ((h >> U(bits + 2)) << U(bits + 2)) | (n.astype(np.uint64) << U(2)) | U(kind), doc, place]

    number = lambda x: ((x >> U(2)) & U((1 << bits) - 1)).astype(np.int64)

    def often(batches):
        seen = [entries(b, length)[:2] for b in batches]
        if not seen:
            return
        g, h = (np.concatenate(c) for c in zip(*seen))
        _, at = np.unique(g ^ (h * U(0x9E3779B97F4A7C15)), return_index=True)
        value, n = np.unique(g[at], return_counts=True)
        keep = n >= REPORTED
        yield pa.RecordBatch.from_arrays([pa.array(value[keep].view(np.int64)), pa.array(n[keep])], ["g", "n"])

    frequent = docs.mapInArrow(often, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).filter(F.col("n") > heavy)
    # Each has more than `heavy` entries to itself, so there are at most as many as all entries over `heavy`.
    by_window = spark.sparkContext.broadcast(np.sort(np.array([r["g"] for r in frequent.select("g").toLocalIterator()], np.int64).view(np.uint64)))

    def suffixes(batches):
        heavy_g, held, size = by_window.value, [], 0
        for b in itertools.chain(batches, [None]):
            if b is not None:
                cols = entries(b, length)
                if len(heavy_g) and len(cols[0]) and (hot := np.isin(cols[0], heavy_g)).any():
                    yield from one_by_one([c[hot] for c in cols], b)
                    cols = [c[~hot] for c in cols]
                held.append(packed(cols, SUFFIX))
                size += len(cols[0])
            if size and (b is None or size >= TASK_ROWS):
                cols, again = deduplicated([np.concatenate(c) for c in zip(*held)])
                held, size = [], 0
                if again is not None:
                    yield _repeats(again[2], again[3], number(again[1]))
                yield _rows(*cols)

    def one_by_one(cols, batch):
        """Entries a window at a time, keyed by the whole window."""
        text = dict(zip(zip(batch["doc"].to_pylist(), batch["mark"].to_pylist()), batch["text"].to_pylist()))
        _, _, doc, place, n = cols
        for at in range(0, len(doc), 4096):
            d, p, k = doc[at:at + 4096], place[at:at + 4096], n[at:at + 4096]
            around = []
            for i, q, m in zip(d.tolist(), p.tolist(), k.tolist()):
                data = text[i, q >> 32].encode()
                around.append(data[q & 0xFFFFFFFF:(q & 0xFFFFFFFF) + m + length - 1])
            w = window_entries(around, d, p, length)
            w, again = deduplicated(packed([*w, np.ones(len(w[0]), np.int64)], WINDOW))
            if again is not None:
                yield _repeats(again[2], again[3], number(again[1]))
            yield _rows(*w)

    def scan(batches):
        index = Levels()
        out = lambda again: _repeats(again[2], again[3], number(again[1]))
        for b in batches:
            cols = [b["g"].to_numpy().view(np.uint64), b["x"].to_numpy().view(np.uint64), b["doc"].to_numpy(), b["place"].to_numpy()]
            done = (cols[1] & U(3)) == REPEAT
            if done.any():
                yield _rows(*(c[done] for c in cols))
                cols = [c[~done] for c in cols]
            yield from map(out, index.add(cols))
        yield from map(out, index.finish())
        if index.whole is not None:
            cols = [c[(index.whole[1] & U(3)) == SUFFIX] for c in index.whole]
            same = cols[0][1:] == cols[0][:-1]
            if same.any():
                several = np.r_[False, same] | np.r_[same, False]
                g, x, doc, place = (c[several] for c in cols)
                yield _rows(g, x | U(OPEN), doc, place)

    # Repeats decided already need no particular task: they are dealt out by document.
    share = F.when(F.col("x") == REPEAT, F.xxhash64("doc", "place")).otherwise(F.col("g"))
    return docs.mapInArrow(suffixes, _ENTRY).withColumn("share", share).repartition("share").drop("share").mapInArrow(scan, _ENTRY)


def remove_repeats(
    docs: DataFrame, length: int = 100, heavy: int = HEAVY, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    `with_text` adds the kept bytes as `kept`, and the row's other columns in the struct `carried`.
    """
    if not ANCHOR < length < SEGMENT // 2:
        raise ValueError(f"repeats must be longer than {ANCHOR} and shorter than {SEGMENT // 2} bytes")
    prepare(docs.sparkSession)
    bits = (length - ANCHOR + 1).bit_length()
    text = F.coalesce(F.col(text_col), F.lit(""))
    carried = [whole_row(docs, without=text_col).alias("carried")] if with_text else []
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("doc"), F.shiftrightunsigned(F.xxhash64(text), 33).alias("mark"), text.alias("text"), *carried
    )
    # One exchange of the texts, and one of what the index finds, serve both joins below.
    dealt = rows.repartition("doc", "mark")
    mark = F.shiftright("place", 32).alias("mark")
    found = repeats(rows.select("doc", "mark", "text"), length, heavy).groupBy("doc", mark).agg(F.collect_list(F.struct("g", "x", "place")).alias("found"))

    def lists(column):
        """A list column's flat values and, per row, where its own begin and end."""
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        size = np.array([0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], dtype=np.int64)
        flat = column.flatten()
        return [f.to_numpy(zero_copy_only=False) for f in flat.flatten()], np.r_[0, np.cumsum(size)]

    def by_window(batches):
        for b in batches:
            (g, x, place), at = lists(b["found"])
            open_ = np.flatnonzero((x & 3) == OPEN)
            if not len(open_):
                continue
            row = np.searchsorted(at, open_, side="right") - 1
            texts, docs_, around, kept = b["text"], b["doc"].to_numpy(), [], (-1, b"")
            for i, r in zip(open_.tolist(), row.tolist()):
                if kept[0] != r:
                    kept = (r, texts[r].as_py().encode())
                s = int(place[i]) & 0xFFFFFFFF
                around.append(kept[1][s:s + (int(x[i]) >> 2 & (1 << bits) - 1) + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[open_]), pa.array(docs_[row]), pa.array(place[open_]), pa.array(around, pa.binary())], ["g", "doc", "place", "around"]
            )

    def compare(batches):
        """Rows come by anchor: whole anchors are compared, some at a time."""
        held = [[], [], [], []]

        def settle(upto):
            cols = [c[:upto] for c in held]
            for c in held:
                del c[:upto]
            w = window_entries(cols[3], np.array(cols[1], dtype=np.int64), np.array(cols[2], dtype=np.int64), length)
            _, again = deduplicated(w)
            if again is not None:
                doc, place, n = runs(again[2], again[3], np.ones(len(again[2]), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (doc, place, n)], ["doc", "place", "n"])

        for b in batches:
            for c, name in zip(held, ("g", "doc", "place", "around")):
                c.extend(b[name].to_pylist())
            if sum(map(len, held[3])) - (length - 1) * len(held[3]) >= WINDOW_ROWS:
                last = held[0][-1]
                upto = next((i + 1 for i in range(len(held[0]) - 1, -1, -1) if held[0][i] != last), 0)
                if upto:
                    yield from settle(upto)
        if held[0]:
            yield from settle(len(held[0]))

    # A left join with all columns, so that both joins read the same exchange.
    near = dealt.join(found, ["doc", "mark"], "left").mapInArrow(by_window, "g long, doc long, place long, around binary")
    more = near.repartition("g").sortWithinPartitions("g").mapInArrow(compare, "doc long, place long, n long")
    more = more.groupBy("doc", mark).agg(F.collect_list(F.struct("place", "n")).alias("more"))

    def cut(batches):
        for b in batches:
            (g, x, place), at = lists(b["found"])
            (place2, n2), at2 = lists(b["more"])
            size, removed, spans, sha, kept = [], [], [], [], []
            for r, data in enumerate(b["text"].to_pylist()):
                data = data.encode()
                own, own2 = slice(at[r], at[r + 1]), slice(at2[r], at2[r + 1])
                done = (x[own] & 3) == REPEAT
                first = np.r_[place[own][done], place2[own2]].astype(np.int64) & 0xFFFFFFFF
                n = np.r_[g[own][done], n2[own2]].astype(np.int64)
                _, first, covered = runs(np.zeros(len(first), np.int64), first, n + length - 1)
                gone = list(zip(first.tolist(), (first + covered).tolist()))
                rest = b"".join(data[a:z] for a, z in zip([0, *(z for _, z in gone)], [*(a for a, _ in gone), len(data)]))
                size.append(len(data))
                removed.append(len(data) - len(rest))
                spans.append(len(gone))
                sha.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept.append(rest)
            cols = [b["doc_id"], pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                cols, names = cols + [pa.array(kept, pa.binary()), b["carried"]], names + ["kept", "carried"]
            yield pa.RecordBatch.from_arrays(cols, names)

    doc_id = F.when(F.col("doc") != _LOWEST, F.col("doc")).alias("doc_id")
    whole = dealt.join(found, ["doc", "mark"], "left").join(more, ["doc", "mark"], "left").select(
        doc_id, "text", "found", "more", *(["carried"] if with_text else [])
    )
    out = StructType.fromDDL("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    if with_text:
        out = out.add("kept", "binary").add("carried", rows.schema["carried"].dataType)
    return whole.mapInArrow(cut, out)


def without_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with repeats cut from the texts; a character of which a part goes, goes whole. Null texts become empty."""
    cut = remove_repeats(docs, length, id_col=id_col, text_col=text_col, with_text=True)

    def text(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: b.decode(errors="ignore"))

    new = F.pandas_udf(text, "string")(F.col("kept"))
    return cut.select(*[new.alias(c) if c == text_col else F.col("carried").getField(c).alias(c) for c in docs.columns])
