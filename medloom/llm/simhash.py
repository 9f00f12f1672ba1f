"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint's bit is 1 when more than half of the text's shingle hashes have it. Fingerprints link at
`max_bits` or fewer differing bits. To find links, a fingerprint maps to its counts of ones in 32 segments
of 2 bits. The Manhattan distance of two such vectors never exceeds the number of differing bits, so

1. the segments form `blocks` groups; vectors within `max_bits` agree in all but `max_bits` groups, so every
   link lies in a grid cell given by the counts of some `blocks - max_bits` groups;
2. within a cell, pairs are held against the Manhattan distance, then against the exact number of bits.

Equal fingerprints are joined before that, so copies cost one row. A cell with more than `tile` fingerprints
is split: rows get a part, and every pair of parts is a task of its own. A task gives back, instead of all
pairs, the links that keep its connected fingerprints connected.

Words are what lies between ASCII white space after lower-casing A-Z; fewer words than a shingle count as
one shingle, and a text without words (null included) has fingerprint zero, linked like any other. Repeated
rows are in one component and each comes back; a null id comes back but names no component unless all ids
of its component are null. Other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from medloom.llm.common import components, prepare, stored, whole_row

SEED, TILE = 42, 512
#: Pairs compared at a time in a task.
PAIRS = 2_000_000


def shingle_hashes(text: str, words: int, seed: int = SEED) -> np.ndarray:
    """The hash of each shingle, repeated ones included; none without words."""
    from xxhash import xxh64_intdigest

    parts = text.encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    ends = list(itertools.accumulate(map(len, parts)))
    n = max(1, len(parts) - words + 1)
    starts = [0, *(e + i + 1 for i, e in enumerate(ends[:-1]))][:n]
    stops = [ends[i + words - 1] + i + words - 1 for i in range(n)] if len(parts) >= words else [len(joined)]
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)


def fingerprint(text: str, words: int, seed: int = SEED) -> int:
    return fingerprint_of(shingle_hashes(text, words, seed))


def fingerprint_of(hashes: np.ndarray) -> int:
    n = len(hashes)
    if not n:
        return 0
    lanes = hashes.view(np.uint8).reshape(n, 8).astype(np.int64) + np.arange(8) * 256
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256)
    ones = counts @ _BYTE_BITS  # lane, bit
    return int.from_bytes(np.packbits(ones * 2 > n, axis=1, bitorder="little").tobytes(), "little")


_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, mark, fp): fp the fingerprint as a signed long, mark a digest of the text."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in b["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["mark"], pa.array(fp.view(np.int64))], ["doc_id", "mark", "fp"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, fp long")


def _spread(mask_segments) -> int:
    value = sum(3 << (2 * s) for s in mask_segments)
    return value - (1 << 64) if value >> 63 else value


def linked_pairs(v: np.ndarray, f: np.ndarray, max_bits: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs link: first the Manhattan distance of the segment counts, then the bits themselves."""
    low = np.uint64(0x5555555555555555)
    a, b = v[i], v[j]
    # Both counts are 0 to 2 in two bits; |a - b| per segment is 2 only where one is 0 and the other 2.
    odd, two_a, two_b = (a ^ b) & low, (a >> np.uint64(1)) & low, (b >> np.uint64(1)) & low
    apart = np.bitwise_count(odd) + 2 * np.bitwise_count((two_a ^ two_b) & ~odd)
    keep = np.flatnonzero(apart <= max_bits)
    return keep[np.bitwise_count(f[i[keep]] ^ f[j[keep]]) <= max_bits]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position connected to each of n positions."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            return label


def fingerprint_links(fps: DataFrame, max_bits: int, blocks: int = 6, tile: int = TILE) -> DataFrame:
    """(a, b): links that connect just the distinct fingerprints (column fp) that chains of links connect."""
    groups = [range(32 * g // blocks, 32 * (g + 1) // blocks) for g in range(blocks)]
    masks = [_spread(itertools.chain(*pick)) for pick in itertools.combinations(groups, blocks - max_bits)]
    # Counts of ones per 2 bits, side by side in one long.
    high, low = F.shiftrightunsigned("fp", 1), F.lit(0x5555555555555555)
    embedded = F.shiftleft(high.bitwiseAND(F.col("fp")).bitwiseAND(low), 1).bitwiseOR(high.bitwiseXOR(F.col("fp")).bitwiseAND(low))
    cells = fps.select("fp", embedded.alias("v")).select(
        "fp", "v", F.posexplode(F.array(*[F.col("v").bitwiseAND(F.lit(m)) for m in masks])).alias("g", "cell")
    )
    size = cells.groupBy("g", "cell").count().filter("count > 1")
    part = F.pmod(F.xxhash64("fp"), F.ceil(F.col("count") / tile))
    in_parts = cells.join(size, ["g", "cell"]).withColumn("mine", part.cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.ceil(F.col("count") / tile).cast("int") - 1))
    )
    tasks = in_parts.select("g", "cell", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"), "fp", "v")

    def run(batches):
        rest = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                t = pa.Table.from_batches([b])
                rest = t if rest is None else pa.concat_tables([rest, t])
            if rest is None or rest.num_rows == 0:
                continue
            key = [rest[c].to_numpy() for c in ("g", "cell", "p", "q")]
            new = np.flatnonzero(np.r_[True, np.any([k[1:] != k[:-1] for k in key], axis=0)])
            last = len(key[0]) if b is None else new[-1]  # the last task's rows may go on in the next batch
            bounds = np.r_[new[new < last], last]
            fp, v = (rest[c].to_numpy().view(np.uint64) for c in ("fp", "v"))
            at = 0
            while at < len(bounds) - 1:
                pairs, to = 0, at
                while to < len(bounds) - 1 and (to == at or pairs + (bounds[to + 1] - bounds[to]) ** 2 // 2 <= PAIRS):
                    pairs += (bounds[to + 1] - bounds[to]) ** 2 // 2
                    to += 1
                lo, hi = bounds[at], bounds[to]
                end = np.repeat(bounds[at + 1:to + 1], np.diff(bounds[at:to + 1])) - lo
                f, w = fp[lo:hi], v[lo:hi]
                i, found, d = np.arange(hi - lo), [], 1
                while len(i := i[i + d < end[i]]):
                    k = linked_pairs(w, f, max_bits, i, i + d)
                    found.append((i[k], i[k] + d))
                    d += 1
                at = to
                if found and sum(len(x) for x, _ in found):
                    label = forest(hi - lo, *(np.concatenate(x) for x in zip(*found)))
                    k = np.flatnonzero(label != np.arange(hi - lo))
                    yield pa.RecordBatch.from_arrays([pa.array(f[k].view(np.int64)), pa.array(f[label[k]].view(np.int64))], ["a", "b"])
            rest = None if b is None else rest.slice(last)

    order = ["g", "cell", "p", "q"]
    return tasks.repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long").filter("a <> b")


def groups(
    docs: DataFrame, words: int = 4, max_bits: int = 4, blocks: int = 6, tile: int = TILE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: doc_id, mark (a digest of the text), fp, and root, the same for all rows of a component."""
    prints = stored(fingerprints(docs, words, id_col, text_col), "fingerprints")
    fps = stored(prints.select("fp").distinct(), "distinct")
    roots = components(fingerprint_links(fps, max_bits, blocks, tile), "a", "b")
    placed = fps.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))
    return prints.join(placed, "fp")


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable. Options as for `groups`."""
    found = stored(groups(docs, **options).select("doc_id", "fp", "root"), "groups")
    least = found.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "root").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of `docs` per component, that with the smallest id, all its columns kept. Options as for `groups`."""
    return _first_of_each(docs, groups(docs, id_col=id_col, text_col=text_col, **options), id_col, text_col)


def _first_of_each(docs: DataFrame, found: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of `found` (doc_id, mark, root) the row of `docs` with the smallest id per root."""
    lowest = F.lit(-(1 << 63))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", lowest).alias("_id"), F.col("mark").alias("_mark"))).alias("k"))
    keyed = docs.select(
        whole_row(docs).alias("row"), F.coalesce(F.col(id_col).cast("long"), lowest).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_mark")
    )
    # Rows equal in id and text are all the first of their component: one of them stays. The join has dealt them out alike.
    each = Window.partitionBy("_id", "_mark").orderBy("_id", "_mark")
    left = keyed.join(first.select("k._id", "k._mark"), ["_id", "_mark"]).withColumn("n", F.row_number().over(each)).filter("n = 1")
    return left.select("row.*")
