"""Benchmark decontamination by greedy string tiling.

Runs of MIN_MATCH words that a benchmark item and a document share are seeds; documents and items are joined by them. For each
pair with enough seeds, running Karp-Rabin greedy string tiling marks the longest matches that do not overlap, again and again;
the share of the item's words under tiles is its coverage. Passages count in whatever order they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, frugal, text_bytes, written
from .shingles import U, mix, powers, word_hashes

#: Words of a seed and of the shortest tile; coverage from which a document counts as contaminated.
MIN_MATCH, COVERAGE = 5, 0.5
#: Words of 64 bits in the map of the benchmark's seeds, 2 MB whatever the benchmark: it only spares the join seeds that can't meet.
MAP_BITS = 18
#: Separators between words: all ASCII but letters and digits. Words are compared in lower case.
SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(*text_bytes(pc.utf8_lower(texts)), SEPARATOR)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Running hash of `width` words from each word on, over all texts; those that run into another text must not be used."""
    n = max(len(words) - width + 1, 0)
    h = np.zeros(n, U)
    for j in range(width):
        h = h * U(0xD6E8FEB86659FD93) + words[j : j + n]
    return mix(h)


def windows(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place in the text and hash of every run of `width` words."""
    h = window_hashes(words, width)
    at = np.arange(len(h))
    text = np.searchsorted(starts, at, side="right") - 1
    inside = at + width <= starts[text + 1]
    return text[inside], (at - starts[text])[inside], mix(h[inside] + U(width))


def room(marked: np.ndarray) -> np.ndarray:
    """Words from each place on up to the next marked one or the end."""
    n = len(marked)
    stop = np.where(marked, np.arange(n), n)
    return np.minimum.accumulate(stop[::-1])[::-1] - np.arange(n)


class Runs:
    """One side of a pair: its words and hashes of any length at the places where a seed of both sides starts."""

    def __init__(self, words: np.ndarray):
        self.words, self.marked = words, np.zeros(len(words), bool)
        up, self.down = powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, U)
        np.cumsum(words * up[:-1], out=self.sums[1:])
        self.at = np.arange(len(words))

    def hashes(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of unmarked runs of this length and their hashes."""
        at = self.at[self.free >= length]
        return at, (self.sums[at + length] - self.sums[at]) * self.down[at]

    def measure(self) -> int:
        """Brings the room at each place up to date; returns the largest."""
        self.free = room(self.marked)[self.at]
        return int(self.free.max(initial=0))


def tiles(item: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """Which words of the item greedy string tiling marks in matches of at least `least` words.

    Each round finds the longest match that remains: the search length starts at the longest that could be, and is then halved
    in between until it is certain, each probe comparing the running hashes of all unmarked runs of that length. All matches of
    the round's length are marked by place in the item and the document, unless a word of either side is marked already.
    Places without a seed are left out at once, so a round costs no more than the seeds, and repeated words cost no pairs.
    """
    a, b = Runs(item), Runs(doc)
    most = min(a.measure(), b.measure())
    if most < least:
        return a.marked
    (i, hi), (j, hj) = a.hashes(least), b.hashes(least)
    a.at, b.at = i[np.isin(hi, hj)], j[np.isin(hj, hi)]
    while True:
        most = min(most, a.measure(), b.measure())
        if most < least or not meet(a, b, least):
            return a.marked
        low, high = (most, most) if meet(a, b, most) else (least, most - 1)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if meet(a, b, middle) else (low, middle - 1)
        mark(a, b, low)
        most = low


def meet(a: Runs, b: Runs, length: int) -> bool:
    return bool(np.isin(a.hashes(length)[1], b.hashes(length)[1]).any())


def mark(a: Runs, b: Runs, length: int) -> None:
    """Marks the matches of one length. A run of the document that is of no use to one place is of none to the next of the
    round, so each is looked at once."""
    (i, hi), (j, hj) = a.hashes(length), b.hashes(length)
    own = np.isin(hi, hj)
    i, hi = i[own], hi[own]
    other = np.isin(hj, hi)
    j, hj = j[other], hj[other]
    order = np.argsort(hj, kind="stable")
    j, hj = j[order], hj[order]
    begin = dict(zip(hi.tolist(), np.searchsorted(hj, hi).tolist()))
    end = dict(zip(hi.tolist(), np.searchsorted(hj, hi, side="right").tolist()))
    taken = 0
    for p, h in zip(i.tolist(), hi.tolist()):
        if p < taken:
            continue
        k = begin[h]
        while k < end[h] and b.marked[j[k] : j[k] + length].any():
            k += 1
        begin[h] = k
        if k < end[h] and (a.words[p : p + length] == b.words[j[k] : j[k] + length]).all():
            a.marked[p : p + length] = b.marked[j[k] : j[k] + length] = True
            taken = p + length


def item_seeds(items: DataFrame, least: int) -> DataFrame:
    """item, n (words of the item), seed and at (place) of every run of `least` words; a shorter item has all its words as one run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 1 << 18):
                words, starts = words_of(part.column(1))
                n = np.diff(starts)
                for width in range(1, least + 1):
                    text, at, h = windows(words, starts, width)
                    own = (n[text] == width) | ((width == least) & (n[text] > least))
                    text, at, h = text[own], at[own], h[own]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text)), pa.array(n[text], pa.int32()), pa.array(h.view(np.int64)), pa.array(at, pa.int32())], names=["item", "n", "seed", "at"])

    return items.select("item", "text").mapInArrow(frugal(run), "item bigint, n int, seed bigint, at int")


def seed_map(seeds: DataFrame) -> np.ndarray:
    """A bit for each seed of the benchmark, in 64-bit words: at most 2 ** MAP_BITS rows come to the driver, however many seeds."""
    place = F.shiftrightunsigned("seed", 64 - MAP_BITS).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {64 - MAP_BITS - 6}) & 63 as int))")
    got = seeds.groupBy(place.alias("place")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << MAP_BITS, np.int64)
    out[got["place"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(U)


def suspects(docs: DataFrame, id_col: str, text: str, known: np.ndarray, widths: list[int], least: int, need: int) -> DataFrame:
    """id, text, th (digest of the text) and seeds (each once) of the documents that may hold an item.

    Any run as short as a short item makes one; of runs of `least` words there must be `need`, as a pair of less coverage is
    left out anyway. A bit of the map that another seed has set lets a seed through that the join then drops.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for part in chunks(batch, text, 1 << 18):
                words, starts = words_of(part.column(1))
                found, enough = [], np.zeros(part.num_rows, bool)
                for width in widths:
                    doc, _, h = windows(words, starts, width)
                    hit = np.flatnonzero((bits[(h >> U(64 - MAP_BITS)).astype(np.int64)] >> ((h >> U(58 - MAP_BITS)) & U(63))) & U(1))
                    some = np.unique(np.stack([doc[hit].astype(U), h[hit]]), axis=1) if len(hit) else np.zeros((2, 0), U)
                    enough |= np.bincount(some[0].astype(np.int64), minlength=part.num_rows) >= (need if width == least else 1)
                    found.append(some)
                doc, h = np.concatenate(found, axis=1)
                order = np.argsort(doc, kind="stable")
                ends = np.searchsorted(doc[order], np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(h[order].view(np.int64)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=["id", "text", "th", "seeds"]).filter(pa.array(enough))

    th = F.unhex(F.md5(F.col(text)))
    return docs.where(F.col(text).isNotNull()).select(id_col, text, th.alias("th")).mapInArrow(frugal(run), f"id {kind}, text string, th binary, seeds array<bigint>")


def reach(places: Column, width: Column) -> Column:
    """Words under seeds of this width at sorted places of an item."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(-1).alias("end"))

    def step(a: Column, p: Column) -> Column:
        return F.struct((a["sum"] + p + width - F.greatest(p, a["end"])).alias("sum"), (p + width).alias("end"))

    return F.aggregate(places, start, step, lambda a: a["sum"])


def tiled(pairs: DataFrame, least: int, coverage: float) -> DataFrame:
    """id, th, item_id, coverage of the pairs (id, th, item_id, text, item_text) that cover enough."""
    i, d = pairs.schema["id"].dataType, pairs.schema["item_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 1 << 18):
                (dw, ds), (iw, is_) = words_of(part.column(3)), words_of(part.column(4))
                share = []
                for k in range(part.num_rows):
                    item = iw[is_[k] : is_[k + 1]]
                    share.append(float(tiles(item, dw[ds[k] : ds[k + 1]], min(least, len(item))).mean()))
                out = pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(share, pa.float64())], names=["id", "th", "item_id", "coverage"])
                yield out.filter(pc.greater_equal(out.column(3), coverage))

    return pairs.select("id", "th", "item_id", "text", "item_text").mapInArrow(frugal(run), f"id {i.simpleString()}, th binary, item_id {d.simpleString()}, coverage double")


def found(docs: DataFrame, benchmark: DataFrame, coverage: float, least: int, id_col: str, text: str, item_id: str) -> DataFrame:
    """id, th, item_id, coverage, see overlaps(); th is the digest of the document's text."""
    items = benchmark.where(F.col(text).isNotNull()).select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    items = written(items.withColumn("item", F.monotonically_increasing_id()), "items")  # numbers are fixed once written
    seeds = written(item_seeds(items, least), "seeds")
    # a seed that an item repeats covers more of it
    often = seeds.groupBy("item", "n", "seed").agg(F.count("*").alias("times")).groupBy("item", "n").agg(F.max("times").alias("times"))
    fewest = F.min(F.when(F.col("n") >= least, F.ceil(F.col("n") * coverage / (F.col("times") * least))))
    sizes = often.agg(F.collect_set(F.least("n", F.lit(least))).alias("widths"), fewest.alias("need")).first()
    need = max(1, sizes["need"] or 1)
    some = suspects(docs, id_col, text, seed_map(seeds), sorted(sizes["widths"]) or [least], least, need)
    some = written(some.withColumn("row", F.monotonically_increasing_id()), "suspects")
    hits = some.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed")
    places = hits.groupBy("row", "item", "n").agg(F.sort_array(F.collect_set("at")).alias("at"))
    near = places.where(reach(F.col("at"), F.least("n", F.lit(least))) >= F.col("n") * coverage).select("row", "item")
    pairs = near.join(items.withColumnRenamed("text", "item_text"), "item").join(some.select("row", "id", "th", "text"), "row")
    return tiled(pairs, least, coverage)


def overlaps(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = MIN_MATCH, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """id, item_id, coverage of every pair of a document and a benchmark item whose coverage is at least `coverage`.

    Seeds bound the coverage from above, so pairs that cannot reach it are not tiled; all others are. An item of fewer than
    `least` words is found where a document holds the whole of it in one run. Whole texts, every row for itself: repeated rows
    and items give repeated pairs, null ids stay null, null and empty texts match nothing, other columns are left out. One pass
    over the documents, whatever the size of the benchmark; only documents that share seeds are written and joined.
    """
    got = found(docs, benchmark, coverage, least, id_col, text, item_id)
    return got.select(F.col("id").alias(id_col), F.col("item_id").alias(item_id), "coverage")


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id") -> DataFrame:
    """docs without those that cover a benchmark item, each row judged by its own text, with or without an id."""
    bad = found(docs, benchmark, coverage, MIN_MATCH, id_col, text, item_id).select(F.col("id").alias("__bad_id"), F.col("th").alias("__bad_th")).distinct()
    marked = docs.withColumn("__th", F.unhex(F.md5(F.col(text))))
    return marked.join(bad, F.col(id_col).eqNullSafe(F.col("__bad_id")) & (F.col("__th") == F.col("__bad_th")), "left_anti").select(*docs.columns)
