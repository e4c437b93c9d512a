"""Near-duplicates by DartMinHash: sparse weighted signatures, banded joining, an exact check, and components.

Darts are thrown by hashing into the plane of weight and rank: the plane above each element is cut into regions that are the
same for all documents, the hash of (element, region) says how many darts fell there and where. A document keeps the darts
below its weights; each dart belongs to one coordinate, and a coordinate's value is its dart of lowest rank. Two documents
agree at a coordinate with the probability of their weighted Jaccard similarity. Weights are the counts of the shingles; a text
that repeats some is signed as a plain set too, so that texts meet that are similar in either sense.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, dropped, frugal, text_bytes, written
from .shingles import U, mix, numbered, shingle_hashes, word_hashes

#: Words of a shingle; bands and coordinates of a band. A pair at 0.8 shares no band with a chance of 5e-6.
WIDTH, BANDS, ROWS = 5, 40, 6
#: Rank borders of the regions over weights 0 to 1; beyond 1 a region for each unit. Wider weights have lower regions.
LOW = np.array([0, 0.125, 0.25, 0.5])
#: Words of 64 bits in the map of the rows to drop, however many these are: a row without its bit there is kept, and its text doesn't move.
MAP_BITS = 18
#: Elements whose darts are thrown at once, and texts that are signed at once: about 1 800 darts each.
BLOCK, SIGNED = 1 << 16, 16


def border(i: np.ndarray) -> np.ndarray:
    return np.where(i < 4, LOW[np.minimum(i, 3)], i - 3.0)


def regions(rank: np.ndarray) -> np.ndarray:
    """How many regions lie below a rank, the last one in part."""
    return np.where(rank > 0.5, np.ceil(rank) + 3, np.searchsorted(LOW, rank, side="left")).astype(np.int64)


def unit(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Element index, rank and hash of all darts under each element's weight and (at least) its rank bound."""
    found = []
    level, width, low = 0, 1.0, 0.0
    while True:
        high = np.flatnonzero(weights > low)
        if not len(high):
            break
        n = regions(rank[high] * width)
        e = np.repeat(high, n)
        r = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        area = border(r + 1) - border(r)
        h = mix(elements[e] + mix((r.astype(U) << U(8)) + U(level + 1)))
        u, count, term, total = unit(h), np.zeros(len(e), np.int64), np.exp(-area), np.exp(-area)
        for k in range(1, 16):  # Poisson by inversion
            more = u >= total
            if not more.any():
                break
            count += more
            term = term * area / k
            total = total + term
        some = np.flatnonzero(count)
        e, r, h, area, count = e[some], r[some], h[some], area[some], count[some]
        j = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        h = mix(np.repeat(h, count) + U(0x9E3779B97F4A7C15) * (j.astype(U) + U(1)))
        e, r, area = np.repeat(e, count), np.repeat(r, count), np.repeat(area, count)
        at = (border(r) + area * unit(h)) / width
        under = low + width * unit(mix(h ^ U(0x5851F42D4C957F2D))) < weights[e] if level or (weights < 1).any() else slice(None)
        found.append((e[under], at[under], h[under]))
        low, width, level = (1.0, 1.0, 1) if level == 0 else (low + width, width * 2, level + 1)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, U))


def signatures(doc: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, k: int) -> np.ndarray:
    """n x k signature values. doc: each element's document, in order. A document's rank bound doubles until no coordinate is
    empty; documents without elements keep zeros. Darts are thrown for BLOCK elements at a time."""
    out = np.zeros((n, k), U)
    total = np.bincount(doc, weights, minlength=n)
    bound = np.zeros(n)
    bound[total > 0] = k * (np.log(k) + 2) / total[total > 0]
    todo = total > 0
    while todo.any():
        mine = np.flatnonzero(todo[doc])
        best, rank = np.zeros(n * k, U), np.full(n * k, np.inf)
        for s in range(0, len(mine), BLOCK):
            some = mine[s : s + BLOCK]
            e, at, h = darts(elements[some], weights[some], bound[doc[some]])
            cell = doc[some][e] * k + (mix(h ^ U(0x2545F4914F6CDD1D)) % U(k)).astype(np.int64)
            lower = np.flatnonzero(at < rank[cell])
            order = lower[np.argsort(-at[lower])]
            best[cell[order]] = h[order]  # the last, of lowest rank, stays
            rank[cell[order]] = at[order]
        full = np.isfinite(rank).reshape(n, k).all(axis=1) & todo
        out[full] = best.reshape(n, k)[full]
        todo &= ~full
        bound[todo] *= 2
    return out


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each document and band."""
    h = np.zeros((len(sig), bands), U) + np.arange(1, bands + 1, dtype=U)
    for r in range(rows):
        h = mix(h + sig.reshape(len(sig), bands, rows)[:, :, r])
    return h


def _shingles(part: pa.RecordBatch, column: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words, starts = word_hashes(*text_bytes(part.column(column)))
    return (*shingle_hashes(words, starts, width), words, starts)


def signed(docs: DataFrame, id_col: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """id, th (digest of the text), fp (128-bit digest of the words in order) and keys of every row whose text has a word.

    keys has one key a band for the signature of the text's set of shingles and, if a shingle occurs again, one more a band
    for the signature with counts as weights. Texts without repeated shingles have one signature, as both are equal.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, text, 1 << 18):
                for s in range(0, piece.num_rows, SIGNED):
                    part = piece.slice(s, SIGNED)
                    n = part.num_rows
                    doc, h, count, words, starts = _shingles(part, 1, width)
                    keys = [band_keys(signatures(doc, h, np.ones(len(h)), n, bands * rows), bands, rows)]
                    again = np.zeros(n, bool)
                    again[doc[count > 1]] = True
                    if again.any():
                        sub = again[doc]
                        place = np.cumsum(again) - 1
                        more = signatures(place[doc[sub]], h[sub], count[sub].astype(np.float64), int(again.sum()), bands * rows)
                        keys.append(band_keys(more, bands, rows))
                    owner = np.concatenate([np.arange(n), np.flatnonzero(again)])
                    order = np.argsort(owner, kind="stable")
                    ends = np.r_[0, np.cumsum(1 + again)].astype(np.int32) * bands
                    fp = [hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() for a, b in zip(starts[:-1], starts[1:])]
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)[order].ravel().view(np.int64)))
                    out = pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fp, pa.binary()), lists], names=["id", "th", "fp", "keys"])
                    yield out.filter(pa.array(np.diff(starts) > 0))

    return docs.select(id_col, text, digest(text).alias("th")).mapInArrow(frugal(run), f"id {kind}, th binary, fp binary, keys array<bigint>")


def digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))


def similar(pairs: DataFrame, texts: DataFrame, width: int, least: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) whose shingles have a Jaccard similarity of least[0] / least[1] or more, as sets or with counts as weights.

    The texts of both sides join to the pairs; a side that many pairs share is a skewed key that adaptive execution splits.
    """
    a, b = texts.toDF("a", "ta"), texts.toDF("b", "tb")
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in chunks(batch, "ta", 1 << 18):
                for part in chunks(half, "tb", 1 << 18):
                    n = part.num_rows
                    (da, ha, ca, *_), (db, hb, cb, *_) = _shingles(part, 2, width), _shingles(part, 3, width)
                    d, h, c = np.concatenate([da, db]), np.concatenate([ha, hb]), np.concatenate([ca, cb])
                    order = np.lexsort((h, d))
                    d, h, c = d[order], h[order], c[order]
                    same = np.flatnonzero((d[1:] == d[:-1]) & (h[1:] == h[:-1]))
                    ok = np.zeros(n, bool)
                    for w, both in ((np.ones(len(d)), np.ones(len(same))), (c, np.minimum(c[same], c[same + 1]))):
                        shared = np.bincount(d[same], both, minlength=n)
                        ok |= shared * least[1] >= (np.bincount(d, w, minlength=n) - shared) * least[0]
                    yield part.select(["a", "b"]).filter(pa.array(ok))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(frugal(run), f"a {kind}, b {kind}")


def rarest(texts: DataFrame, width: int, least: tuple[int, int], counted: bool) -> DataFrame:
    """node, n (shingles) and `rare`: the first three tenths (for 4/5) of each text's shingles in the order of their number of
    texts. counted: a shingle that occurs again is one more for each time.

    If two sets share `need` elements, the first k of these stand among the first n - need + k of either, whatever the order;
    rare ones first leave few pairs that pass this test without being similar.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 1 << 18):
                doc, h, count, *_ = _shingles(part, 1, width)
                if counted:
                    doc, h = numbered(doc, h, count)
                bounds = np.searchsorted(doc, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(bounds), pa.array(h.view(np.int64)))], names=["node", "all"])

    each = texts.select("node", "text").mapInArrow(frugal(run), "node bigint, all array<bigint>").select("node", F.explode("all").alias("h"))
    counts = each.join(each.groupBy("h").agg(F.count("*").alias("df")), "h")
    whole = counts.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    n = F.size("s")
    length = (n - F.ceil(n * least[0] / F.lit(least[1])) + F.ceil(n / 10)).cast("int")
    return whole.select("node", F.struct(n.alias("n"), F.transform(F.slice("s", F.lit(1), length), lambda x: x["h"]).alias("rare")).alias("counted" if counted else "plain"))


def may_be_similar(a: Column, b: Column, least: tuple[int, int]) -> Column:
    """Whether two sets (n, rare) can be similar by their sizes and rare elements: similar sets have `need` common elements, of
    which the first `within` stand in both lists."""
    need = F.ceil((a["n"] + b["n"]) * least[0] / F.lit(least[0] + least[1]))
    within = need - F.greatest(a["n"] - F.size(a["rare"]), b["n"] - F.size(b["rare"]))
    sizes = F.least(a["n"], b["n"]) * least[1] >= F.greatest(a["n"], b["n"]) * least[0]
    return sizes & (F.size(F.array_intersect(a["rare"], b["rare"])) >= within)


def components(edges: DataFrame) -> DataFrame:
    """node, label: the smallest node of each connected component of the edges (a, b), as a table in the shared folder.

    Each round takes the smallest label among a node's neighbours and then the label of that label, until nothing changes.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select("node", "label", F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("top"))
        new = written(step.join(up, "low").select("node", F.col("label").alias("was"), F.least("low", "top").alias("label")), "labels")
        changed = new.where(F.col("label") != F.col("was")).limit(1).count()
        dropped(labels)
        labels = new.select("node", "label")
        if not changed:
            dropped(both)
            return labels


def linked(docs: DataFrame, id_col: str, text: str, width: int, bands: int, rows: int, least: tuple[int, int]) -> tuple[DataFrame, DataFrame]:
    """Two tables in the shared folder: rows (id, th, node) of every row with an id and a word, and links (a, b) between nodes.

    A node is a text (by its words in order), not an id, so ids that repeat with other texts lose no link. In each band, texts
    with the same key meet: each is first compared with the most connected of its bucket; buckets that then still hold more
    than one component have all pairs across components compared that can be similar by their sizes and rare shingles, so no
    link that a band has found is lost, while a bucket of mutual copies costs one comparison a member.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull())
    sig = written(signed(source, "id", "text", width, bands, rows), "signatures")
    # the numbers of the written table are fixed, whichever task made them
    nodes = sig.groupBy("fp").agg(F.min(F.struct("id", "th")).alias("first"), F.any_value("keys").alias("keys"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    own = written(sig.select("id", "th", "fp").join(nodes.select("fp", "node"), "fp").select("id", "th", "node"), "rows")
    dropped(sig)
    banded = written(nodes.select("node", F.explode(F.array_distinct("keys")).alias("key")), "bands")
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    some = written(banded.join(shared, "key"), "shared")
    dropped(banded)
    # the head of a bucket is its member that meets most others, so that copies of a text meet it rather than each other
    central = some.groupBy("node").agg(F.sum("n").alias("meets"))
    heads = some.join(central, "node").groupBy("key").agg(F.max_by("node", F.struct("meets", "node")).alias("head"))
    met = written(some.select("key", "node").join(heads, "key"), "buckets")
    dropped(some)
    first = written(met.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(), "pairs")
    wanted = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", "first.id", "first.th")
    # a node's first row may stand there again; the join has brought such rows together already
    texts = source.withColumn("th", digest("text")).join(wanted, ["id", "th"]).dropDuplicates(["id", "th"]).select("node", "text")
    texts = written(texts, "texts")
    dropped(nodes)
    links = written(similar(first, texts, width, least), "links")
    labels = components(links)
    known = met.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    several = known.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key")
    unsettled = written(known.join(several, "key", "left_semi"), "unsettled")
    dropped(met)
    dropped(labels)
    open_texts = texts.join(unsettled.select("node").distinct(), "node", "left_semi")
    rest = unsettled.join(rarest(open_texts, width, least, False), "node").join(rarest(open_texts, width, least, True), "node")
    rest = written(rest.select("key", "node", "label", "plain", "counted"), "open")
    l, r = rest.toDF("key", "a", "la", "pa", "ca"), rest.toDF("key", "b", "lb", "pb", "cb")
    fits = (F.col("la") > F.col("lb")) & (may_be_similar(F.col("pa"), F.col("pb"), least) | may_be_similar(F.col("ca"), F.col("cb"), least))
    cross = l.join(r, (l.key == r.key) & fits).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    both = first.union(first.select("b", "a"))
    more = written(similar(cross.join(both, ["a", "b"], "left_anti"), texts, width, least), "links")
    all_ = written(links.union(more), "links")
    for used in (unsettled, rest, first, texts, links, more):
        dropped(used)
    return own, all_


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """id and class_id (smallest id of the class) of every row: the components of the links between texts whose shingles have
    a similarity of at least `least`, as sets or with their counts as weights.

    Rows of equal id share a class, so the texts of an id are linked by it; texts of equal words are one. A text without a
    word (or null) is a class of its own, as is a row without an id (class null). Words are split at white space only, case
    and punctuation count. Other columns are left out. Nothing is collected to the driver.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    own, links = linked(docs, id_col, text, width, bands, rows, least)
    ends = own.groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("z")).where("b <> z").select("id", "b")
    by_id = own.join(ends, "id").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    labels = components(links.union(by_id))
    of_row = own.join(labels, "node", "left").select("id", F.coalesce("label", "node").alias("label"))
    names = of_row.groupBy("label").agg(F.min("id").alias("class_id"))
    named = of_row.distinct().join(names, "label").select(F.col("id").alias("_id"), "class_id")
    out = docs.select(F.col(id_col)).join(named, F.col(id_col) == F.col("_id"), "left")
    return out.select(id_col, F.coalesce("class_id", id_col).cast(kind).alias("class_id"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with one row of each class of texts: that of the smallest id, of rows of one id that of the smallest digest.

    Here an id links nothing: rows that share an id but not a class both stay. Rows without an id or a word stay, however
    often they occur. All columns stay as they are.
    """
    own, links = linked(docs, id_col, text, WIDTH, BANDS, ROWS, (4, 5))
    labels = components(links)
    of_row = own.join(labels, "node", "left").select(F.coalesce("label", "node").alias("label"), F.struct("id", "th").alias("row"))
    counted = of_row.groupBy("label", "row").agg(F.count("*").alias("n"))
    best = counted.groupBy("label").agg(F.min("row").alias("best"))
    judged = counted.join(best, "label")
    gone = judged.where((F.col("row") != F.col("best")) | (F.col("n") > 1))
    gone = written(gone.select(F.col("row.id").alias("__gone_id"), F.col("row.th").alias("__gone_th"), (F.col("row") == F.col("best")).alias("__gone_one")), "gone")
    spot = F.expr("cast(__spot & 63 AS int)")
    place = F.shiftrightunsigned("__spot", 64 - MAP_BITS).alias("__place")
    known = gone.select(F.xxhash64("__gone_id", "__gone_th").alias("__spot")).groupBy(place).agg(F.bit_or(F.expr("shiftleft(1L, cast(__spot & 63 AS int))")).alias("__bits"))
    marked = docs.withColumn("__th", digest(text)).withColumn("__spot", F.xxhash64(id_col, "__th")).withColumn("__place", place)
    marked = marked.join(F.broadcast(known), "__place", "left").withColumn("__maybe", F.coalesce(F.getbit("__bits", spot), F.lit(0)) == 1)
    maybe = marked.where("__maybe")
    same = (F.col(id_col) == F.col("__gone_id")) & F.col("__th").eqNullSafe(F.col("__gone_th"))
    single = marked.where("NOT __maybe").select(*docs.columns).unionByName(maybe.join(gone, same, "left_anti").select(*docs.columns))
    if not gone.where("__gone_one").head(1):  # no kept row occurs again, so texts needn't move for it
        return single
    again = maybe.join(gone.where("__gone_one"), same, "left_semi").dropDuplicates([id_col, "__th"]).select(*docs.columns)
    return single.unionByName(again)
