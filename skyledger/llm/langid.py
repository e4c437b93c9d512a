"""Language ID by mixture inference.

Each language is a multinomial over hashed character trigrams. A document is a mixture of languages: expectation-
maximisation estimates the proportions from the likelihoods of its trigrams, and the set of languages is the one whose
likelihood, less a penalty for each language more, is greatest. The document's language is the largest of that set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import chunks, frugal

#: Trigram buckets, texts of each language that the model is fitted on at most, and rounds of expectation-maximisation.
BUCKETS, FIT_DOCS, ROUNDS = 4096, 2000, 15
#: A further language must raise the log-likelihood by this many times log(trigrams) and explain this share of them.
PENALTY, LEAST_SHARE = 3.0, 0.02

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of every trigram of lower-case letters and word ends; one whose middle is no letter is left out."""
    lowered = [t.lower() for t in texts]
    cp = np.frombuffer(("  " + "  ".join(lowered) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), np.fromiter((len(t) + 2 for t in lowered), np.int64, len(lowered)))
    is_letter = letters()[cp]
    cp = np.where(is_letter, cp, 32).astype(np.uint64)
    mixed = cp[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ cp[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ cp[2:] * np.uint64(0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    keep = is_letter[1:-1]
    return doc[: len(keep)][keep[: len(doc)]], ((mixed >> np.uint64(40)) % np.uint64(BUCKETS)).astype(np.int64)[keep]


def sparse_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, bucket and count of the trigrams, by document and bucket."""
    doc, bucket = trigrams(texts)
    dense = np.bincount(doc * BUCKETS + bucket, minlength=len(texts) * BUCKETS)
    at = np.flatnonzero(dense)
    return at // BUCKETS, at % BUCKETS, dense[at].astype(np.float64)


class Mixture:
    """The languages and the log-probabilities of their trigrams."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts + 0.1
        self.p = smooth / smooth.sum(axis=1, keepdims=True)  # language x bucket
        self.log = np.log(self.p)

    def _em(self, n: int, doc: np.ndarray, p: np.ndarray, count: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log-likelihood of each of n documents within the allowed languages (n x languages)."""
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        at = doc[starts]
        of = np.repeat(np.arange(len(at)), np.diff(np.r_[starts, len(doc)]))
        share = np.ascontiguousarray((allowed / allowed.sum(axis=1, keepdims=True))[at].T)  # language x document
        total = np.add.reduceat(count, starts)
        for _ in range(ROUNDS):
            w = share[:, of] * p
            w *= count / w.sum(axis=0)
            new = np.add.reduceat(w, starts, axis=1) / total
            moved = np.abs(new - share).max()
            share = new
            if moved < 1e-4:
                break
        like = np.zeros(n)
        like[at] = np.add.reduceat(count * np.log((share[:, of] * p).sum(axis=0)), starts)
        out = allowed / allowed.sum(axis=1, keepdims=True)
        out[at] = share.T
        return out, like

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and its proportion within the selected set; `und` and 0 where a text has no letter or nothing was learned."""
        n, k = len(texts), len(self.langs)
        lang, score = ["und"] * n, np.zeros(n)
        if not k or not n:
            return lang, score
        doc, bucket, count = sparse_counts(texts)
        if not len(doc):
            return lang, score
        p = self.p[:, bucket]
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        at = doc[starts]
        size = np.ones(n)
        size[at] = np.maximum(np.add.reduceat(count, starts), 2)
        alone = np.full((n, k), -np.inf)
        alone[at] = np.add.reduceat(self.log[:, bucket] * count, starts, axis=1).T
        full, most = self._em(n, doc, p, count, np.ones((n, k)))
        best = np.eye(k)[alone.argmax(axis=1)]
        value = alone.max(axis=1)
        fee = PENALTY * np.log(size)
        order = np.argsort(-full, axis=1, kind="stable")
        open_ = np.zeros(n, bool)
        open_[at] = most[at] - fee[at] > value[at]  # no set can beat the likelihood of all languages
        for m in range(2, k + 1):
            if not open_.any():
                break
            ids = np.flatnonzero(open_)
            rows = np.isin(doc, ids)
            allowed = np.zeros((n, k))
            np.put_along_axis(allowed, order[:, :m], 1, axis=1)
            share, like = self._em(n, doc[rows], p[:, rows], count[rows], allowed)
            smallest = np.where(allowed > 0, share, 1).min(axis=1)
            better = open_ & (like - fee * (m - 1) > value) & (smallest >= LEAST_SHARE)
            value[better] = (like - fee * (m - 1))[better]
            best[better] = share[better]
            open_ &= better & (most - fee * m > value)
        for i in at:
            j = int(best[i].argmax())
            lang[i], score[i] = self.langs[j], min(1.0, float(best[i, j]))
        return lang, score


def fitting_rows(docs: DataFrame, per_lang: int, id_col: str, lang: str) -> DataFrame:
    """id, lang of at most per_lang rows of each language: those whose hashed id is smallest. Only ids and languages move.

    A language's ids are first cut at the hash below which twice per_lang of its rows are expected, so that a ranking task
    gets a few thousand ids, however many rows the language has. An id counts with all its rows, so an id of more rows than the
    bound teaches nothing. Rows without an id or a language are left out.
    """
    some = docs.select(id_col, lang).where(F.col(id_col).isNotNull() & F.col(lang).isNotNull()).withColumn("_h", F.xxhash64(id_col))
    share = some.groupBy(lang).agg((F.lit(2.0 * per_lang) / F.count("*")).alias("_s"))  # one row a language, as the model has
    low = some.join(F.broadcast(share), lang).where(F.col("_h") / 2.0**64 + 0.5 <= F.col("_s")).groupBy(id_col, lang, "_h").agg(F.count("*").alias("_n"))
    w = Window.partitionBy(lang).orderBy("_h", id_col).rowsBetween(Window.unboundedPreceding, 0)
    return low.withColumn("_r", F.sum("_n").over(w)).where(F.col("_r") <= per_lang).select(id_col, lang)


def fit(labelled: DataFrame, per_lang: int = FIT_DOCS, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> Mixture:
    """The trigram counts of each language over at most `per_lang` whole labelled texts of it (the documented bound).

    Executors count and add up; the driver gets BUCKETS numbers for each language. Null texts and
    languages teach nothing; an empty table gives a model without languages.
    """
    ids = fitting_rows(labelled, per_lang, id_col, lang)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).join(F.broadcast(ids), [id_col, lang], "left_semi").select(id_col, text, lang)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in chunks(batch, text):
                langs = part.column(2).to_pylist()
                _, bucket = (z := trigrams(part.column(1).to_pylist()))
                for name in set(langs):
                    mine = np.fromiter((x == name for x in langs), bool, len(langs))[z[0]]
                    sums[name] = sums.get(name, 0) + np.bincount(bucket[mine], minlength=BUCKETS)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "counts"])

    parts = rows.mapInArrow(frugal(count), "lang string, counts array<bigint>")
    cells = parts.select("lang", F.posexplode("counts").alias("bucket", "n")).where("n > 0").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    got = cells.toPandas()  # at most BUCKETS rows for each language
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(langs), BUCKETS))
    for i, name in enumerate(langs):
        mine = got[got["lang"] == name]
        counts[i, mine["bucket"].to_numpy()] = mine["n"].to_numpy()
    return Mixture(langs, counts)


def predict(docs: DataFrame, model: Mixture, text: str = "text") -> DataFrame:
    """Adds lang_pred and score to every row. A map over partitions; the model (a few vectors) is broadcast.

    A null text or one without a letter gets `und` and 0. Columns of these names are replaced; other columns stay.
    """
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c not in ("lang_pred", "score")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for part in chunks(batch, text, 1 << 19):
                texts = [t or "" for t in part.column(at).to_pylist()]
                lang, score = [], []
                for s in range(0, len(texts), 256):
                    a, b = shared.value.predict(texts[s : s + 256])
                    lang += a
                    score += b.tolist()
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*part.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(frugal(run), schema)
