"""BPE encoding and decoding by forced-boundary splitting, and token counts from the same encoder.

A pair of neighbouring bytes that occurs inside no token of the vocabulary can never be merged across, so the place
between them is a certain cut. A text is cut at all such places in one vectorised step; the fragments are encoded on
their own (a cache keeps the frequent ones) and their ids are put together again.

The vocabulary is a byte-level BPE file of the `tokenizers` library. It is read once on the driver and broadcast
(about 1.5 MB, fixed), so executors need no file of their own.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal

#: Fixed value: the pre-tokenisation pattern of the byte-level BPE vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: The same with the white space of Unicode spelled out, for fragments that the compiled merger doesn't get.
PLAIN = PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")

#: Fragments of at most KEPT bytes kept in a worker's cache before it is emptied, about 20 MB; a task empties it at its end.
CACHE, KEPT = 80_000, 64
#: Bytes from which a fragment, such as a run of white space, is matched and merged here: the compiled matcher recurses over it.
LONG = 4096


def byte_chars() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryCodec:
    """Encodes and decodes with one vocabulary. Special tokens in a text are found first, as the library does."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        chars = byte_chars()
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        vocab = {bytes(chars[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in self.special}
        self.bytes_of = {i: t for t, i in vocab.items()} | {i: t.encode() for t, i in self.special.items()}
        self.vocab = vocab
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["model"]["merges"]]
        pairs = [(bytes(chars[c] for c in a), bytes(chars[c] for c in b)) for a, b in merges]
        self.ranks = {p: k for k, p in enumerate(pairs)}
        self.fast = self._fast([a + b for a, b in pairs])
        self._tables()
        self.cache: dict[bytes, list[int]] = {}

    def _fast(self, made: list[bytes]):
        """A compiled merger, usable if the ids of merged tokens grow in the order of the merges."""
        ids = [self.vocab[t] for t in made]
        if any(a >= b for a, b in zip(ids, ids[1:])) or any(self.vocab.get(bytes([b]), 1 << 30) >= min(ids, default=1 << 30) for b in range(256)):
            return None
        import tiktoken

        return tiktoken.Encoding("forced", pat_str=PATTERN, mergeable_ranks=self.vocab, special_tokens={})

    def _tables(self) -> None:
        """certain[a << 8 | b]: no token holds the bytes a, b side by side, and the cut leaves the pattern's matches as they are.

        The pattern looks ahead only at the end of white space, and only an apostrophe starts a match of its own in the
        middle of a run; so no cut follows white space or precedes an apostrophe, and none splits a character.
        """
        inside = np.zeros(1 << 16, bool)
        for t in self.vocab:
            for a, b in zip(t, t[1:]):
                inside[a << 8 | b] = True
        a, b = np.divmod(np.arange(1 << 16), 256)
        space = np.isin(a, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
        free = ~inside & (b != ord("'")) & ~((b >= 0x80) & (b < 0xC0))
        self.after_ascii = free & (a < 0x80) & ~space
        self.after_letter = free & (a >= 0x80) & (a < 0xC0)  # after two-byte characters from U+00C0 on, of which none is white space

    def fragments(self, raw: bytes) -> list[bytes]:
        """The text cut at all certain places."""
        if len(raw) < 2:
            return [raw] if raw else []
        x = np.frombuffer(raw, np.uint8)
        pair = x[:-1].astype(np.uint16) << 8 | x[1:]
        cut = self.after_ascii[pair]
        lead = (x[:-2] >= 0xC3) & (x[:-2] <= 0xDF)
        cut[1:] |= self.after_letter[pair[1:]] & lead
        at = (np.flatnonzero(cut) + 1).tolist()
        return [raw[i:j] for i, j in zip([0, *at], [*at, len(raw)])]

    def _merge(self, piece: bytes) -> list[int]:
        """Plain BPE of one match: the pair of lowest rank merges first, leftmost where equal. A heap holds the pairs, so time
        grows little faster than the match; a pair whose parts have changed since is skipped."""
        n = len(piece)
        part = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.ranks.get
        heap = [(r, i) for i in range(n - 1) if (r := rank((part[i], part[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if part[i] is None or j >= n or rank((part[i], part[j])) != r:
                continue
            part[i] += part[j]
            part[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := rank((part[i], part[k]))) is not None:
                    heapq.heappush(heap, (new, i))
            if (h := before[i]) >= 0 and (new := rank((part[h], part[i]))) is not None:
                heapq.heappush(heap, (new, h))
        return [self.vocab[p] for p in part if p is not None]

    def _match(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        return self._merge(piece) if self.fast is None or len(piece) >= LONG else self.fast.encode_ordinary(piece.decode())

    def _fragment(self, raw: bytes) -> list[int]:
        if self.fast is not None and len(raw) < LONG:
            ids = self.fast.encode_ordinary(raw.decode())
        else:
            import regex

            ids = list(chain.from_iterable(self._match(m[0].encode()) for m in regex.finditer(PLAIN, raw.decode())))
        if len(raw) <= KEPT:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[raw] = ids
        return ids

    def _plain(self, text: str) -> list[int]:
        get, frags = self.cache.get, self.fragments(text.encode())
        return list(chain.from_iterable([ids if (ids := get(f)) is not None else self._fragment(f) for f in frags]))

    def encode(self, text: str | None) -> list[int]:
        """Null counts as empty."""
        if not text:
            return []
        for mark, ident in self.special.items():
            if mark in text:
                head, *tails = text.split(mark)
                return self.encode(head) + [i for t in tails for i in (ident, *self.encode(t))]
        return self._plain(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_CODECS: dict[str, ForcedBoundaryCodec] = {}


def codec(spec: str) -> ForcedBoundaryCodec:
    """The codec of a vocabulary; a worker process keeps the last one."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = ForcedBoundaryCodec(spec)
    return _CODECS[key]


def with_codec(spec, run):
    """run(codec, batches) for mapInArrow; the cache of fragments goes with the task."""

    def each(batches):
        c = codec(spec.value)
        try:
            yield from run(c, batches)
        finally:
            c.cache.clear()

    return frugal(each)


def pieces(batches, rows: int = 256):
    """Slices of the batches: ids take more room than texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def broadcast_spec(spark, path: str):
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds `token_ids` (array<int>) and `decoded` (string) to every row, whole texts, by forced-boundary splitting.

    Null texts have no tokens and an empty decoded text; empty tables stay empty; equal rows give equal results. Columns
    of these names that docs has already are replaced. A map over partitions: no shuffle, and a lost task is run again.
    """
    spec = broadcast_spec(docs.sparkSession, path)
    kept = [c for c in docs.columns if c not in ("token_ids", "decoded")]
    docs = docs.select(*(f"`{c}`" for c in kept))
    schema = docs.withColumn("token_ids", F.array().cast("array<int>")).withColumn("decoded", F.lit("")).schema

    def run(c, batches):
        for part in pieces(batches):
            ids = [c.encode(t) for t in part.column(part.schema.get_field_index(text)).to_pylist()]
            made = [pa.array(ids, pa.list_(pa.int32())), pa.array([c.decode(i) for i in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*part.schema.names, "token_ids", "decoded"])

    return docs.mapInArrow(with_codec(spec, run), schema)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document, made beside the encoder, so that ids never travel.

    Null text: no tokens, the digests of nothing. Repeated rows and null ids stay as they are; extra columns are left out.
    """
    spec = broadcast_spec(docs.sparkSession, path)

    def run(c, batches):
        for part in pieces(batches):
            n, of_ids, of_text = [], [], []
            for t in part.column(1).to_pylist():
                ids = c.encode(t)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                of_text.append(hashlib.sha256(c.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(with_codec(spec, run), f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def section_bounds(text: str) -> np.ndarray:
    """Character offsets that cut a text into sections, both ends included: a section ends with a run of line ends (`\\n`), which
    belongs to it. An empty text is one empty section."""
    line_end = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10
    starts = np.flatnonzero(line_end[:-1] & ~line_end[1:]) + 1
    return np.concatenate([[0], starts, [len(text)]]).astype(np.int64)


def token_spans(raw: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets (end exclusive) of tokens that cover a text's bytes in order; a token that holds part of a character spans
    the whole of it, as the offsets of the `tokenizers` library do."""
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths)
    return char[ends - lengths], char[ends - 1] + 1


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether it crosses a boundary: an interval join of token spans and section bounds.

    A token that crosses goes to the section that holds its first character (`start`), its last (`end`), or most of its
    characters, the earliest where equal (`majority`). Each token counts once, so the sum is the document's count.
    """
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    if rule == "start":
        own = first
    elif rule == "end":
        own = last
    elif rule == "majority":
        own = first.copy()
        for i in np.flatnonzero(first != last):
            cuts = np.clip(bounds[first[i] : last[i] + 2], starts[i], ends[i])
            own[i] = first[i] + int(np.argmax(np.diff(cuts)))
    else:
        raise ValueError(f"no such rule: {rule}")
    return own, first != last


def section_token_counts(docs: DataFrame, path: str, rule: str = "majority", id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Token counts of every section of every document, from one encoding of the whole document.

    The tokens' character spans are joined to the section spans; `rule` says who gets a token that crosses a boundary (see
    attribute()). Returns id, section (from 0), start_char and end_char (code points, end exclusive), n_tokens, n_crossing
    (tokens of the section that also touch another) and doc_tokens. A null or empty text returns one row: section 0, no
    characters, no tokens. Repeated rows and null ids stay as they are; extra columns are left out.
    """
    spec = broadcast_spec(docs.sparkSession, path)
    names = [id_col, "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"]

    def run(c, batches):
        width = np.zeros(max(c.bytes_of) + 1, np.int64)
        for i, t in c.bytes_of.items():
            width[i] = len(t)
        for part in pieces(batches):
            found = []
            for k, t in enumerate(part.column(1).to_pylist()):
                t = t or ""
                bounds, ids = section_bounds(t), np.asarray(c.encode(t), np.int64)
                n = len(bounds) - 1
                counts = crossing = np.zeros(n, np.int64)
                if len(ids):
                    own, crosses = attribute(*token_spans(t.encode(), width[ids]), bounds, rule)
                    counts, crossing = np.bincount(own, minlength=n), np.bincount(own[crosses], minlength=n)
                found.append(np.stack([np.full(n, k), np.arange(n), bounds[:-1], bounds[1:], counts, crossing, np.full(n, len(ids))]))
            rows = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows[0])), *(pa.array(x, pa.int64()) for x in rows[1:])], names=names)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text).mapInArrow(with_codec(spec, run), f"`{id_col}` {kind}, section bigint, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint, doc_tokens bigint")
