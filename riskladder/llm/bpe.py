"""Byte-level BPE encoding and decoding on padded numpy matrices.

Pieces (matches of the split pattern) are bucketed by length into padded matrices of ids, a row
per piece. Each round looks up the rank of every neighbouring pair in a hash table, merges in
every row the leftmost pair of minimum rank, and compacts the rows; rows without a mergeable
pair leave. A round costs the width of the matrix, so pieces of more than ``WIDEST`` bytes (runs without spaces)
are merged in the same order with a heap of pairs instead, in time n log n.

A text is first cut before every run of white space that follows another character. The pattern
always ends a match there and never looks back, so a chunk's matches do not depend on its
neighbours. Only distinct chunks are encoded; a cache of bounded bytes keeps the short ones for the worker.

Edge cases: null and empty texts have no ids and decode to nothing; every id belongs to one
text; repeated rows get equal results; no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.llm.arrays import tidy

CACHE_BYTES = 96 << 20         # of a worker's encoded chunks; dropping them costs time only
LONGEST_KEPT = 64              # characters of a chunk that is kept
WIDEST = 512                   # bytes of a piece that goes through the matrices
_ENTRY = 170                   # bytes of an entry besides its characters and ids
_STEP = 1 << 17                # ids decoded at a time
# white space other than single spaces and line feeds
_OTHER = re.compile("[\0" + re.escape("".join(c for c in map(chr, range(1 << 16)) if c.isspace() and c not in " \n")) + "]")
_BORDER = re.compile(r"(?<=\S)(?=[ \t\r\n])")
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class PairTable:
    """Open-addressing hash table: pair of ids -> (rank, merged id), looked up by array."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(2 * max(1, len(keys))).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _EMPTY)
        self.ranks = np.full(1 << bits, -1, np.int64)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] == _EMPTY
            take, first = np.unique(slot[todo][free], return_index=True)
            won = todo[free][first]
            self.keys[take], self.ranks[take] = keys[won], ranks[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            todo = todo[left[todo]]
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of the keys, -1 where there is none."""
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.ranks[slot], -1)
        todo = np.flatnonzero((got != keys) & (got != _EMPTY))
        while len(todo):
            slot[todo] = (slot[todo] + np.uint64(1)) & self.mask
            got = self.keys[slot[todo]]
            hit = got == keys[todo]
            out[todo[hit]] = self.ranks[slot[todo[hit]]]
            todo = todo[~hit & (got != _EMPTY)]
        return out


class Bpe:
    """Encoder and decoder for a rank file (base64 token and rank on each line)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = regex.compile(pattern)
        named = {v: k for k, v in ranks.items()}
        tokens = [named.get(i, b"") for i in range(max(named) + 1)]
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)      # all tokens, where each begins, its bytes
        self.size = np.array([len(x) for x in tokens], np.int32)
        self.begin = np.cumsum(self.size, dtype=np.int32) - self.size
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        left, right, rank = [], [], []
        for token, r in ranks.items():             # every split of a token into two tokens merges to it
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        keys = np.array(left, np.uint64) << np.uint64(32) | np.array(right, np.uint64)
        self.whole = ranks
        self.table = PairTable(keys, np.array(rank, np.int64))

    @classmethod
    def load(cls, path: str, pattern: str) -> "Bpe":
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return cls(ranks, pattern)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, all pieces of a length bucket at once."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            r = self.whole.get(p)
            if r is not None:
                out[i] = [r]
            elif not p:
                out[i] = []
            elif len(p) > WIDEST:
                out[i] = self._long(p)
            else:
                buckets.setdefault(len(p) if len(p) <= 16 else 1 << (len(p) - 1).bit_length(), []).append(i)
        for width, rows in buckets.items():
            step = max(1, (1 << 18) // width)
            for a in range(0, len(rows), step):
                self._bucket(rows[a:a + step], pieces, width, out)
        return out

    def _long(self, piece: bytes) -> list[int]:
        """Ids of a long piece: the same merges, the next one from a heap of (rank, place)."""
        rank = self.whole.get
        tok: list = [piece[i:i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(tok) + 1)), list(range(-1, len(tok) - 1))
        heap = [(r, i) for i in range(len(tok) - 1) if (r := rank(tok[i] + tok[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if tok[i] is None or j >= len(tok) or rank(both := tok[i] + tok[j]) != r:
                continue                           # one of the two was merged meanwhile
            tok[i], tok[j] = both, None
            after[i] = k = after[j]
            if k < len(tok):
                before[k] = i
                if (r := rank(both + tok[k])) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank(tok[h] + both)) is not None:
                heapq.heappush(heap, (r, h))
        return [self.whole[t] for t in tok if t]

    def _bucket(self, rows: list[int], pieces: list[bytes], width: int, out: list) -> None:
        flat = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width)
        ids = self.byte[flat]
        size = np.array([len(pieces[i]) for i in rows])
        who = np.array(rows)
        big = np.iinfo(np.int64).max
        ranks = self._ranks(ids, size, big)
        while len(who):
            at = ranks.argmin(1)                   # leftmost of the smallest rank
            row = np.arange(len(who))
            best = ranks[row, at] if ranks.shape[1] else np.full(len(who), big)
            done = best == big
            if done.any():
                end = np.cumsum(size[done])
                flat = ids[done][np.arange(ids.shape[1]) < size[done][:, None]].tolist()
                for i, a, b in zip(who[done].tolist(), (end - size[done]).tolist(), end.tolist()):
                    out[i] = flat[a:b]
            if done.all():
                return
            if done.any():
                ids, size, who, ranks, at, best = (x[~done] for x in (ids, size, who, ranks, at, best))
                row = np.arange(len(who))
            ids[row, at] = best
            # compact: everything right of the merged pair moves one place left
            cols = np.arange(ids.shape[1] - 1)
            move = cols[None, :] > at[:, None]
            ids = np.where(move, ids[:, 1:], ids[:, :-1])
            ranks = np.where(move[:, :-1], ranks[:, 1:], ranks[:, :-1])
            size = size - 1
            for shift in (-1, 0):                  # only the pairs beside the merged id are new
                p = at + shift
                r = np.flatnonzero((p >= 0) & (p < ranks.shape[1]))
                if not len(r):
                    continue
                new = np.full(len(r), big)
                inside = p[r] + 1 < size[r]
                rr, pp = r[inside], p[r[inside]]
                got = self.table.find(ids[rr, pp].astype(np.uint64) << np.uint64(32) | ids[rr, pp + 1].astype(np.uint64))
                new[inside] = np.where(got < 0, big, got)
                ranks[r, p[r]] = new

    def _ranks(self, ids: np.ndarray, size: np.ndarray, big: int) -> np.ndarray:
        keys = ids[:, :-1].astype(np.uint64) << np.uint64(32) | ids[:, 1:].astype(np.uint64)
        got = self.table.find(keys.ravel()).reshape(keys.shape)
        inside = np.arange(keys.shape[1])[None, :] + 1 < size[:, None]
        return np.where((got < 0) | ~inside, big, got)

    def decode(self, ids) -> bytes:
        """The ids' bytes, gathered from the token table a bounded number at a time."""
        ids, out = np.asarray(ids, np.int64), []
        for a in range(0, len(ids), _STEP):
            x = ids[a:a + _STEP]
            n = self.size[x]
            end = np.cumsum(n, dtype=np.int32)
            out.append(self.flat[np.repeat(self.begin[x] - (end - n), n) + np.arange(end[-1], dtype=np.int32)].tobytes())
        return b"".join(out)


def chunks_of(text: str) -> list[str]:
    """Pieces of a text at places where the pattern always splits."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or _OTHER.search(text):
        return _BORDER.split(text)
    # a chunk after a single space begins with that space; line feeds stand alone
    out = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
    return out[not out[0]:len(out) - (not out[-1])]


class ChunkCache:
    """Distinct chunks -> what they encode to (strings or bytes), within a bound of bytes. ``encode`` takes a list of chunks."""

    def __init__(self, encode: Callable[[list[str]], list]):
        self.encode = encode
        self.known: dict = {}
        self.used, self.bound = 0, CACHE_BYTES

    def _bytes(self, chunks) -> int:
        return sum(map(len, chunks)) + sum(map(len, map(self.known.__getitem__, chunks))) + _ENTRY * len(chunks)

    def fill(self, chunks: set[str]) -> None:
        new = list(chunks.difference(self.known))
        if self.used > self.bound:                 # entries in use stay
            self.known = {c: self.known[c] for c in chunks.intersection(self.known)}
            self.used = self._bytes(self.known)
        self.known.update(zip(new, self.encode(new)))
        self.used += self._bytes(new)

    def settle(self, chunks: set[str]) -> None:
        """After the texts of ``chunks`` are done: long ones go, and all that were met if they do not fit."""
        long = [c for c in chunks if len(c) > LONGEST_KEPT]
        if self.used - self._bytes(long) > 2 * self.bound:
            long = list(self.known)
        self.used -= self._bytes(long)
        for c in long:
            del self.known[c]


class _Cached(ChunkCache):
    """Distinct chunks -> comma-joined decimal ids."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        super().__init__(self._listed)

    def _listed(self, new: list[str]) -> list[str]:
        parts = list(map(self.bpe.pattern.findall, new))
        pieces = list(set().union(*parts))
        ids = self.bpe.encode_pieces([p.encode("utf-8", "surrogatepass") for p in pieces])
        one = {p: ",".join(map(str, x)) for p, x in zip(pieces, ids)}
        # most chunks are one piece
        return [one[x[0]] if len(x) == 1 else ",".join([one[p] for p in x]) for x in parts]


_LOADED: dict[tuple[str, str], _Cached] = {}


def _encoder(path: str, pattern: str) -> _Cached:
    key = (path, pattern)
    if key not in _LOADED:
        _LOADED[key] = _Cached(Bpe.load(path, pattern))
    return _LOADED[key]


def _groups(texts: list, max_chars: int = 500_000):
    """Runs of rows with about ``max_chars`` characters."""
    a = used = 0
    for i, t in enumerate(texts):
        used += len(t or "")
        if used >= max_chars:
            yield a, i + 1
            a, used = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def encode_decode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", id_col: str = "doc_id",
                  digests_only: bool = False, decoded: bool = True, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (array<int>), decoded (binary), and their
    digests ids_sha256, decoded_sha256. ``digests_only`` leaves ids and decoded out; without ``decoded``
    only its digest is returned (the column is null). A worker keeps about ``cache_bytes`` of distinct chunks."""

    def scan(batches):
        enc = _encoder(path, pattern)
        enc.bound = cache_bytes
        for b in batches:
            ids, texts = b.column("doc_id"), b.column("text").to_pylist()
            for lo, hi in _groups(texts):
                cut = [chunks_of(t) if t else [] for t in texts[lo:hi]]
                distinct = set().union(*cut)
                enc.fill(distinct)
                n, sha, dec, raw, back = [], [], [], [], []
                for x in cut:
                    listed = ",".join(map(enc.known.__getitem__, x))
                    n.append(listed.count(",") + 1 if listed else 0)
                    sha.append(hashlib.sha256(listed.encode()).hexdigest())
                    these = np.fromstring(listed, np.int32, sep=",") if listed else np.zeros(0, np.int32)
                    body = enc.bpe.decode(these)
                    dec.append(hashlib.sha256(body).hexdigest())
                    if not digests_only:
                        back.append(body if decoded else None)
                        raw.append(these)
                enc.settle(distinct)
                cols = [ids.slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(sha), pa.array(dec)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if not digests_only:
                    cols += [pa.array(raw, pa.list_(pa.int32())), pa.array(back, pa.binary())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if not digests_only:
        schema += ", ids array<int>, decoded binary"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(tidy(scan), schema)
