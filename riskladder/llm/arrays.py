"""numpy building blocks for tasks: text buffers, word and window hashes, fixed-size sketches.

A task receives Arrow batches; ``text_chunks`` cuts them into pieces of bounded
bytes (one document is never cut), so the temporary arrays stay small whatever the
batch size. Nulls read as empty texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 2 << 20
NO_ID = np.iinfo(np.int64).max            # stands for a null id; sorts after every id

_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection), so that sums and top bits of hashes spread well."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n."""
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        m = max(n, 1 << 16)
        for key, base in (("p", _B), ("q", _B_INV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            _POWERS[key] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["p"][:n], _POWERS["q"][:n]


def tidy(scan: Callable) -> Callable:
    """``scan`` for mapInArrow; its worker gives freed memory back when a task ends, as
    workers live on for the tasks of later stages."""

    def run(batches):
        try:
            yield from scan(batches)
        finally:
            _POWERS.clear()
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return run


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True    # fixed values: word separators of the contract


class Text:
    """Some documents' UTF-8 bytes: ``data`` and ``off`` (one more than documents)."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, off: np.ndarray, rows: pa.RecordBatch):
        self.ids, self.data, self.off, self.rows = ids, data, off, rows

    def __len__(self) -> int:
        return len(self.off) - 1

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.off[i]:self.off[i + 1]].tobytes()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return body, off - off[0]


def int64(column: pa.Array, null: int = NO_ID) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def text_chunks(batches, text: str = "text", key: str | None = "doc_id",
                max_bytes: int = CHUNK_BYTES) -> Iterator[Text]:
    """The batches' documents in pieces of about ``max_bytes`` (at least one document each)."""
    for rows in batches:
        if not rows.num_rows:
            continue
        data, off = utf8(rows.column(text))
        ids = int64(rows.column(key)) if key else np.zeros(rows.num_rows, np.int64)
        a = 0
        while a < rows.num_rows:
            b = max(a + 1, int(np.searchsorted(off, off[a] + max_bytes, "right")) - 1)
            yield Text(ids[a:b], data[off[a]:off[b]], off[a:b + 1] - off[a], rows.slice(a, b - a))
            a = b


class Words:
    """Words of a ``Text``: hash, byte range, and the first word of each document."""

    def __init__(self, t: Text, lower: bool):
        data, off = t.data, t.off
        n = len(data)
        solid = ~_SPACE[data]
        first = np.zeros(n + 1, bool)
        first[off[:-1]] = True                     # a document starts here
        begins = solid.copy()
        begins[1:] &= ~solid[:-1] | first[1:n]
        ends = solid
        ends[:-1] = solid[:-1] & (~solid[1:] | first[1:n])
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        table = _BYTE_LOWER if lower else _BYTE
        p, q = powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(table[data] * p[:n], out=sums[1:])
        h = (sums[self.ends] - sums[self.starts]) * q[self.starts]
        self.hashes = mix(h + (self.ends - self.starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        self.first = np.searchsorted(self.starts, off)      # first word of each document, and the end
        self.counts = np.diff(self.first)


def window_hashes(w: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every run of ``n`` consecutive words inside one document: (hash, index of its first word,
    document)."""
    total = len(w.hashes) - n + 1
    if total <= 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z
    h = w.hashes[:total].copy()
    for k in range(1, n):
        h *= np.uint64(0x9FB21C651E98DF25)
        h += w.hashes[k:total + k]
    doc = np.repeat(np.arange(len(w.counts)), w.counts)
    at = np.flatnonzero(doc[:total] == doc[n - 1:total + n - 1])
    return mix(h[at] + np.uint64(n)), at, doc[at]


def small(a: np.ndarray) -> bytes:
    """Unsigned integers as bytes, a leading byte telling their width."""
    top = int(a.max()) if len(a) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([width]) + a.astype(f"<u{width}").tobytes()


def unsmall(b: bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{b[0]}", offset=1)


def fold_array(df: DataFrame, add: Callable[[np.ndarray, object], None], size: int, dtype: str = "uint32",
               merge: str = "sum", piece: int = 1 << 14) -> np.ndarray:
    """A fixed-size array gathered from all rows of ``df``.

    Every task updates its own array (``add(array, batches)``); the pieces are summed
    (or or-ed) by Spark, and ``size`` elements reach the driver: a bound that does not
    depend on the data, so the result may be broadcast.
    """

    def per_task(batches):
        a = np.zeros(size, dtype)
        add(a, batches)
        if a.any():
            keys = [k for k in range(-(-size // piece)) if a[k * piece:(k + 1) * piece].any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int32()), pa.array([small(a[k * piece:(k + 1) * piece]) for k in keys], pa.binary())],
                ["piece", "body"])

    def per_piece(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, body in zip(b.column("piece").to_pylist(), b.column("body").to_pylist()):
                x = unsmall(body).astype(dtype)
                if k not in sums:
                    sums[k] = x
                elif merge == "sum":
                    sums[k] = sums[k] + x
                else:
                    sums[k] = sums[k] | x
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.int32()), pa.array([small(x) for x in sums.values()], pa.binary())],
                ["piece", "body"])

    schema = "piece int, body binary"
    parts = df.mapInArrow(tidy(per_task), schema)
    out = np.zeros(size, dtype)
    whole = parts.repartition(min(-(-size // piece), 16), "piece").mapInArrow(tidy(per_piece), schema).toArrow()   # ``size`` elements at most
    for k, body in zip(whole.column("piece").to_pylist(), whole.column("body").to_pylist()):
        x = unsmall(body)
        out[k * piece:k * piece + len(x)] = x
    return out


def bloom_add(bits: np.ndarray, keys: np.ndarray) -> None:
    """Set two bits for each 64-bit key in a byte array used as a bitmap."""
    m = np.uint64(len(bits) * 8 - 1)
    for h in (mix(keys), mix(keys ^ np.uint64(0x5851F42D4C957F2D))):
        i = h & m
        np.bitwise_or.at(bits, (i >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (i & np.uint64(7)).astype(np.uint8)))


def bloom_has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    m = np.uint64(len(bits) * 8 - 1)
    ok = np.ones(len(keys), bool)
    for h in (mix(keys), mix(keys ^ np.uint64(0x5851F42D4C957F2D))):
        i = h & m
        ok &= (bits[(i >> np.uint64(3)).astype(np.int64)] >> (i & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return ok


def bloom_of(df: DataFrame, key: str, size: int = 1 << 22) -> np.ndarray:
    """Bitmap (``size`` bytes, a power of two) of an int64 column: lets a scan skip most rows that
    cannot join. It only saves work: the join itself stays exact, whatever the bitmap's load."""

    def add(bits, batches):
        for b in batches:
            bloom_add(bits, int64(b.column(key)).view(np.uint64))

    return fold_array(df.select(F.col(key).cast("long").alias(key)), add, size, "uint8", "or", 1 << 16)


def reduce_tasks(df: DataFrame) -> int:
    """Number of reduce tasks for hand-partitioned blobs: the session's shuffle partitions."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def segments(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of runs of equal values in a sorted array."""
    if not len(keys):
        z = np.zeros(0, np.int64)
        return z, z
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate([[0], cut])
    return starts, np.concatenate([cut, [len(keys)]])


def deal(part: np.ndarray, doc: np.ndarray, entries: dict[str, np.ndarray], docs: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Entries of a chunk's documents as one row per reduce task (column ``part``).

    ``doc`` (ascending) says which document an entry belongs to; document columns are
    stored once per task and document. Order inside a row: by document, then as given.
    """
    by = np.argsort(part, kind="stable")
    part, doc = part[by], doc[by]
    lo, hi = segments(part)
    cols: dict[str, list] = {"part": [], "per_doc": []} | {k: [] for k in (*entries, *docs)}
    moved = {k: v[by] for k, v in entries.items()}
    for a, b in zip(lo, hi):
        cut, end = segments(doc[a:b])
        which = doc[a:b][cut]
        cols["part"].append(int(part[a]))
        cols["per_doc"].append(small(end - cut))
        for k, v in moved.items():
            cols[k].append(v[a:b].tobytes() if v.dtype in (np.uint64, np.uint32) else small(v[a:b]))
        for k, v in docs.items():
            cols[k].append(v[which].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k == "part" else pa.binary()) for k, v in cols.items()],
                                      list(cols))


def dealt(batches, entries: dict[str, str], docs: dict[str, str]) -> tuple[dict[str, np.ndarray], np.ndarray, dict[str, np.ndarray]] | None:
    """All entries of a reduce task (see ``deal``): entry columns, each entry's document as an index,
    and document columns. The values give numpy types; "small" stands for width-tagged integers."""
    out: dict[str, list] = {k: [] for k in (*entries, *docs, "per_doc")}
    for b in batches:
        rows = {k: b.column(k).to_pylist() for k in out}
        for k, kind in (entries | docs | {"per_doc": "small"}).items():
            out[k] += [unsmall(x).astype(np.int32) if kind == "small" else np.frombuffer(x, kind) for x in rows[k]]
    if not out["per_doc"]:
        return None
    whole = {}
    for k in list(out):
        whole[k] = np.concatenate(out.pop(k))
    per = whole.pop("per_doc")
    return ({k: whole[k] for k in entries}, np.repeat(np.arange(len(per), dtype=np.int32), per), {k: whole[k] for k in docs})


def by_bits(hashes: np.ndarray, tasks: int) -> np.ndarray:
    """Reduce task of a 64-bit hash, from its top bits."""
    return ((hashes >> np.uint64(40)) % np.uint64(tasks)).astype(np.int32)


def with_bits(df: DataFrame, key: str, bits, has: bool = True) -> DataFrame:
    """Rows whose int64 ``key`` is (is not) in a broadcast bitmap, all columns kept."""

    def scan(batches):
        for b in batches:
            m = bloom_has(bits.value, int64(b.column(key)).view(np.uint64))
            yield b.filter(pa.array(m if has else ~m))

    return df.mapInArrow(tidy(scan), df.schema)


def merged(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals [lo, hi) as maximal runs (touching ones join), sorted."""
    if not len(lo):
        return lo, hi
    by = np.argsort(lo, kind="stable")
    lo, hi = lo[by], np.maximum.accumulate(hi[by])
    new = np.flatnonzero(np.concatenate([[True], lo[1:] > hi[:-1]]))
    return lo[new], hi[np.concatenate([new[1:] - 1, [len(hi) - 1]])]
