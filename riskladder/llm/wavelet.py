"""Token ids in wavelet-matrix shards.

Documents are encoded in ascending id order, an end id after each, and written as shards of
whole documents. A shard is one compressed file: a wavelet matrix holds the ids as one bit-plane
per id bit, most significant first; each plane is ordered by the bits above it (zeros before
ones). With rank over the planes a token is read (``access``), counted (``rank``, ``count``)
and its occurrences found (``select``) without unpacking the ids.

The shards are rows of a Parquet table (range of ids, sequence in it, first document, counts, file),
so any storage Spark writes to will do. A document's place in the whole stream is the running sum
over the shards' counts plus its place in the shard.

Edge cases: null and empty texts are the end id alone; strings of special tokens in a text become those tokens, as
the library does by default; null ids come first; equal ids are
ordered by a hash of the text, repeated rows are documents of their own; no rows give no shards.
"""

from __future__ import annotations

import array
import json
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskladder.llm import arrays as A
from riskladder.llm.bpe import LONGEST_KEPT, ChunkCache, chunks_of
from riskladder.llm.running import running_sums
from riskladder.session import ensure_checkpoint_dir

SHARD_TOKENS = 1 << 19
CACHE_BYTES = 320 << 20        # of a worker's encoded chunks; dropping them costs time only
_MAGIC = b"WMX1"


class WaveletMatrix:
    """Bit-planes with rank and select over a sequence of unsigned ids."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int]):
        self.n, self.planes, self.zeros = n, planes, zeros
        self._ones: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        planes, zeros = [], []
        for level in range(bits - 1, -1, -1):
            one = (ids >> level & 1).astype(bool)
            planes.append(np.packbits(one, bitorder="little"))
            # places and take: a random mask costs twice as much
            low, high = np.flatnonzero(~one), np.flatnonzero(one)
            zeros.append(len(low))
            ids = np.concatenate([ids.take(low), ids.take(high)])
        return cls(int(len(ids)), planes, zeros)

    def _bit(self, level: int, i: np.ndarray) -> np.ndarray:
        return self.planes[level][i >> 3] >> (i & 7).astype(np.uint8) & 1

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        """Ones before position i: a count per byte block, and the bits of the last byte."""
        if self._ones is None:
            self._ones = [np.concatenate([[0], np.cumsum(np.bitwise_count(p))]).astype(np.int64) for p in self.planes]
        i = np.asarray(i, np.int64)
        byte, rest = i >> 3, (i & 7).astype(np.uint8)
        last = self.planes[level][np.minimum(byte, max(len(self.planes[level]) - 1, 0))] if self.n else np.zeros(i.shape, np.uint8)
        part = np.bitwise_count(last & ((np.uint16(1) << rest) - 1).astype(np.uint8))
        return self._ones[level][byte] + np.where(rest > 0, part, 0)

    def access(self, at) -> np.ndarray:
        """Ids at the given positions."""
        i = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(i), np.int64)
        for level in range(len(self.planes)):
            one = self._bit(level, i).astype(bool)
            r = self._rank1(level, i)
            i = np.where(one, self.zeros[level] + r, i - r)
            out = out << 1 | one
        return out

    def rank(self, token: int, end: int) -> int:
        """Occurrences of ``token`` before position ``end``."""
        lo, hi = 0, min(end, self.n)
        for level in range(len(self.planes)):
            a, b = (int(self._rank1(level, np.array([x]))[0]) for x in (lo, hi))
            if token >> (len(self.planes) - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError("no such occurrence")
        lo, hi = 0, self.n
        while lo < hi:                             # the smallest end with k + 1 occurrences before it
            mid = (lo + hi) // 2
            if self.rank(token, mid + 1) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def tokens(self) -> np.ndarray:
        """The whole sequence: the planes undone from the last to the first."""
        ids = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in range(len(self.planes) - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").astype(bool)
            z = self.zeros[level]
            back = np.empty_like(ids)
            back[np.flatnonzero(~one)] = ids[:z]
            back[np.flatnonzero(one)] = ids[z:] | ids.dtype.type(1 << (len(self.planes) - 1 - level))
            ids = back
        return ids


def pack_shard(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """A shard file: header, document ids and token counts, then the compressed planes."""
    m = WaveletMatrix.build(ids, bits)
    squeeze = zstandard.ZstdCompressor(level=1).compress
    blobs = [squeeze(doc_ids.astype("<i8").tobytes()), squeeze(counts.astype("<u4").tobytes()), *(squeeze(p.tobytes()) for p in m.planes)]
    head = _MAGIC + struct.pack("<QIB", m.n, len(doc_ids), bits) + np.array(m.zeros, "<u8").tobytes()
    return head + np.array([len(b) for b in blobs], "<u4").tobytes() + b"".join(blobs)


def open_shard(data: bytes) -> tuple[np.ndarray, np.ndarray, WaveletMatrix]:
    """(document ids, token counts, wavelet matrix) of a shard file."""
    if data[:4] != _MAGIC:
        raise ValueError("not a shard file")
    n, docs, bits = struct.unpack_from("<QIB", data, 4)
    at = 4 + struct.calcsize("<QIB")
    zeros = np.frombuffer(data, "<u8", bits, at).astype(int).tolist()
    at += 8 * bits
    sizes = np.frombuffer(data, "<u4", bits + 2, at)
    at += 4 * (bits + 2)
    loose = zstandard.ZstdDecompressor().decompress
    blobs = []
    for s in sizes.tolist():
        blobs.append(loose(data[at:at + s]))
        at += s
    planes = [np.frombuffer(b, np.uint8) for b in blobs[2:]]
    return np.frombuffer(blobs[0], "<i8"), np.frombuffer(blobs[1], "<u4").astype(np.int64), WaveletMatrix(n, planes, zeros)


_INNER = re.compile(r"\s")
# texts that chunks_of does not cut at every single space and line feed
_UNEVEN = r"  |\n\n| \n|\n |[" + "".join(rf"\x{{{x:x}}}" for x in range(1 << 16) if not x or (chr(x).isspace() and chr(x) not in " \n")) + "]"
_MARKS = ".,;:!?#$*%&|<>()-\""      # after a letter the library begins a piece with these and ends it after the last of them
_TOGETHER = 256                # chunks encoded in one string
_GROUP_BYTES = 16 << 20        # of texts encoded at a time
_STEP = 1 << 20                # chunks whose ids are gathered at a time


def _on_a_line(c: str) -> bool:
    """Whether a chunk encodes the same on a line of its own among others: no white space but a single space in front."""
    return _INNER.search(c, 1) is None and (not c[0].isspace() or (c[0] == " " and len(c) > 1))


class _Encoder(ChunkCache):
    """Distinct chunks -> their ids, 16 bits each; the tokenizers library does the encoding.

    Special tokens are those of the library's default call: a text is first split at their strings. Chunks of one word
    after a space are encoded many at a time in one string, as a chunk begins at every such space; the tokens' bytes tell
    where each ends. If the tokenizer splits texts by the byte-level pattern, a word and the marks after it are encoded once
    each. Others that can stand on a line are joined by line feeds: a line feed is a piece by itself."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = self.tok.get_added_tokens_decoder().values()
        # strings that take neighbouring spaces with them, or stand at word borders only, need the whole text
        self.whole = [t.content for t in added if t.lstrip or t.rstrip or t.single_word]
        plain = sorted((t.content for t in added if t.content not in self.whole), key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, plain)) + ")") if plain else None
        self.strings = [t.content for t in added]
        made = json.loads(self.tok.to_str())
        split = made.get("pre_tokenizer") or {}
        self.marks = _MARKS if split.get("type") == "ByteLevel" and split.get("use_regex", True) and not made.get("normalizer") else ""
        size = max(self.tok.get_vocab().values(), default=0) + 1
        self.size = np.array([len(self.tok.id_to_token(i) or "") for i in range(size)], np.int64)    # a character stands for a byte
        super().__init__(self._ids)
        self.bound = CACHE_BYTES

    def chunks(self, text: str) -> list[str]:
        if any(s in text for s in self.whole):
            return [text]
        if self.special is None or not self.special.search(text):
            return chunks_of(text)
        return [c for k, part in enumerate(self.special.split(text)) if part for c in ([part] if k % 2 else chunks_of(part))]

    def _one_by_one(self, texts: list[str]):
        for e in self.tok.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, np.uint32)
            if len(ids) and ids.max() >= 1 << 16:
                raise ValueError("ids over 16 bits need a wider shard type")
            yield ids.astype(np.uint16)

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of chunks that may follow each other in one string; those are left out whose tokens do not end where they do."""
        found: dict[str, bytes] = {}
        sizes = pc.binary_length(pa.array(words, pa.string())).to_numpy()
        for a in range(0, len(words), _TOGETHER):
            part = words[a:a + _TOGETHER]
            ids = next(self._one_by_one(["".join(part)]))
            token_ends, ends = np.cumsum(self.size[ids]), np.cumsum(sizes[a:a + _TOGETHER])
            at = np.searchsorted(token_ends, ends)
            if len(ids) and token_ends[-1] == ends[-1] and (token_ends[at] == ends).all():
                body, cut = ids.tobytes(), (2 * at + 2).tolist()
                found.update(zip(part, [body[x:y] for x, y in zip([0, *cut], cut)]))
        return found

    def _ids(self, new: list[str]) -> list[bytes]:
        words, marked = [], []
        for i, c in enumerate(new):
            if c[0] == " " and c.split() == [c[1:]]:
                x = c.rstrip(self.marks) if self.marks else c
                if x != c and x[-1:].isalpha():
                    marked.append((i, x, c[len(x):]))
                else:
                    words.append(c)
        found = self._words(list({*words, *(x for _, x, _ in marked if x not in self.known)}))
        out = list(map(found.get, new))
        tails = list({t for _, _, t in marked})
        tails = dict(zip(tails, (x.tobytes() for x in self._one_by_one(tails))))
        for i, x, t in marked:
            if head := found.get(x) or self.known.get(x):
                out[i] = head + tails[t]
        feed = next(self._one_by_one(["\n"]))
        lines = [i for i, x in enumerate(out) if x is None and _on_a_line(new[i])] if len(feed) == 1 else []
        for a in range(0, len(lines), 4096):
            at = lines[a:a + 4096]
            ids = next(self._one_by_one(["\n".join([new[i] for i in at])]))
            cut = np.flatnonzero(ids == feed[0])
            if len(cut) != len(at) - 1:            # a piece went over a line's end
                continue
            body, cut = ids.tobytes(), (2 * cut).tolist()
            for i, x, y in zip(at, [0, *(x + 2 for x in cut)], [*cut, len(body)]):
                out[i] = body[x:y]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, x in zip(rest, self._one_by_one([new[i] for i in rest])):
            out[i] = x.tobytes()
        return out

    def encode_texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text. Texts with single spaces and line feeds only are cut and their chunks numbered by Arrow."""
        texts = texts.cast(pa.large_string())
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        for s in self.strings:
            uneven = pc.or_(uneven, pc.match_substring(texts, s))
        uneven = uneven.fill_null(True).to_numpy(zero_copy_only=False)
        even, others = np.flatnonzero(~uneven), np.flatnonzero(uneven)
        cut = [self.chunks(t) if t else [] for t in texts.take(pa.array(others)).to_pylist()]
        split = pc.replace_substring(pc.replace_substring(texts.take(pa.array(even)), " ", "\0 "), "\n", "\0\n\0")
        split = pc.split_pattern(split, "\0")
        coded = split.flatten().dictionary_encode()
        names, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy().astype(np.intp)
        words = set().union(*cut)
        parts = list(map(self.known.get, names))
        missing = [i for i, x in enumerate(parts) if x is None]
        if words or self.used > self.bound:        # entries in use stay
            self.fill(words.union(names).difference([""]))
        else:
            new = [c for i in missing if (c := names[i])]
            self.known.update(zip(new, self.encode(new)))
            self.used += self._bytes(new)
        for i in missing:                          # no ids: before a border at the start of a text, after one at its end
            parts[i] = self.known[names[i]] if names[i] else b""

        out: list = [b""] * len(texts)
        for i, x in zip(others.tolist(), cut):
            out[i] = b"".join(map(self.known.__getitem__, x))
        table, n = np.frombuffer(b"".join(parts), np.uint16), np.fromiter(map(len, parts), np.int64, len(parts)) // 2
        begin = np.cumsum(n) - n
        ends = np.concatenate([[0], np.cumsum(n.take(codes))])
        ids = np.empty(ends[-1], np.uint16)
        for a in range(0, len(codes), _STEP):
            c = codes[a:a + _STEP]
            x, y = ends[a], ends[a + len(c)]
            ids[x:y] = table.take(np.repeat(begin.take(c) - (ends[a:a + len(c)] - x), n.take(c)) + np.arange(y - x))
        at = ends[split.offsets.to_numpy()].tolist()
        for i, x, y in zip(even.tolist(), at, at[1:]):
            out[i] = ids[x:y].tobytes()
        long = pc.greater(pc.utf8_length(coded.dictionary), LONGEST_KEPT)
        self.settle(words.union(coded.dictionary.filter(long).to_pylist()))
        return out


_ENCODERS: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    """The worker's encoder: a function of the module, so that tasks share it (a task's own function has its own globals)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def _grouped(batches):
    """The rows in tables of about ``_GROUP_BYTES`` of text or one row, whatever the batches: a chunk is looked up once in each."""
    rows, held = [], 0
    for b in batches:
        used = np.cumsum(pc.binary_length(b.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        a = 0
        while a < len(used):
            z = int(np.searchsorted(used, (used[a - 1] if a else 0) + _GROUP_BYTES - held)) + 1
            rows.append(b.slice(a, z - a))
            if z <= len(used):
                yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
                rows, held = [], 0
            else:
                held += int(used[-1] - (used[a - 1] if a else 0))
            a = z
    if rows:
        yield pa.Table.from_batches(rows).combine_chunks().to_batches()[0]


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, bits: int = 16, text_col: str = "text",
                 id_col: str = "doc_id") -> None:
    """Encode every document and write the shard table to ``path`` (ids of at most 16 bits)."""

    def scan(batches):
        ids, sizes, bodies, total, seq = [], [], [], 0, 0
        end = array.array("H", [end_id]).tobytes()

        def out():
            nonlocal ids, sizes, bodies, total, seq
            first = ids[0]
            file = pack_shard(np.array(ids), np.array(sizes), np.frombuffer(b"".join(bodies), np.uint16), bits)
            row = pa.RecordBatch.from_arrays(
                [pa.array([None if first == A.NO_ID else first], pa.int64()), pa.array([seq], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([total], pa.int64()), pa.array([file], pa.binary())], ["first_doc", "seq", "n_docs", "n_tokens", "file"])
            ids, sizes, bodies, total, seq = [], [], [], 0, seq + 1
            return row

        enc = _encoder(tokenizer)
        for b in _grouped(batches):
            for key, body in zip(A.int64(b.column("doc_id")).tolist(), enc.encode_texts(b.column("text"))):
                body += end
                ids.append(key)
                sizes.append(len(body) // 2)
                bodies.append(body)
                total += len(body) // 2
                if total >= SHARD_TOKENS:
                    yield out()
        if ids:
            yield out()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # ties are spread too: many rows of one id (or none) do not meet in one range
    order = [F.col("doc_id"), F.xxhash64("text"), F.xxhash64(F.monotonically_increasing_id())]
    src = src.withColumns({"_k1": order[1], "_k2": order[2]})
    placed = src.repartitionByRange(A.reduce_tasks(docs), "doc_id", "_k1", "_k2").sortWithinPartitions("doc_id", "_k1", "_k2").select("doc_id", "text")
    (placed.mapInArrow(A.tidy(scan), "first_doc long, seq long, n_docs long, n_tokens long, file binary")
     .withColumn("part", F.spark_partition_id()).write.option("compression", "none").parquet(path))


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a shard table: doc_id, start, n_tokens, ids_crc32, and ids if asked for."""
    shards = spark.read.parquet(path)
    starts = running_sums(shards.select("part", "seq", "n_tokens"), [F.col("part"), F.col("seq")], {"start": "n_tokens"})
    starts = starts.select(F.col("part").alias("_p"), F.col("seq").alias("_s"), F.col("start").alias("shard_start"))

    def scan(batches):
        for b in batches:
            for part, seq, file in zip(*(b.column(c).to_pylist() for c in ("part", "seq", "file"))):
                ids, counts, m = open_shard(file)
                tokens = m.tokens().astype("<u4")
                cut = np.concatenate([[0], np.cumsum(counts)])
                n = len(ids)
                cols = [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int64()), pa.array(ids, mask=ids == A.NO_ID),
                        pa.array(cut[:-1]), pa.array(counts),
                        pa.array([zlib.crc32(tokens[x:y]) for x, y in zip(cut[:-1], cut[1:])], pa.int64())]
                names = ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([tokens[x:y].astype(np.int32) for x, y in zip(cut[:-1], cut[1:])], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = "part int, seq long, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    docs = shards.select("part", "seq", "file").mapInArrow(scan, schema)
    out = docs.join(starts, (F.col("part") == F.col("_p")) & (F.col("seq") == F.col("_s")))
    return out.select("doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def shard_path(spark: SparkSession) -> str:
    """A new place for a shard table in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/token-shards-{uuid.uuid4().hex}"
