"""Token counts of texts with a whole-token shortcut.

Offline, on the driver, the vocabulary proves three things about a sentencepiece BPE model:

* no piece has a space mark after another character, so no merge crosses the border before a
  space that follows another character, and texts fall into pre-tokens there;
* no piece of several characters holds a line feed, so a line feed always stands alone;
* which vocabulary strings, encoded alone, are one token (each is encoded once).

In a task a pre-token that is one of the proven strings counts one token and is never merged;
only the rest is merged by the library, each distinct pre-token once per task while a cache
of bounded bytes holds it. Long pre-tokens pass through and are not kept. A text's count is the
sum over its pre-tokens. Nothing is shuffled; the proven strings (at most the vocabulary) are broadcast.

Edge cases: null and empty texts have no bytes and no tokens; a space mark (U+2581) in a text is
a space, as in the library; control strings such as ``<s>`` in a text are ordinary text;
repeated rows get equal results; no rows give no rows. Models with other normalisation or with
user-defined symbols, and vocabularies without the two border properties, raise ValueError.
"""

from __future__ import annotations

import re

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskladder.llm.arrays import tidy

MARK = "▁"                # fixed value: the library's mark for a space
CACHE_BYTES = 64 << 20         # of a worker's counted pre-tokens; dropping them costs time only
LONGEST_KEPT = 64              # characters of a pre-token that is kept
_ENTRY = 120                   # bytes of an entry besides its characters
_PRETOKEN = re.compile(r"\n| +[^ \n]+| +|[^ \n]+")


def _model(path: str):
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    return m


def check_borders(pieces: list[str]) -> None:
    """Raises ValueError unless spaces and line feeds end every merge of this vocabulary."""
    for p in pieces:
        if re.search(f"[^{MARK}]{MARK}", p):
            raise ValueError(f"the piece {p!r} crosses a word border")
        if "\n" in p and len(p) > 1:
            raise ValueError(f"the piece {p!r} crosses a line border")


def prove_whole(path: str) -> frozenset[str]:
    """Vocabulary strings (a space for the mark) that are one token when they are a whole pre-token."""
    m = _model(path)
    n, t = m.normalizer_spec, m.trainer_spec
    if (t.model_type != t.BPE or n.precompiled_charsmap or n.normalization_rule_tsv or not n.add_dummy_prefix
            or n.remove_extra_whitespaces or not n.escape_whitespaces or t.treat_whitespace_as_suffix):
        raise ValueError("a BPE model without normalisation, with a leading space mark, is needed")
    kinds = m.SentencePiece
    if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in m.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    pieces = [p.piece for p in m.pieces if p.type == kinds.NORMAL]
    check_borders(pieces)
    texts = [p.replace(MARK, " ") for p in pieces if "\n" not in p]
    counts = Merger(path).count(texts)
    return frozenset(x for x, k in zip(texts, counts) if k == 1)


class Merger:
    """Counts tokens of single pre-tokens with the library."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.feed = len(self.sp.encode("\n"))      # the leading mark and the line feed

    def count(self, pretokens: list[str]) -> list[int]:
        """A pre-token that begins with a space gets it back as the library's leading mark; another one
        follows a line feed, which stands alone."""
        if not pretokens:
            return []
        texts = [p[1:] if p[0] == " " else p if p == "\n" else "\n" + p for p in pretokens]
        out = []
        for p, ids in zip(pretokens, self.sp.encode(texts, num_threads=1)):
            out.append(len(ids) if p[0] == " " and len(p) > 1 else 1 if p == " " else len(ids) - 1 if p == "\n" else len(ids) - self.feed)
        return out


def pretokens_of(text: str) -> list[str]:
    """Pre-tokens of a non-empty text, spaces first; line feeds stand alone."""
    text = " " + text.replace(MARK, " ")
    if "  " in text or "\0" in text:
        return _PRETOKEN.findall(text)
    return [x for x in text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0") if x]


class Counter:
    """Counts of pre-tokens: the proven strings, a bounded cache, and the merger for the rest."""

    def __init__(self, path: str, whole: frozenset[str]):
        self.merger, self.whole = Merger(path), dict.fromkeys(whole, 1)
        self.known, self.used, self.bound = dict(self.whole), 0, CACHE_BYTES

    def fill(self, pretokens: set[str]) -> None:
        new = list(pretokens.difference(self.known))
        size = sum(map(len, new)) + _ENTRY * len(new)
        if self.used + size > self.bound:          # entries in use stay
            kept = {p: self.known[p] for p in pretokens.intersection(self.known)}
            self.known = self.whole | kept
            self.used = sum(map(len, kept)) + _ENTRY * len(kept)
        self.known.update(zip(new, self.merger.count(new)))
        self.used += size

    def forget_long(self, pretokens: set[str]) -> None:
        for p in pretokens:
            if len(p) > LONGEST_KEPT and p in self.known and p not in self.whole:
                del self.known[p]
                self.used -= len(p) + _ENTRY


_LOADED: dict[str, Counter] = {}


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, text_col: str = "text", id_col: str = "doc_id",
                 cache_bytes: int = CACHE_BYTES, group_chars: int = 500_000) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``).
    ``group_chars`` characters of texts are counted at a time (one text is never cut)."""
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole(path))

    def groups(texts: list):
        a = used = 0
        for i, t in enumerate(texts):
            used += len(t or "")
            if used >= group_chars:
                yield a, i + 1
                a, used = i + 1, 0
        if a < len(texts):
            yield a, len(texts)

    def scan(batches):
        if path not in _LOADED:
            _LOADED[path] = Counter(path, whole.value)
        counter = _LOADED[path]
        counter.bound = cache_bytes
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in groups(texts):
                cut = [pretokens_of(t) if t else [] for t in texts[lo:hi]]
                distinct = set().union(*cut)
                counter.fill(distinct)
                n = [sum(map(counter.known.__getitem__, x)) for x in cut]
                counter.forget_long(distinct)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), b.column("n_bytes").slice(lo, hi - lo), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                      text.alias("text"))
    return src.mapInArrow(tidy(scan), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
