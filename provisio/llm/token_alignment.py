"""Alignment of two tokenizers over the bytes of each text (operator 12).

Tokenizer A is byte-level BPE and reads a blank before the text; tokenizer B is sentencepiece BPE, which adds that
blank itself.  Both therefore tile the same bytes, and a text whose joined tokens of either differ from blank + text
has no tokens here.

1. Each slice of texts is tokenized once.  Tokens of both kinds are intervals of the slice's bytes; they are sorted
   by start (``lexsort``) and their ends accumulated to a running maximum.  A group breaks where a start reaches the
   maximum of all ends before it, which is where tokens of A and of B both end.  Inside a group the pairs of
   overlapping tokens are expanded from ranges.
2. A slice is stored as one row: what its documents have, its distinct id pairs with the number of its documents that
   hold each, and the documents' pairs as indices into these.  Texts are never read again.
3. Pair counts are summed over all slices and the highest per A id is found by Spark's aggregates.  An A id has at
   most as many pairs as B has ids, so no group is unbounded.  Each slice gets the counts of its own pairs back by
   joins, in bounded arrays, and adds them up by document.

Null and empty texts have zeros and an empty digest, and so do texts that either tokenizer does not give back byte by
byte.  Repeated rows and rows that share an id are documents of their own; ids are only carried and may be null.
Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm.common import slices, stored, texts
from provisio.llm.sketch import shrunk, unshrunk

SLICE_CHARS = 3_000_000
#: what is aligned at once: some thirty arrays of the size of its tokens are in memory
PART_CHARS = 300_000
B_BITS = 16
#: the fast encoder's regular expressions recurse over white space
_LONG_BLANK = re.compile(r"\s{1000}")
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_SLICE = ("slice long, ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "digests array<string>, pairs binary, holders binary, entries array<long>, at binary, times binary")


def _digits(n: int) -> np.ndarray:
    """Each id's decimal digits in bytes 1 to 7 of a little-endian integer; byte 0 is for what stands before it."""
    text = np.zeros((n, 8), np.uint8)
    for i in range(n):
        d = str(i).encode()
        text[i, 1:1 + len(d)] = np.frombuffer(d, np.uint8)
    return text.view("<u8").ravel()


class Tokens:
    """One tokenizer: the ids of texts, and the bytes of each id."""

    def __init__(self, of_id: list[bytes]):
        self.of_id = of_id
        self.size = np.array([len(b) for b in of_id], np.int64)
        self.digits = _digits(len(of_id))

    def joined(self, ids: list[int]) -> bytes:
        return b"".join([self.of_id[i] for i in ids])


class ByteLevel(Tokens):
    """A byte-level BPE file of ``tokenizers``, encoded by ``tiktoken`` with the same merges (several times faster).

    Token bytes are the entries of the file decoded from the byte-level alphabet, and an entry's id is its rank
    in the merges; a file of which that does not hold is read by ``tokenizers`` itself."""

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        from provisio.llm.word_bpe import _byte_of

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte, vocab = _byte_of(), dict(spec["model"]["vocab"])
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        of_id = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            of_id[i] = token.encode() if token in special else bytes(byte[c] for c in token)
        super().__init__(of_id)
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        ranks = {of_id[i]: i for token, i in vocab.items() if token not in special}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        in_order = all(vocab[a + b] == 256 + k for k, (a, b) in enumerate(merges))
        plain = spec["pre_tokenizer"].get("type") == "ByteLevel" and not spec["pre_tokenizer"].get("add_prefix_space") and not spec.get("normalizer")
        # fixed value: the pattern that the ByteLevel pre-tokenizer splits by
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        self.fast = tiktoken.Encoding("byte_level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}) if in_order and plain else None

    def ids(self, parts: list[str]) -> list[list[int]]:
        if self.fast:
            return [self._slow(p) if _LONG_BLANK.search(p) else self.fast.encode_ordinary(" " + p) for p in parts]
        return [self._slow(p) for p in parts]

    def _slow(self, part: str) -> list[int]:
        return self.slow.encode(" " + part, add_special_tokens=False).ids


class Pieces(Tokens):
    """A sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        of_id = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            of_id.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        super().__init__(of_id)

    def ids(self, parts: list[str]) -> list[list[int]]:
        return self.model.encode(parts, num_threads=1)


@lru_cache(maxsize=4)
def loaded(kind: type, path: str) -> Tokens:
    return kind(path)


def _packed(values: np.ndarray) -> bytes:
    return shrunk(values) if len(values) else b""


def _unpacked(raw: bytes, dtype) -> np.ndarray:
    return unshrunk(raw, dtype) if raw else np.zeros(0, dtype)


def _flat(ids: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.array(x, np.int64) for x in ids] or [np.zeros(0, np.int64)])


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values`` that ends before ``ends[i]``."""
    total = np.concatenate([[0], np.cumsum(values)])[ends]
    return np.diff(total, prepend=0)


def groups(start: np.ndarray, end: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """The number of each interval's group, in order of the bytes: coalesced overlapping intervals."""
    order = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[order])
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reach[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def align(a: Tokens, b: Tokens, parts: list[str | None]) -> dict:
    """What the texts of one slice have: counts and digests by text, and ``text``, ``pair`` of each link."""
    n = len(parts)
    out = {c: np.zeros(n, np.int64) for c in _COUNTS} | {"digests": [""] * n, "text": np.zeros(0, np.int64), "pair": np.zeros(0, np.int64)}
    full = [i for i, p in enumerate(parts) if p]
    ia, ib = a.ids([parts[i] for i in full]), b.ids([parts[i] for i in full])
    raw = [(" " + parts[i]).encode() for i in full]
    same = [k for k, r in enumerate(raw) if a.joined(ia[k]) == r and b.joined(ib[k]) == r]
    if not same:
        return out
    at = np.array([full[k] for k in same])
    ia, ib = [ia[k] for k in same], [ib[k] for k in same]
    a_ends, b_ends = np.cumsum([len(x) for x in ia]), np.cumsum([len(x) for x in ib])
    ids_a, ids_b = _flat(ia), _flat(ib)
    end_a, end_b = np.cumsum(a.size[ids_a]), np.cumsum(b.size[ids_b])
    start_a, start_b = end_a - a.size[ids_a], end_b - b.size[ids_b]

    kind = np.repeat(np.array([0, 1], np.int8), [len(ids_a), len(ids_b)])
    group = groups(np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b]), kind)
    first = np.searchsorted(end_b, start_a, "right")                    # the B tokens that each A token overlaps
    count = np.searchsorted(start_b, end_a, "left") - first
    of_b = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count - first, count)
    text_a = np.repeat(np.arange(len(same)), np.diff(a_ends, prepend=0))

    # The digest: by group, A before B, ids with what stands before each.
    key = group * 2 + kind
    order = np.argsort(key, kind="stable")
    k = key[order]
    before = np.full(len(k), ord(","), np.uint64)
    before[1:][k[1:] != k[:-1]] = np.where(k[1:][k[1:] != k[:-1]] & 1, ord("|"), ord(";")).astype(np.uint64)
    text_of = np.concatenate([text_a, np.repeat(np.arange(len(same)), np.diff(b_ends, prepend=0))])[order]
    before[np.flatnonzero(np.diff(text_of, prepend=-1))] = 0
    chars = (np.concatenate([a.digits[ids_a], b.digits[ids_b]])[order] | before).astype("<u8").view(np.uint8)
    some = chars != 0
    length = np.concatenate([[0], np.cumsum(some.reshape(-1, 8).sum(axis=1))])[np.cumsum(np.bincount(text_of, minlength=len(same)))]
    written = chars[some].tobytes()
    for i, lo, hi in zip(at.tolist(), [0, *length.tolist()], length.tolist()):
        out["digests"][i] = hashlib.sha256(written[lo:hi]).hexdigest()

    out["n_a"][at], out["n_b"][at] = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    out["n_links"][at] = _sums(count, a_ends)
    out["n_groups"][at] = _sums(np.diff(group[:len(ids_a)], prepend=-1) > 0, a_ends)
    out["text"] = at[np.repeat(text_a, count)]
    out["pair"] = (np.repeat(ids_a, count) << B_BITS) | ids_b[of_b]
    return out


def _parts(texts_: list[str | None], chars: int):
    """Runs (from, to) of texts of ``chars`` characters, or of one longer text."""
    lo = size = 0
    for i, text in enumerate(texts_):
        n = len(text or "")
        if i > lo and size + n > chars:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts_):
        yield lo, len(texts_)


def align_slice(a: Tokens, b: Tokens, texts_: list[str | None], chars: int = PART_CHARS) -> dict:
    """What the texts of a slice have, aligned part by part: counts and digests by text; each text's distinct pairs in order of
    text and pair (``own``: text in the high bits) and how often it has each (``times``)."""
    done = []
    for lo, hi in _parts(texts_, chars):
        found = align(a, b, texts_[lo:hi])
        own, times = np.unique(((found.pop("text") + lo) << 40) | found.pop("pair"), return_counts=True)
        done.append(found | {"own": own, "times": times.astype(np.uint32)})
    joined = {c: np.concatenate([d[c] for d in done] or [np.zeros(0, np.int64)]) for c in (*_COUNTS, "own", "times")}
    return joined | {"digests": [x for d in done for x in d["digests"]]}


def _sliced(docs: DataFrame, path_a: str, path_b: str, chars: int) -> DataFrame:
    """One row per slice of documents (see the module)."""

    def run(batches):
        from pyspark import TaskContext

        a, b = loaded(ByteLevel, path_a), loaded(Pieces, path_b)
        assert len(b.of_id) <= 1 << B_BITS
        number = TaskContext.get().partitionId() << 32
        for ids, parts in slices(batches, chars):
            found = align_slice(a, b, parts)
            own, times = found.pop("own"), found.pop("times")
            pairs, at, holders = np.unique(own & ((1 << 40) - 1), return_inverse=True, return_counts=True)
            entries = np.bincount(own >> 40, minlength=len(parts))
            row = [[number], [ids], *([found[c].tolist()] for c in _COUNTS), [found["digests"]],
                   [_packed(np.diff(pairs, prepend=0))], [_packed(holders.astype(np.uint32))], [entries.tolist()],
                   [_packed(at.astype(np.uint32))], [_packed(times.astype(np.uint32))]]
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), *[pa.binary()] * 2, pa.list_(pa.int64()), *[pa.binary()] * 2]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, kinds, strict=True)],
                                             names=[c.split()[0] for c in _SLICE.split(", ")])
            number += 1

    return stored(texts(docs).mapInArrow(run, _SLICE), "aligned")


def _pairs(sliced: DataFrame) -> DataFrame:
    """(slice, pair, holders): each slice's distinct pairs and how many of its documents hold them."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                pairs = np.cumsum(_unpacked(batch.column(1)[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pairs), batch.column(0)[i].as_py())), pa.array(pairs),
                     pa.array(_unpacked(batch.column(2)[i].as_py(), np.uint32).astype(np.int64))], names=["slice", "pair", "holders"])

    return sliced.select("slice", "pairs", "holders").mapInArrow(run, "slice long, pair long, holders long")


def pair_counts(sliced: DataFrame) -> DataFrame:
    """(pair, documents, best): in how many documents an id pair is linked, and whether that is its A id's highest."""
    counts = _pairs(sliced).groupBy("pair").agg(F.sum("holders").alias("documents"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", B_BITS)), "pair_counts")
    highest = counts.groupBy("a").agg(F.max("documents").alias("highest"))
    return counts.join(highest, "a").select("pair", "documents", (F.col("documents") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each document."""
    sliced = _sliced(docs, path_a, path_b, slice_chars)
    known = _pairs(sliced).select("slice", "pair").join(pair_counts(sliced), "pair")
    known = known.groupBy("slice").agg(F.collect_list(F.struct("pair", "documents", "best")).alias("known"))

    def add(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                entries = np.array(row["entries"].as_py(), np.int64)
                ends = np.cumsum(entries)
                best = total = np.zeros(len(ends), np.int64)
                if row["known"].is_valid:
                    # The slice's pairs are numbered in their order.
                    pair, documents, is_best = (row["known"].values.field(c).to_numpy(zero_copy_only=False) for c in ("pair", "documents", "best"))
                    order = np.argsort(pair)
                    at, times = _unpacked(row["at"].as_py(), np.uint32), _unpacked(row["times"].as_py(), np.uint32).astype(np.int64)
                    best = _sums(times * is_best[order][at], ends)
                    total = _sums(times * documents[order][at], ends)
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, *(row[c].values for c in _COUNTS), pa.array(best, pa.int64()), pa.array(total, pa.int64()), row["digests"].values],
                    names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    return (sliced.drop("pairs", "holders").join(known, "slice", "left")
            .mapInArrow(add, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
