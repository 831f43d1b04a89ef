"""Quality rules with an n-gram language model (operator 13).

Words are what white space (space, and bytes 9 to 13) separates.  A document fails the base rules with fewer than 10
words, or when more than 20 of 100 words are in 5-word windows that occur twice or more in it.  The others are
judged by their perplexity under a modified Kneser-Ney model of the whole corpus.

The model's symbols are the UTF-8 bytes of a document's words joined by one blank, after a start of blanks, so its
alphabet is closed and an n-gram of ``ORDER`` bytes is a 64-bit number.

1. Each block of documents sends its distinct n-grams and their counts, sorted and packed, to the shards of a hash of the
   n-grams; a shard adds them up.  Counts cover every document, so what is gathered grows with the input.
2. Spark's aggregates derive the lower orders (how many different n-grams end in one), the context statistics
   and each order's three discounts.  Every n-gram gets one number: its probability with that very occurrence taken out of
   all counts (leaving one out), as each text is part of the corpus and a singleton would else predict itself.
3. A shard of the model is a sorted array of n-grams and one of log-probabilities.  It answers each block with the
   values of the block's own n-grams; the texts are read again and a block adds these up by document.  Nothing whole
   is broadcast or collected.
4. Of the documents that pass the base rules, the perplexities of each language (null is one too) are counted in bins of
   log2; a language's band reaches ``SPREAD`` distances from its median to its 5 % and 95 % quantiles on either side (at
   least ``LEAST_SPREAD`` bits).  Documents outside are rejected: unlike their language above, repetitive below.

Null, empty and blank texts have no words and fail the base rules; they have no perplexity.  Repeated rows count as often
as they occur and are judged alike; ids are only carried and may be null.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provisio.llm import sketch as sk
from provisio.llm import wordhash as wh
from provisio.llm.common import stored

ORDER = 5
MIN_WORDS = 10
WINDOW = 5
BLOCK_BYTES = 8_000_000
PIECE_BYTES = 2_000_000
SHARD_BYTES = 32_000_000
MERGE_GRAMS = 4_000_000
SCALE = 1500                    # steps of a bit in which log-probabilities are sent; 16 bits hold 43 bits
SPREAD = 4.0
LEAST_SPREAD = 0.5
BINS = 1000                      # of a bit of log2 perplexity
MAX_LANGUAGES = 100_000
_BLANK = wh.SPACED.word
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _grams(parts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram at every byte of the texts' words joined by blanks, first n-gram of each text and the end)."""
    joined = [b" ".join(p.split()) for p in parts]
    pad = b" " * (order - 1)
    b = np.frombuffer(b"".join(pad + j for j in joined), np.uint8).astype(np.uint64)
    sizes = np.array([len(j) for j in joined], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    if not first[-1]:
        return np.zeros(0, np.uint64), first
    whole = np.zeros(len(b) - order + 1, np.uint64)
    for k in range(order):
        whole = (whole << np.uint64(8)) | b[k:len(b) - order + 1 + k]
    # n-grams that begin in the last bytes of a text belong to the next one's start
    own = np.ones(len(whole), bool)
    ends = first[1:-1] + (order - 1) * np.arange(len(sizes) - 1)
    for k in range(order - 1):
        own[ends + k] = False
    return whole[own], first


def _shard(grams: np.ndarray, bits: int) -> np.ndarray:
    """The shard of each n-gram: the upper bits of its hash."""
    return (wh.mixed(grams.copy()) >> np.uint64(64 - bits)).astype(np.int64)


def _cuts(shard: np.ndarray) -> list[tuple[int, int]]:
    start = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    return list(zip(start, [*start[1:], len(shard)]))


def _distinct(parts: list[bytes | None], order: int, bits: int):
    """(a block's distinct n-grams by shard and value, their shards, their counts, and each piece's part of them:
    number of its first text, texts, n-grams of the piece, place of each position's n-gram in these, first position of each text)."""
    pieces = []
    for at, some in sk.pieces(parts, PIECE_BYTES):
        grams, first = _grams(some, order)
        own, where = np.unique(grams, return_inverse=True)
        pieces.append((at, some, own, where.astype(np.uint32), first))
    grams, where = np.unique(np.concatenate([p[2] for p in pieces] or [np.zeros(0, np.uint64)]), return_inverse=True)
    counts = np.concatenate([np.bincount(p[3], minlength=len(p[2])) for p in pieces] or [np.zeros(0)])
    counts = np.bincount(where, weights=counts, minlength=len(grams)).astype(np.int64)
    shard = _shard(grams, bits)
    by = np.lexsort((grams, shard))
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    at = np.split(place[where], np.cumsum([len(p[2]) for p in pieces])[:-1]) if pieces else []
    return grams[by], shard[by], counts[by], [(*p, k) for p, k in zip(pieces, at, strict=True)]


def _packed(sorted_: np.ndarray) -> bytes:
    return sk.shrunk(np.diff(sorted_, prepend=np.uint64(0)))


def _unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(sk.unshrunk(raw, np.uint64), dtype=np.uint64)


def _blocks(batches, block_bytes: int) -> Iterator[tuple]:
    """(block, check, ids, languages, texts) of the rows (id, language, text) of one task."""
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32

    def block(rows):
        check = 0
        for row in rows:
            check = zlib.crc32(repr(row[:2]).encode() + (row[2] or b""), check)
        return (number, check, *map(list, zip(*rows)))

    rows, held = [], 0
    for batch in batches:
        for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
            row = (*row[:2], row[2].as_py())
            if rows and held + len(row[2] or b"") > block_bytes:
                yield block(rows)
                number, rows, held = number + 1, [], 0
            rows.append(row)
            held += len(row[2] or b"")
    if rows:
        yield block(rows)


def _requests(docs: DataFrame, order: int, bits: int, block_bytes: int) -> DataFrame:
    """(block, check, shard, grams, counts): each block's n-grams by shard; stored, as counting and answering both read them."""

    def run(batches):
        for block, check, _, _, parts in _blocks(batches, block_bytes):
            grams, shard, n, _ = _distinct(parts, order, bits)
            cuts = _cuts(shard)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * len(cuts), pa.int64()), pa.array([check] * len(cuts), pa.int64()), pa.array([int(shard[a]) for a, _ in cuts], pa.int64()),
                 pa.array([_packed(grams[a:b]) for a, b in cuts], pa.binary()),
                 pa.array([sk.shrunk(n[a:b].astype(np.uint32)) for a, b in cuts], pa.binary())], names=["block", "check", "shard", "grams", "counts"])

    return stored(docs.mapInArrow(run, "block long, check long, shard long, grams binary, counts binary"), "ngram_requests")


def count_grams(requests: DataFrame) -> DataFrame:
    """(gram, c): every n-gram of the corpus and how often it occurs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts, held = [], [], 0

        def summed():
            own, at = np.unique(np.concatenate(grams), return_inverse=True)
            return [own], [np.bincount(at, weights=np.concatenate(counts), minlength=len(own)).astype(np.int64)]

        for t in batches:
            for i in range(t.num_rows):
                grams.append(_unpacked(t.column("grams")[i].as_py()))
                counts.append(sk.unshrunk(t.column("counts")[i].as_py(), np.uint32).astype(np.int64))
                held += len(grams[-1])
                if held > MERGE_GRAMS:
                    grams, counts = summed()
                    held = len(grams[0]) // 2   # the distinct ones stay; as many again may come before the next merge
        (own,), (n,) = summed()
        yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n)], names=["gram", "c"])

    return requests.select("shard", "grams", "counts").groupBy("shard").applyInArrow(add, "gram long, c long")


def _suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << 8 * order) - 1))


def _discounts(level: DataFrame) -> list[float]:
    """The three discounts of one order from its numbers of n-grams that occur once to four times (0.5, 1, 1.5 where these are missing)."""
    row = level.agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] or 0 for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    own = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(d, 0.0), float(k)) for k, d in enumerate(own, 1)]


def _level(grams: DataFrame, d: list[float]) -> DataFrame:
    """Each n-gram of one order with what its probability needs when one occurrence is (out = 1) or is not taken away."""
    c = F.col("c")
    contexts = grams.groupBy(F.shiftright("gram", 8).alias("context")).agg(
        F.sum("c").alias("total"), *[F.count_if(c == k).alias(f"o{k}") for k in (1, 2)], F.count_if(c >= 3).alias("o3"))
    own = grams.withColumn("context", F.shiftright("gram", 8)).join(contexts, "context")

    def discounted(n: Column) -> Column:
        return F.greatest(n - F.when(n <= 0, 0.0).when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2]), F.lit(0.0))

    held = F.lit(d[0]) * F.col("o1") + F.lit(d[1]) * F.col("o2") + F.lit(d[2]) * F.col("o3")
    step = F.when(c == 1, -d[0]).when(c == 2, d[0] - d[1]).when(c == 3, d[1] - d[2]).otherwise(0.0)  # of held, with one less
    rest = F.col("total") - 1
    return own.select("gram", "c", (discounted(c) / F.col("total")).alias("p0"), (held / F.col("total")).alias("g0"),
                      F.when(rest > 0, discounted(c - 1) / rest).otherwise(0.0).alias("p1"),
                      F.when(rest > 0, (held + step) / rest).otherwise(1.0).alias("g1"))


def model(grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, logp): log2 of the probability of each n-gram's last byte after the others, leaving that occurrence out.

    Where an n-gram occurs once, one n-gram less ends in its suffix, so one is taken from the lower order too, and so on."""
    grams = stored(grams, "ngrams")
    lower = F.lit(1.0 / 256)
    levels = []
    for k in range(order, 0, -1):
        levels.append(grams)
        if k > 1:
            grams = grams.groupBy(_suffix(F.col("gram"), k - 1).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
            grams = stored(grams, "ngrams")
    below = None
    for k, grams in enumerate(reversed(levels), 1):
        own = _level(grams, _discounts(grams))
        if below is None:
            q0 = F.col("p0") + F.col("g0") * lower
            q1 = F.col("p1") + F.col("g1") * lower
        else:
            # The two lowest orders have at most 256 and 65,536 n-grams.
            below = F.broadcast(below) if k <= 3 else below
            own = own.withColumn("suffix", _suffix(F.col("gram"), k - 1)).join(below, "suffix")
            q0 = F.col("p0") + F.col("g0") * F.col("b0")
            q1 = F.col("p1") + F.col("g1") * F.when(F.col("c") == 1, F.col("b1")).otherwise(F.col("b0"))
        if k == order:
            return own.select("gram", F.log2(F.greatest(q1, F.lit(1e-12))).cast("float").alias("logp"))
        below = own.select(F.col("gram").alias("suffix"), q0.alias("b0"), q1.alias("b1"))
        if k > 2:
            below = stored(below, "ngram_level")


def _answers(requests: DataFrame, scored: DataFrame, bits: int) -> DataFrame:
    """(block, check, answers): the log-probabilities of each block's n-grams, by shard."""

    def pack(batches):
        """The model's rows as sorted arrays by shard."""
        for t in batches:
            grams = t.column(0).to_numpy().view(np.uint64)
            shard = _shard(grams, bits)
            by = np.lexsort((grams, shard))
            grams, shard, logp = grams[by], shard[by], t.column(1).to_numpy()[by]
            cuts = _cuts(shard)
            yield pa.RecordBatch.from_arrays([pa.array([int(shard[a]) for a, _ in cuts], pa.int64()), pa.array([_packed(grams[a:b]) for a, b in cuts], pa.binary()),
                                              pa.array([sk.shrunk(logp[a:b]) for a, b in cuts], pa.binary())], names=["shard", "grams", "logp"])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        grams = np.concatenate([_unpacked(x.as_py()) for x in known.column("grams")])
        logp = np.concatenate([sk.unshrunk(x.as_py(), np.float32) for x in known.column("logp")])
        by = np.argsort(grams)
        grams, logp = grams[by], np.round(logp[by] * -SCALE).astype(np.uint16)
        found = [sk.shrunk(logp[np.searchsorted(grams, _unpacked(x.as_py()))]) for x in asked.column("grams")]
        return pa.table({"block": asked.column("block"), "check": asked.column("check"), "shard": asked.column("shard"), "values": pa.array(found, pa.binary())})

    parts = scored.mapInArrow(pack, "shard long, grams binary, logp binary")
    found = requests.select("block", "check", "shard", "grams").groupBy("shard").cogroup(parts.groupBy("shard")).applyInArrow(
        answer, "block long, check long, shard long, values binary")
    return found.groupBy("block").agg(F.min("check").alias("asked"), F.sort_array(F.collect_list(F.struct("shard", "values"))).alias("answers"))


def base_counts(parts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of the base rules, for some texts."""
    words = wh.split(parts, wh.SPACED)
    n = np.diff(words.first)
    size = np.array([len(p) + 1 for p in parts], np.int64)
    ends = np.cumsum(size) - 1
    b = words.raw
    of = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[np.concatenate([[0], ends])])
    chars = of(_BLANK[b] & ((b & 0xC0) != 0x80))
    symbols = of(_SYMBOLS[b])
    again = np.zeros(len(parts), np.int64)
    for i, p in enumerate(parts):
        if b"\n" in p:
            lines = [line for line in p.split(b"\n") if line and not line.isspace()]
            again[i] = len(lines) - len(set(lines))
    repeated = np.zeros(len(words.starts) + 1, np.int64)
    if len(words.starts) >= WINDOW:
        here = np.arange(len(words.starts) - WINDOW + 1)
        text = np.searchsorted(words.first, here, "right") - 1
        inside = words.first[text + 1] >= here + WINDOW
        here, text = here[inside], text[inside]
        h = wh.runs(wh.word_hashes(words, wh.SPACED), WINDOW)[here] ^ wh.mixed(text.astype(np.uint64) + np.uint64(1))
        _, at, count = np.unique(h, return_inverse=True, return_counts=True)
        start = here[count[at] > 1]
        np.add.at(repeated, start, 1)
        np.add.at(repeated, start + WINDOW, -1)
    covered = np.cumsum(repeated[:-1]) > 0
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": again,
            "n_repeat_words": np.diff(np.concatenate([[0], np.cumsum(covered)])[words.first])}


def scores(docs: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, lang, the counts of the base rules, and the perplexity of a byte (null without words).

    The documents are read twice and have to come in the same order within the same partitions, as files do; a table that
    is computed in another way should be stored first.  A block that differs is an error, not a wrong result."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    total = docs.select(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(6, int(total // SHARD_BYTES).bit_length())
    requests = _requests(docs, order, bits, block_bytes)
    answers = _answers(requests, model(count_grams(requests), order), bits)

    def send(batches):
        for block, check, ids, langs, parts in _blocks(batches, block_bytes):
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([ids], pa.list_(pa.int64())), pa.array([[-1 if p is None else len(p) for p in parts]], pa.list_(pa.int32())),
                 pa.array([sk.compress(b"".join(p for p in parts if p))], pa.binary()), pa.array([langs], pa.list_(pa.string())), pa.array([check], pa.int64())],
                names=["block", "ids", "sizes", "blob", "langs", "check"])

    def emit(batches):
        for block, ids, parts, langs, check, asked, found in sk.rows_of(batches, 4):
            if asked is not None and asked != check:
                raise RuntimeError("the documents came in another order than before: store them first")
            _, _, _, pieces = _distinct(parts, order, bits)
            logp = np.concatenate([sk.unshrunk(a["values"], np.uint16) for a in found or []] or [np.zeros(0)]).astype(np.int64)
            for at, some, _, where, first, place in pieces:
                value = logp[place][where] if len(where) else np.zeros(0, np.int64)
                n = np.diff(first)
                bits_each = np.diff(np.concatenate([[0], np.cumsum(value)])[first]) / SCALE / np.maximum(n, 1)
                got = base_counts(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at:at + len(some)], pa.int64()), pa.array(langs[at:at + len(some)], pa.string()),
                     *(pa.array(got[c].astype(np.int64)) for c in _COUNTS), pa.array(np.exp2(bits_each), mask=n == 0)],
                    names=["doc_id", "lang", *_COUNTS, "perplexity"])

    sent = docs.mapInArrow(send, "block long, ids array<long>, sizes array<int>, blob binary, langs array<string>, check long")
    kinds = ", ".join(f"{c} long" for c in _COUNTS)
    return (sent.join(answers, "block", "left").select("block", "ids", "sizes", "blob", "langs", "check", "asked", "answers")
            .mapInArrow(emit, f"doc_id long, lang string, {kinds}, perplexity double"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def bands(scored: DataFrame) -> DataFrame:
    """(band_lang, low, high): log2 perplexities of each language between which documents stay."""
    judged = scored.where(~base_failed() & F.col("perplexity").isNotNull())
    bins = judged.groupBy("lang", F.floor(F.log2("perplexity") * BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # A language has at most 40 bits of bins, however many documents there are.
    w = Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = bins.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    at = {q: F.min(F.when(F.col("upto") >= F.lit(q) * F.col("all"), F.col("bin"))) / BINS for q in (0.05, 0.5, 0.95)}
    found = counted.groupBy("lang").agg(*[at[q].alias(f"q{int(100 * q)}") for q in at])
    return found.select(F.col("lang").alias("band_lang"),
                        (F.col("q50") - F.greatest(F.lit(SPREAD) * (F.col("q50") - F.col("q5")), F.lit(LEAST_SPREAD))).alias("low"),
                        (F.col("q50") + F.greatest(F.lit(SPREAD) * (F.col("q95") - F.col("q50")), F.lit(LEAST_SPREAD))).alias("high"))


def quality(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, the counts, base_failed, perplexity, kept of each document."""
    scored = stored(scores(docs, order), "perplexities")
    found = stored(bands(scored), "bands")
    small = F.broadcast(found) if found.count() <= MAX_LANGUAGES else found
    bits = F.log2("perplexity")
    inside = (bits >= F.col("low")) & (bits <= F.col("high"))
    return (scored.join(small, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
            .select("doc_id", *_COUNTS, base_failed().alias("base_failed"), "perplexity",
                    (~base_failed() & F.coalesce(inside, F.lit(False))).alias("kept")))
