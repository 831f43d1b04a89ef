"""Spelling variants among the words of a corpus (operator 11).

A run is a maximal run of letters (``[A-Za-z\\u00C0-\\u00FF]+``), with A-Z lower-cased.  Runs whose crc32 of ``<doc_id>:<run>``
31 divides lose one code point.  Words are the distinct results of at least 7 code points that occur at least twice.  Two
words are near if they differ by exactly one inserted, deleted or replaced code point.

1. Runs are counted by Spark's aggregates, partial in each task before the shuffle.
2. Two near words, the shorter of m code points, share their first m // 2 code points or, if not, their last
   m - m // 2.  Every word is dealt by those halves (for its own length and one less), so a group holds the words of two
   lengths that share one half.  Groups go to shards of bounded size; the words of a group over ``SHARD_WORDS`` are indexed in
   parts, and the whole group's words are searched in every part.
3. A shard builds a bidirectional FM-index over its delimited words: suffix ranks of the text and of the reversed text, and
   a wavelet matrix over each of their BWTs.  The exact half is matched from the middle outwards, and the synchronised
   intervals are then extended across the other half with one error, for all words at once.  What is left after
   the closing delimiter is one suffix rank, which is one word.
4. Counts and the commonest near word come together by word; forms are followed to roots by joins that double the
   way each time (a form occurs at least ten times as often, so there are few steps).

Each pair is found in exactly one group: by the first half where that is shared, else by the last, and in the group of its
shorter word's length.

Null and empty texts have no runs; a null id writes nothing before the colon.  Repeated rows count as often as they
occur.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm.common import stored, texts

MIN_LENGTH = 7
MIN_COUNT = 2
FORM_TIMES = 10
DELETE_EVERY = 31
SHARD_WORDS = 20_000
SEARCHED_AT_ONCE = 4_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame, delete_every: int = DELETE_EVERY) -> DataFrame:
    """(word, n): the words of the documents and how often each occurs."""
    # Results of MIN_LENGTH code points come from runs of as many at least.
    run = F.explode(F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(rf"([a-zÀ-ÿ]{{{MIN_LENGTH},}})"), 1))
    runs = texts(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), run.alias("run"))
    runs = runs.withColumn("h", F.crc32(F.concat_ws(":", "doc", "run").cast("binary")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = F.when(F.col("h") % delete_every == 0, cut).otherwise(F.col("run"))
    counted = runs.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def _dealt(known: DataFrame, shard_words: int) -> DataFrame:
    """(shard, key, m, first, word, n, indexed): each word in the groups of its halves, and the groups in shards."""
    size = F.length("word")
    group = [F.struct(m.alias("m"), F.lit(first).alias("first"),
                      (F.substring(F.col("word"), F.lit(1), F.floor(m / 2).cast("int")) if first
                       else F.substring(F.col("word"), size - m + F.floor(m / 2).cast("int") + 1, m)).alias("half"))
             for m in (size, size - 1) for first in (True, False)]
    own = known.select("word", "n", F.explode(F.array(*group)).alias("g")).where(F.col("g.m") >= MIN_LENGTH)
    own = own.select("word", "n", "g.m", "g.first", F.xxhash64("g.m", "g.first", "g.half").alias("key"))
    sizes = stored(own.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "spelling_groups")
    total, most = sizes.agg(F.sum("size"), F.max("size")).first()
    shards = max(1, -(-(total or 0) // shard_words))
    own = own.join(sizes, "key")
    if (most or 0) > shard_words:
        parts = F.ceil(F.col("size") / shard_words).cast("int")
        own = own.withColumn("mine", F.pmod(F.xxhash64("word"), parts)).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    else:
        own = own.withColumn("mine", F.lit(0)).withColumn("part", F.lit(0))
    return own.select(F.pmod(F.xxhash64("key", "part"), F.lit(shards)).alias("shard"), F.xxhash64("key", "part").alias("key"), "m", "first",
                      "word", "n", (F.col("mine") == F.col("part")).alias("indexed"))


class Ranks:
    """A wavelet matrix over a BWT: how often a symbol, and how often any smaller one, stands in a range."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.zeros, self.total = bits, [], []
        now = symbols
        for b in reversed(range(bits)):
            zero = (now >> b) & 1 == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            self.total.append(int(self.zeros[-1][-1]))
            now = np.concatenate([now[zero], now[~zero]])
        count = np.bincount(symbols, minlength=1 << bits)
        self.before = np.concatenate([[0], np.cumsum(count)[:-1]])           # symbols smaller than each, in the whole
        self.start = self._walk(np.arange(1 << bits), np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64))[0]

    def _walk(self, c, lo, hi):
        less = np.zeros(len(c), np.int64)
        for k, b in enumerate(reversed(range(self.bits))):
            l0, h0 = self.zeros[k][lo].astype(np.int64), self.zeros[k][hi].astype(np.int64)
            one = (c >> b) & 1 == 1
            less += np.where(one, h0 - l0, 0)
            lo = np.where(one, self.total[k] + lo - l0, l0)
            hi = np.where(one, self.total[k] + hi - h0, h0)
        return lo, hi, less

    def step(self, c: np.ndarray, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first rank, size, rows of smaller symbols) of the interval lo .. lo + size extended by the symbol c."""
        a, b, less = self._walk(c, lo, lo + size)
        return self.before[c] + a - self.start[c], b - a, less


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """The starts of the text's rotations in their order, by doubling the sorted length."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(np.diff(text[order]) != 0)])
    k = 1
    while k < n and rank.max() < n - 1:
        key = rank * (n + 1) + np.roll(rank, -k)
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        k *= 2
    return order


class BiIndex:
    """A bidirectional FM-index of different words of symbols from 1 to ``symbols``, each between delimiters (0), as one rotating text."""

    def __init__(self, codes: list[np.ndarray], symbols: int):
        text = np.concatenate([x for w in codes for x in (np.zeros(1, np.int64), w)])
        self.size = len(text)
        bits = symbols.bit_length()
        order = suffix_ranks(text)
        self.symbols = [text[order - 1]]
        word_of = np.cumsum(text == 0) - 1
        self.word_at = word_of[order]                      # the word that begins (with its delimiter) at each rank
        back = np.ascontiguousarray(text[::-1])
        self.symbols.append(back[suffix_ranks(back) - 1])
        self.ranks = [Ranks(s, bits) for s in self.symbols]   # 0 extends to the left, 1 to the right

    def whole(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank in the text, rank in the reversed text, size) of n empty patterns."""
        return np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.size, np.int64)

    def extend(self, right: int, c: np.ndarray, state: tuple) -> tuple:
        """The intervals of the patterns with one symbol more on their left (0) or right (1); both stay synchronised."""
        own, size, less = self.ranks[right].step(c, state[right], state[2])
        other = state[1 - right] + less
        return (other, own, size) if right else (own, other, size)

    def children(self, right: int, state: tuple) -> tuple[np.ndarray, np.ndarray, tuple]:
        """(number of the pattern, symbol, intervals) of every symbol that the patterns can be extended by.

        Equal patterns are looked at once, and different ones of one length do not overlap, so this reads each rank once a length."""
        lo, size = state[right], state[2]
        _, first, own = np.unique(lo * (self.size + 1) + size, return_index=True, return_inverse=True)
        width = size[first]
        at = np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width - lo[first], width)
        pairs = np.unique(np.repeat(np.arange(len(first)), width) << 8 | self.symbols[right][at])
        of, symbol = pairs >> 8, pairs & 255
        found = self.extend(right, symbol, tuple(x[first][of] for x in state))
        # every pattern takes its interval's children
        begin = np.searchsorted(of, np.arange(len(first)))
        count = np.searchsorted(of, np.arange(len(first)), "right") - begin
        n = count[own]
        pattern = np.repeat(np.arange(len(own)), n)
        child = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n - begin[own], n)
        return pattern, symbol[child], tuple(x[child] for x in found)


def _exact(index: BiIndex, right: int, rest: np.ndarray, row: np.ndarray, at: np.ndarray, state: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, word) of the patterns that can be extended by all of ``rest[row, at:]`` up to its delimiter."""
    rows, words_ = [], []
    while len(row):
        c = rest[row, at]
        state = index.extend(right, c, state)
        live = state[2] > 0
        done = live & (c == 0)
        rows.append(row[done])
        # a whole delimited word is one suffix; to the right its own delimiter comes first, to the left last
        words_.append(index.word_at[state[0][done]])
        go = live & (c != 0)
        row, at, state = row[go], at[go] + 1, tuple(x[go] for x in state)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *words_])


def _one_error(index: BiIndex, right: int, rest: np.ndarray, longer: np.ndarray, state: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(row, word): words that continue each row's matched half by its ``rest`` with exactly one error.

    A row that is the longer word of its group loses a symbol; the others have one replaced or get one more.  An
    inserted symbol differs from the one that it comes before, and a lost one from its next, so each word is found once."""
    found = []
    row = np.arange(len(rest))
    for k in range(rest.shape[1]):
        c = rest[row, k]
        if k + 1 < rest.shape[1]:
            lose = longer[row] & (c != 0) & (c != rest[row, min(k + 1, rest.shape[1] - 1)])
            found.append(_exact(index, right, rest, row[lose], np.full(int(lose.sum()), k + 1), tuple(x[lose] for x in state)))
        more = np.flatnonzero(~longer[row])
        if len(more):
            of, symbol, child = index.children(right, tuple(x[more] for x in state))
            of = more[of]
            other = (symbol != 0) & (symbol != c[of])
            of, child = of[other], tuple(x[other] for x in child)
            found.append(_exact(index, right, rest, row[of], np.full(len(of), k), child))               # one more
            swap = c[of] != 0
            found.append(_exact(index, right, rest, row[of][swap], np.full(int(swap.sum()), k + 1), tuple(x[swap] for x in child)))
        go = np.flatnonzero(c != 0)
        state = index.extend(right, c[go], tuple(x[go] for x in state))
        live = state[2] > 0
        row, state = row[go][live], tuple(x[live] for x in state)
        if not len(row):
            break
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def near_in_shard(word: list[str], key: np.ndarray, m: np.ndarray, first: np.ndarray, indexed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, row): each row of a shard and the indexed rows of its group whose words are near its own."""
    points = np.frombuffer("".join(word).encode("utf-32-le"), np.uint32)
    letters = np.unique(points)
    assert len(letters) < 255
    flat = np.searchsorted(letters, points).astype(np.int64) + 1
    size = np.array([len(w) for w in word], np.int64)
    start = np.cumsum(size) - size
    distinct, number = np.unique(np.array(word, dtype=object), return_inverse=True)
    in_index = np.unique(number[indexed])
    one_row = np.zeros(len(distinct), np.int64)
    one_row[number] = np.arange(len(word))
    if not len(in_index):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index = BiIndex([flat[start[r]:start[r] + size[r]] for r in one_row[in_index]], len(letters))
    codes = np.zeros((len(word), int(size.max()) + 1), np.int64)
    codes[np.repeat(np.arange(len(word)), size), np.arange(len(flat)) - np.repeat(start, size)] = flat

    # Members of a group in the index, to tell the words of this group from others that the shard happens to hold.
    groups, group = np.unique(key, return_inverse=True)
    place = np.full(len(distinct), -1)
    place[in_index] = np.arange(len(in_index))
    member = group[indexed] * len(in_index) + place[number[indexed]]
    by = np.argsort(member)
    member, member_row = member[by], np.flatnonzero(indexed)[by]

    rows, near = [], []
    half = m // 2
    for right in (1, 0):
        own = np.flatnonzero(first == bool(right))
        if not len(own):
            continue
        # The exact half, once per group, from the middle outwards: to the left up to the word's start if the first half is exact.
        _, head, of = np.unique(group[own], return_index=True, return_inverse=True)
        head = own[head]
        state = index.whole(len(head))
        length = half[head] if right else (m - half)[head]
        begin = length - 1 if right else size[head] - length
        live = np.arange(len(head))
        full = [x.copy() for x in state]
        for k in range(int(length.max()) + 1):
            go = k <= length[live]
            live, state = live[go], tuple(x[go] for x in state)
            at = begin[live] - k if right else begin[live] + k
            c = np.where(k == length[live], 0, codes[head[live], at])
            state = index.extend(1 - right, c, state)
            for x, y in zip(full, state):
                x[live] = y
        some = full[2][of] > 0
        own, of = own[some], of[some]
        # The other half in the order in which it is read, with its delimiter.
        left = np.where(right, half[own], size[own] - (m - half)[own])
        todo = size[own] - left if right else left
        for a in range(0, len(own), SEARCHED_AT_ONCE):
            part = slice(a, a + SEARCHED_AT_ONCE)
            r, n, t = own[part], left[part], todo[part]
            width = int(t.max()) + 1
            at = n[:, None] + np.arange(width) if right else n[:, None] - 1 - np.arange(width)
            rest = np.where(np.arange(width) < t[:, None], codes[r[:, None], np.clip(at, 0, codes.shape[1] - 1)], 0)
            got, found = _one_error(index, right, rest, size[r] > m[r], tuple(x[of[part]] for x in full))
            got = r[got]
            # only words of the same group, and by the last half only pairs that do not share the first
            want = group[got] * len(in_index) + found
            spot = np.minimum(np.searchsorted(member, want), max(0, len(member) - 1))
            ok = member[spot] == want
            got, other = got[ok], member_row[spot[ok]]
            if not right:
                width = int(half[got].max()) if len(got) else 0
                same = (codes[got, :width] == codes[other, :width]) | (np.arange(width) >= half[got][:, None])
                got, other = got[~same.all(axis=1)], other[~same.all(axis=1)]
            rows.append(got)
            near.append(other)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *near])


def near_words(known: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(word, n_near, best): how many words are near each word that has any, and the commonest of them with its count."""

    def search(t: pa.Table) -> pa.Table:
        word, n = t.column("word").to_pylist(), t.column("n").to_numpy()
        row, other = near_in_shard(word, *(t.column(c).to_numpy() for c in ("key", "m", "first", "indexed")))
        # By row, the commonest first; equal counts in code-point order.
        _, rank = np.unique(np.array(word, dtype=object), return_inverse=True)
        by = np.lexsort((rank[other], -n[other], row))
        row, other = row[by], other[by]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        count = np.diff(np.append(first, len(row)))
        return pa.table({"word": pa.array([word[i] for i in row[first].tolist()], pa.string()), "n_near": pa.array(count, pa.int64()),
                         "form_n": pa.array(n[other[first]], pa.int64()), "form": pa.array([word[i] for i in other[first].tolist()], pa.string())})

    found = _dealt(known, shard_words).groupBy("shard").applyInArrow(search, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: each step jumps over as many forms as all before it."""
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling_roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(on, "root", "left_semi").isEmpty():
            return now
        now = stored(now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "spelling_roots")


def variants(docs: DataFrame, shard_words: int = SHARD_WORDS, delete_every: int = DELETE_EVERY) -> DataFrame:
    """word, form, root, n, n_near, form_n of each word."""
    known = stored(words(docs, delete_every), "spelling_words")
    near = near_words(known, shard_words)
    found = known.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    is_form = F.col("form_n") >= FORM_TIMES * F.col("n")
    found = stored(found.withColumn("form", F.when(is_form, F.col("form"))).withColumn("form_n", F.when(is_form, F.col("form_n"))), "spelling_forms")
    return found.join(_roots(found.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
