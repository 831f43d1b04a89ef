"""Benchmark decontamination (operator 1), in DataFrame functions only.

Words are runs of ASCII letters and digits and of any non-ASCII character, with A-Z
lower-cased.  A test item's windows are its runs of ``n`` consecutive words, or the whole
item if it is shorter.  The distinct windows, keyed by a hash of their words' hashes, are
broadcast; each document explodes its positions inside one generated stage, where a
position's window is hashed, probed and then verified word by word.  Only verified hits
leave that stage.

The broadcast set is bounded: it holds at most ``max_windows`` (window, item) pairs.  A
larger benchmark is split by hash into parts of that size, each probed in a pass of its
own, so the memory stays the same and no window is left out.

Null and empty texts have no words, in items and in documents.  Items and documents
that occur more than once, or under a null id, count as often as they occur (an item id
is listed once; null item ids cannot be listed and are ignored).  Empty tables give no hits, or
no rows.  Only the named columns are read; ``remove`` keeps every column of the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N = 10
MAX_WINDOWS = 1_000_000
#: fixed value: the word pattern, after and before lower-casing A-Z
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z only; ``lower`` does the same on pure ASCII and is much faster there."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(lowered(text), F.lit(WORD), 0), F.array().cast("array<string>"))


def _key(hashes: Column, at: Column | int, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(hashes, at + k if isinstance(at, int) else at + F.lit(k)) for k in range(n)])


def item_windows(items: DataFrame, n: int = N, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(size, window, item): the distinct windows of each item."""
    w = (items.select(F.col(id_col).alias("item"), words(F.col(text_col).cast("string")).alias("w"))
         .where(F.col("item").isNotNull() & (F.size("w") > 0))
         .withColumn("size", F.least(F.lit(n), F.size("w"))))
    starts = F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)
    return (w.select("item", "size", "w", F.explode(starts).alias("at"))
            .select("size", F.slice("w", F.col("at"), F.col("size")).alias("window"), "item").distinct())


def hits(docs: DataFrame, windows: DataFrame, max_windows: int = MAX_WINDOWS,
         id_col: str = "doc_id", text_col: str = "text", every: bool = False) -> DataFrame:
    """(id, text_key, spans, items) of every document with a verified hit.

    ``spans``: distinct (at, size) in word positions; ``items``: the distinct item ids.
    ``text_key`` tells rows apart that share an id.  With ``every``, documents without a hit are there too (arrays are
    empty), and ``n_words`` and ``n_rows`` (rows equal in id and text) of each, from the same scan."""
    windows = windows.withColumn("part_hash", F.xxhash64("window"))
    sizes = {r["size"]: r["pairs"] for r in windows.groupBy("size").agg(F.count(F.lit(1)).alias("pairs")).collect()}
    parts = max(1, -(-sum(sizes.values()) // max_windows))
    text = F.col(text_col).cast("string")
    split = (docs.select(F.col(id_col).alias("id"), text_key(text).alias("text_key"), words(text).alias("w"))
             .where(F.lit(every) | (F.size("w") >= (min(sizes) if sizes else 1)))
             .select("id", "text_key", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h")))
    # With ``every``, one place after the last word stands for the document itself; no window begins there.
    starts = F.concat("h", F.array(F.lit(0).cast("long"))) if every else F.col("h")
    at = split.select("id", "text_key", "w", "h", F.posexplode(starts).alias("at", "first"))
    itself = F.lit(every) & (F.col("at") == F.size("h"))
    keys = F.array(*[F.struct(F.lit(s).alias("size"),
                              F.when(F.col("at") + s <= F.size("h"), _key(F.col("h"), F.col("at"), s)).alias("key"))
                     for s in sorted(sizes)]) if sizes else F.array().cast("array<struct<size:int,key:bigint>>")
    if len(sizes) == 1:
        size = next(iter(sizes))
        whole = F.col("at") + size <= F.size("h")
        probes = at.where(whole | itself).withColumn("key", F.when(whole, _key(F.col("h"), F.col("at"), size)) if every else _key(F.col("h"), F.col("at"), size))
    else:
        own = F.array(F.struct(F.lit(0).alias("size"), F.lit(None).cast("long").alias("key")))
        probes = at.select("*", F.explode(F.when(itself, own).otherwise(keys) if every else keys).alias("probe")) \
            .select("id", "text_key", "w", "h", "at", F.col("probe.key").alias("key")).where(F.col("key").isNotNull() | itself)
    known = windows.groupBy("part_hash", "size", "window").agg(F.collect_set("item").alias("items"))
    hashed = known.withColumn("wh", F.transform("window", lambda x: F.xxhash64(x)))
    key = reduce(lambda c, s: F.when(F.col("size") == s, _key(F.col("wh"), 0, s)).otherwise(c), sorted(sizes), F.lit(None).cast("long"))
    known = hashed.select("part_hash", "size", "window", "items", key.alias("known_key"))
    same = reduce(lambda a, b: a & b, [
        (F.col("size") <= k) | (F.get("w", F.col("at") + k) == F.get("window", F.lit(k))) for k in range(max(sizes, default=1))])

    def probe(part: int) -> DataFrame:
        side = known.where(F.pmod("part_hash", F.lit(parts)) == part) if parts > 1 else known
        hit = (F.col("key") == F.col("known_key")) & same
        span = F.struct(F.col("at"), F.col("size")).alias("span")
        if not every or part:
            return probes.join(F.broadcast(side), hit).select("id", "text_key", span, "items", F.lit(None).cast("int").alias("n_words"))
        return (probes.join(F.broadcast(side), hit, "left").where(F.col("known_key").isNotNull() | itself)
                .select("id", "text_key", F.when(F.col("known_key").isNotNull(), span).alias("span"), "items", F.when(itself, F.size("w")).alias("n_words")))

    found = reduce(DataFrame.unionAll, [probe(p) for p in range(parts)])
    counts = [F.max("n_words").cast("long").alias("n_words"), F.count("n_words").alias("n_rows")] if every else []
    return found.groupBy("id", "text_key").agg(
        F.sort_array(F.collect_set("span")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"), *counts)


def text_key(text: Column) -> Column:
    return F.struct(F.coalesce(F.octet_length(text), F.lit(-1)).alias("n"), F.xxhash64(text).alias("x"))


def covered(spans: Column) -> Column:
    """How many positions the sorted spans cover together."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc: Column, x: Column) -> Column:
        stop = (x["at"] + x["size"]).cast("long")
        return F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), stop - F.greatest(x["at"].cast("long"), acc["end"]))).alias("n"),
                        F.greatest(stop, acc["end"]).alias("end"))

    return F.aggregate(spans, start, add, lambda acc: acc["n"])


def _matched(docs: DataFrame, items: DataFrame, n: int, max_windows: int, id_col: str, text_col: str) -> DataFrame:
    """The documents' columns as ``row``, beside ``spans`` and ``items`` (null without a hit)."""
    # The scan for every document splits a text once; one for hit documents only filters by its words and splits it again.
    found = hits(docs, item_windows(items, n), max_windows, id_col, text_col, every=True).where(F.size("spans") > 0)
    text = F.col(f"row.{text_col}").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col(f"row.{id_col}").alias("own_id"), text_key(text).alias("own_key"))
    return rows.join(found, rows.own_id.eqNullSafe(found.id) & (rows.own_key == found.text_key), "left")


def report(docs: DataFrame, items: DataFrame, n: int = N, max_windows: int = MAX_WINDOWS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, spans, items (arrays, empty without a hit), n_hit, contaminated."""
    found = hits(docs, item_windows(items, n), max_windows, id_col, text_col, every=True)
    rows = found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows")))).withColumn("n_hit", covered(F.col("spans")))
    return rows.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", "spans", (F.col("n_hit") > 0).alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, what: str = "documents", n: int = N, max_windows: int = MAX_WINDOWS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the hit ones (``documents``), or without the hit words and the
    separators after them (``spans``); same columns."""
    both = _matched(docs, items, n, max_windows, id_col, text_col)
    if what == "documents":
        return both.where("spans is null").select("row.*")
    text = F.col(f"row.{text_col}").cast("string")
    tokens = F.regexp_extract_all(text, F.lit(f"{WORD_ANY_CASE}+{NOT_WORD}*"), 0)
    gone = F.flatten(F.transform("spans", lambda x: F.sequence(x["at"], x["at"] + x["size"] - 1)))
    both = both.withColumn("tokens", F.when(F.col("spans").isNotNull(), tokens))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("tokens") - 1), gone), lambda i: F.get("tokens", i))
    kept = F.concat(F.regexp_extract(text, f"^{NOT_WORD}*", 0), F.array_join(left, ""))
    new = F.when(F.col("spans").isNull(), text).otherwise(kept)
    return both.select(*[new.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
