"""N-gram Jaccard join as a grouped prefix join (operator 6).

A document's set is its distinct shingles of ``k`` words (A-Z lower-cased, words between
white space); a shorter text is one shingle.  Two documents link when their sets'
Jaccard similarity is at least ``percent`` / 100.

1. A count-min sketch of all documents' shingles (``sketch``) gives every shingle a
   size class.  Ordering shingles by (class, hash) is one global order, rare first.  Shingles of one
   document alone are in no intersection, so a document whose prefix (the first
   n - ceil(t n) + 1 shingles) holds nothing else links with nothing and is done.
2. Documents with equal sets become one; those with equal prefixes and sizes become one
   *group*.  Only groups are indexed by prefix shingles.
3. Group pairs that share a prefix shingle pass the length filter and the positional
   filter before their members are expanded and verified by exact intersection.

Since the result is components, links inside one component need not be found again.
So the first rounds only verify each document with the least member of its group, and
each group with the least group of its postings (as many pairs as documents, however
large a group of copies is); components are formed; then the same is done between
different components that share a posting; and at last every remaining pair of groups in different components
that passes the filters is expanded and verified.  No pair is skipped for its
number, so no link between components is lost.

Null and empty texts have empty sets and link with nothing.  Rows of equal text link with
each other; rows that share an id are one document of the result's components; a null
id is its own component unless its set equals another's.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from provisio.llm import sketch as sk
from provisio.llm import wordhash as wh
from provisio.llm.common import stored
from provisio.llm.components import components

SHINGLE = 5
PERCENT = 75
ROUNDS = 2


def shingle_sets(parts: list[bytes | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct shingles, as sorted hashes."""
    out: list[np.ndarray] = []
    for _, texts in sk.pieces(parts):
        words = wh.split(texts, wh.SPACED_LOWER)
        h = wh.word_hashes(words, wh.SPACED_LOWER)
        s = wh.runs(h, k)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if b - a >= k:
                out.append(np.unique(s[a:b - k + 1]))
            elif b > a:
                out.append(wh.runs(h[a:b], b - a) + np.uint64(b - a))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _sets(docs: DataFrame, percent: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """Every document: doc_id, n; and for those that may link: digest of the set, its shared
    shingles in the global order, how many of them are in the prefix, and the prefix's digest."""
    blocks = sk.pack(docs, id_col=id_col, text_col=text_col)
    bits = sk.cell_bits(blocks)

    def hashes(parts):
        return np.concatenate(shingle_sets(parts, k) or [np.zeros(0, np.uint64)])

    known = sk.estimates(blocks, hashes, bits)

    def rank(batches):
        for _, ids, parts, classes in sk.rows_of(batches, 1):
            sets = shingle_sets(parts, k)
            flat = np.concatenate(sets or [np.zeros(0, np.uint64)])
            size = sk.Estimate(flat, classes, bits).of(flat) if classes else np.zeros(len(flat), np.uint8)
            out, at = [], 0
            for doc, s in zip(ids, sets, strict=True):
                n, c = len(s), size[at:at + len(s)]
                at += n
                alone = int((c == 0).sum())
                prefix = n - -(-percent * n // 100) + 1 - alone
                if not n or prefix <= 0:
                    out.append((doc, n, None, None, None, None))
                    continue
                shared, order = s[c > 0], None
                order = np.lexsort((shared, c[c > 0]))
                shared = shared[order].view(np.int64)
                out.append((doc, n, hashlib.md5(s.tobytes()).digest(), shared, min(prefix, len(shared)),
                            hashlib.md5(shared[:prefix].tobytes() + n.to_bytes(8, "little")).digest()))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)],
                                             names=["doc_id", "n", "digest", "shared", "prefix", "like"])

    ranked = blocks.join(known, "block", "left").select("block", "ids", "sizes", "blob", "classes").mapInArrow(
        rank, "doc_id long, n long, digest binary, shared array<long>, prefix int, like binary")
    return stored(ranked, "shingles")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of set ids whose similarity is enough: 100 I >= percent (n1 + n2 - I)."""
    one = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    two = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(one, "a").join(two, "b")
            .where(both * F.lit(100 + percent) >= (F.col("na") + F.col("nb")) * percent).select("a", "b"))


def similar(docs: DataFrame, percent: int = PERCENT, k: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    every = _sets(docs, percent, k, id_col, text_col)
    # Equal sets: one row each, under the least id.
    first = every.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("id"))
    sets = stored(every.where("digest is not null").join(first, "digest")
                  .where(F.col("doc_id") == F.col("id")).dropDuplicates(["digest"])
                  .select("id", "n", "shared", "prefix", "like"), "sets")
    groups = sets.groupBy("like").agg(F.min("id").alias("grp"))
    members = stored(sets.join(groups, "like").select("id", "grp", "n"), "members")
    lead = sets.join(groups.select(F.col("grp").alias("id")), "id", "left_semi")  # each group's least member
    postings = stored(lead.select(F.col("id").alias("grp"), "n", F.size("shared").alias("width"),
                                  F.posexplode(F.slice("shared", F.lit(1), F.col("prefix"))).alias("at", "token")), "postings")
    # A shingle of one group alone proposes nothing.
    several = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    postings = stored(postings.join(several, "token"), "postings")
    fits = lambda x, y: ((F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent) & (F.col(f"{y}.n") * 100 >= F.col(f"{x}.n") * percent)
                         & (F.least(F.col(f"{x}.width") - F.col(f"{x}.at"), F.col(f"{y}.width") - F.col(f"{y}.at")) * (100 + percent)
                            >= (F.col(f"{x}.n") + F.col(f"{y}.n")) * percent))

    # Round 0: members with their group's least member, groups with the least group of a posting.
    least = postings.groupBy("token").agg(F.min("grp").alias("grp")).alias("l")
    pivots = postings.alias("p").join(least, "token").where("p.grp != l.grp") \
        .groupBy(F.col("p.grp").alias("a")).agg(F.min("l.grp").alias("b"))
    pairs = members.where("id != grp").select(F.col("id").alias("a"), F.col("grp").alias("b")).unionAll(pivots)
    links = stored(_verified(pairs, sets, percent), "links")
    ids = members.select("id", "grp", "n")

    def labelled(edges: DataFrame) -> DataFrame:
        return stored(ids.join(components(edges), "id", "left").select("id", "grp", "n", F.coalesce("component", "id").alias("component")), "labels")

    tried, own = pairs, labelled(links)
    for _ in range(ROUNDS):
        # Per posting, the least component and its least group there; the others' groups are tried with it.
        marked = postings.join(own.where("id = grp").select("grp", "component"), "grp")
        best = marked.groupBy("token").agg(F.min(F.struct("component", "grp")).alias("best"),
                                           F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
        proposed = (marked.join(best, "token").where("component != best.component")
                    .groupBy(F.col("grp").alias("a")).agg(F.min("best.grp").alias("b")))
        proposed = proposed.join(tried, ["a", "b"], "left_anti")
        fresh = stored(_verified(proposed, sets, percent), "links")
        if fresh.isEmpty():
            break
        links, tried = links.unionAll(fresh), tried.unionAll(fresh)
        own = labelled(links)

    # What is left: group pairs that pass the filters and have members in different components.
    span = own.groupBy("grp").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    marked = stored(postings.join(span, "grp"), "postings")
    # Only a posting that holds several components can hold a pair between them.
    mixed = marked.groupBy("token").agg(F.min("low").alias("l"), F.max("high").alias("h")).where("l != h").select("token")
    open_ = marked.join(mixed, "token")
    x, y = open_.alias("x"), open_.alias("y")
    apart = (F.col("x.low") != F.col("y.low")) | (F.col("x.low") != F.col("x.high")) | (F.col("y.low") != F.col("y.high"))
    across = (x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.grp") < F.col("y.grp")) & apart & fits("x", "y"))
              .select(F.col("x.grp").alias("g"), F.col("y.grp").alias("h")).distinct())
    inside = span.where("low != high").select(F.col("grp").alias("g"), F.col("grp").alias("h"))
    group_pairs = stored(across.unionAll(inside), "group_pairs")
    left = own.select(F.col("id").alias("a"), F.col("grp").alias("g"), F.col("component").alias("ca"))
    right = own.select(F.col("id").alias("b"), F.col("grp").alias("h"), F.col("component").alias("cb"))
    member_pairs = (group_pairs.join(left, "g").join(right, "h")
                    .where((F.col("ca") != F.col("cb")) & ((F.col("g") != F.col("h")) | (F.col("a") < F.col("b")))).select("a", "b"))
    fresh = stored(_verified(member_pairs, sets, percent), "links")
    if not fresh.isEmpty():
        own = labelled(links.unionAll(fresh))

    named = first.join(own.select("id", "component"), "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    rows = every.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    # Documents that link with nothing have no digest; they do not take part in the join.
    alone = rows.where("digest is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return alone.unionAll(rows.where("digest is not null").join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
