"""Chat formatting as a prefix tree (operator 4).

A turn becomes ``<|turn|>`` role ``<|text|>`` text ``<|end|>``: three marker ids beyond the
tokenizer's vocabulary, and the ids of the escaped strings between them.  Control strings
(these markers and those of common chat templates) cannot appear inside a text: a
backslash is doubled, and one is put behind the first character of a control string.
``unescaped`` undoes both.

Conversations that begin with the same turns share those turns.  A turn's key is a chain of
digests from the first turn; turns that the same conversations pass through one after the
other are one node (a compressed prefix tree), so a long conversation that shares nothing is
a single node.  A node's path is the hashes along its ancestors; ordering all
nodes by path is the depth-first order of the whole forest, so a range partitioning and
per-partition sums give every node its place in the emitted token stream, however many
conversations share one first turn.  A node carries its ids once, its position ids start
after its ancestors' tokens, and its tokens may attend to the ancestors' intervals of the
stream (and to its own tokens so far).  ``read_back`` rebuilds conversations from that
output alone.

Turns are ordered by turn, role and text (null turns first), so ties and repeated rows have a
fixed order and are kept; null roles and texts are empty strings.  Rows with a null
conv_id are one conversation.  Empty tables give no rows; other columns are ignored.
A node's path and ancestors are as long as the branchings above it.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from provisio.llm.common import stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: fixed values: strings that steer chat templates
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|startoftext|>", "<|endoftext|>")
LEARNT_ROLE = "assistant"

_CONTROL = re.compile("(?=" + "|".join(map(re.escape, CONTROL)) + ")(.)", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escaped(text: str) -> str:
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


_codecs: dict = {}


def codec(path: str):
    """The byte-level encoder of a ``.tiktoken`` rank file, one per worker; markers follow its ids."""
    if path not in _codecs:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        first = max(ranks.values()) + 2  # the id after the last is often an end-of-text
        _codecs[path] = tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), first
    return _codecs[path]


def _ordered(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its turns in order and their chained node keys."""
    turns = conversations.select(
        "conv_id", F.struct("turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).alias("t"))
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    chain = F.aggregate("turns", F.array(F.lit("")), lambda acc, t: F.array_append(acc, F.md5(F.concat_ws(
        "\x1f", F.element_at(acc, -1), F.length(t["role"]).cast("string"), t["role"], t["text"]))))
    return own.select("conv_id", "turns", F.slice(chain, 2, F.size("turns")).alias("keys"))


def _segments(ordered: DataFrame) -> DataFrame:
    """conv_id, turns, keys and ``nodes``: (from, to, node) of the runs of turns that the same conversations pass."""
    passed = ordered.select("conv_id", F.posexplode("keys").alias("depth", "key"))
    shared = passed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Shared turns are the first ones of a conversation, so their numbers follow each other from 0.
    counts = passed.join(shared, "key").groupBy(F.col("conv_id").alias("id")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("depth", "n"))), lambda x: x["n"]).alias("counts"))
    both = ordered.join(counts, ordered.conv_id.eqNullSafe(counts.id), "left").drop("id")
    known = F.coalesce("counts", F.array().cast("array<bigint>"))
    n = F.concat(known, F.array_repeat(F.lit(1).cast("bigint"), F.size("turns") - F.size(known)))
    both = both.withColumn("n", n).withColumn("ends", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1), lambda i: (i == F.size("turns") - 1) | (F.get("n", i) != F.get("n", i + 1))))
    return both.select("conv_id", "turns", F.transform("ends", lambda e, k: F.struct(
        F.when(k == 0, 0).otherwise(F.get("ends", k - 1) + 1).alias("from"), e.alias("to"), F.get("keys", e).alias("node"))).alias("nodes"))


def tree(conversations: DataFrame, tokenizer_path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, conversations).

    nodes: node, parent, depth (its first turn), start, position, n_tokens, ids, loss and ancestors
    (arrays of start, length; loss counts from the node's first token).
    conversations: conv_id, n_turns, node (that of its last turn)."""
    ordered = stored(_ordered(conversations), "chat_turns")
    cut = stored(_segments(ordered), "chat_segments")
    whole = cut.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.element_at("nodes", -1)["node"].alias("node"))
    above = F.transform("nodes", lambda x: x["node"])
    each = cut.select("turns", above.alias("all"), F.posexplode("nodes").alias("k", "own"))
    nodes = each.select(
        F.col("own.node").alias("node"), F.get("all", F.col("k") - 1).alias("parent"), F.col("own.from").alias("depth"),
        F.transform(F.slice("all", F.lit(1), F.col("k") + 1), lambda x: F.xxhash64(x)).alias("path"), F.slice("all", F.lit(1), F.col("k")).alias("above"),
        F.slice("turns", F.col("own.from") + 1, F.col("own.to") - F.col("own.from") + 1).alias("turns")).dropDuplicates(["node"])

    def emit(batches):
        """Nodes in path order: their ids and the tokens before them in this task."""
        from pyspark import TaskContext

        enc, first = codec(tokenizer_path)
        task, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for turns in batch.column(5).to_pylist():
                ids, loss = [], []
                for t in turns:
                    ids += [first, *enc.encode_ordinary(escaped(t["role"])), first + 1]
                    text = enc.encode_ordinary(escaped(t["text"]))
                    if t["role"] == LEARNT_ROLE:
                        loss.append({"start": len(ids), "length": len(text)})
                    ids += [*text, first + 2]
                out.append((task, before, len(ids), ids, loss))
                before += len(ids)
            spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int32()), spans)
            cols = [pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1, 2, 4)), *cols],
                                             names=["node", "parent", "depth", "above", "task", "before", "n_tokens", "ids", "loss"])

    parts = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    emitted = stored(nodes.repartitionByRange(parts, "path").sortWithinPartitions("path").mapInArrow(
        emit, "node string, parent string, depth int, above array<string>, task int, before long, n_tokens long, "
              "ids array<int>, loss array<struct<start:bigint,length:bigint>>"), "chat_nodes")
    sums = emitted.groupBy("task").agg(F.sum("n_tokens").alias("n"))  # one row per partition of the range exchange
    first = sums.select("task", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)),
                                           F.lit(0)).alias("first"))
    placed = emitted.join(F.broadcast(first), "task").withColumn("start", F.col("first") + F.col("before")).drop("task", "first", "before")
    spans = placed.select(F.col("node").alias("up"), F.col("start").alias("up_start"), F.col("n_tokens").alias("up_n"))
    ancestors = (placed.select("node", F.explode("above").alias("up")).join(spans, "up")
                 .groupBy("node").agg(F.sum("up_n").alias("position"), F.sort_array(F.collect_list(
                     F.struct(F.col("up_start").alias("start"), F.col("up_n").alias("length")))).alias("ancestors")))
    out = placed.drop("above").join(ancestors, "node", "left")
    none = F.array().cast("array<struct<start:bigint,length:bigint>>")
    return out.select("node", "parent", "depth", "start", F.coalesce("position", F.lit(0)).alias("position"), "n_tokens", "ids",
                      "loss", F.coalesce("ancestors", none).alias("ancestors")), whole


def read_back(nodes: DataFrame, conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """conv_id, n_turns and, from ids, intervals and loss spans alone: turns_sha256, loss_chars,
    loss_sha256, formatted_chars.  Equal conversations are rebuilt once."""
    last = conversations.select("node").distinct().join(nodes, "node")
    spans = last.select("node", F.posexplode(F.concat("ancestors", F.array(F.struct("start", F.col("n_tokens").alias("length"))))).alias("k", "span"))
    pieces = nodes.select("start", "ids", "loss")
    whole = (spans.select("node", "k", F.col("span.start").alias("start")).join(pieces, "start")
             .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("k", "ids", "loss"))).alias("parts")))

    def digest(batches):
        enc, first = codec(tokenizer_path)
        for batch in batches:
            out = []
            for node, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                turns, loss, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0
                for p in parts:
                    ids = np.array(p["ids"], dtype=np.int64)
                    begins, splits, ends = (np.flatnonzero(ids == first + k).tolist() for k in range(3))
                    for begin, split, end in zip(begins, splits, ends, strict=True):
                        role, text = (enc.decode_bytes(ids[a:b].tolist()).decode("utf-8") for a, b in ((begin + 1, split), (split + 1, end)))
                        chars += len(TURN) + len(role) + len(TEXT) + len(text) + len(END)
                        turns.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
                    for span in p["loss"]:
                        learnt = unescaped(enc.decode_bytes(ids[span["start"]:span["start"] + span["length"]].tolist()).decode("utf-8"))
                        loss.update(learnt.encode())
                        loss_chars += len(learnt)
                out.append((node, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], k) for i, k in enumerate(kinds)],
                                             names=["node", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    digests = whole.mapInArrow(digest, "node string, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return conversations.join(digests, "node").select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
