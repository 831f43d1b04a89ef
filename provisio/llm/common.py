"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.session import checkpoint_dir
from provisio.sources.tables import table_path


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


_scopes: list[list[tuple[SparkSession, str]]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared folder and read back: later steps read files
    that outlive any executor, and every reader sees the same rows."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    if _scopes:
        _scopes[-1].append((spark, path))
    return spark.read.parquet(path)


@contextmanager
def scratch():
    """Tables that are stored inside are removed at the end: what is needed beyond has to be stored by then outside of it."""
    _scopes.append([])
    try:
        yield
    finally:
        for spark, path in _scopes.pop():
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame | None) -> None:
    """Remove stored tables that nothing reads any more, and let the driver forget finished queries: Spark's cleaner
    removes the shuffle files of those then, which it else does when the driver happens to collect its garbage."""
    gone = [t for t in tables if t is not None]
    for df in gone:
        files = df.inputFiles()
        if files:
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(os.path.dirname(files[0]))
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
    gc.collect()
    if gone:
        gone[0].sparkSession._jvm.System.gc()


def stored_result(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``make`` returns, stored; all tables that it stores on its way are removed."""
    with scratch():
        df = make()
        inner = _scopes.pop()
        try:
            return stored(df, name)
        finally:
            _scopes.append(inner)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs, under fixed names; all others are left out."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def slices(batches: Iterable, chars: int = 2_000_000) -> Iterator[tuple[list, list]]:
    """(ids, texts) of Arrow batches of (id, text) in slices of about ``chars`` characters,
    so that a batch of long texts is never expanded at once."""
    for batch in batches:
        ids, text = batch.column(0).to_pylist(), batch.column(1)
        at = 0
        lengths = np.diff(np.frombuffer(text.buffers()[1], dtype=np.int32)[text.offset:text.offset + len(text) + 1]) \
            if str(text.type) == "string" and len(text) else np.zeros(len(text), np.int64) + 1000
        ends = np.cumsum(lengths)
        while at < len(ids):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chars, "right")))
            yield ids[at:stop], text.slice(at, stop - at).to_pylist()
            at = stop


def thinned(df: DataFrame, by: str, counts: dict, want: int, id_col: str = "doc_id") -> DataFrame:
    """Rows of each value of ``by`` whose id's hash is among the lowest: about twice ``want`` of ``counts[value]``.

    A bounded sample is then taken from these, so no task ever sorts or receives more."""
    if not counts:
        return df.where("false")
    share = F.create_map(*[F.lit(x) for v, n in counts.items() for x in (v, min(1.0, (2.0 * want + 100) / n))])
    return df.where(F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(1 << 30)) < share[F.col(by)] * float(1 << 30))
