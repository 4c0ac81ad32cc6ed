"""What the operators of this subpackage share: reading tables, checkpoints, blobs and hashing."""

from __future__ import annotations

import ctypes
import re
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import reachable

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; columns it lacks come as nulls."""
    reachable(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in columns])


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the folder that all executors share.

    The session's ``spark.checkpoint.dir`` decides the folder. Where it is unset, one is made on one machine, as in
    tests; on a cluster that is an error, as no folder of one machine would outlive it."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="lectern-"))
    return df.checkpoint(eager=True)


def tidy(run):
    """A function for ``mapInArrow`` that gives its worker's free memory back to the system when it is through.

    Workers live on between tasks and stages; what one stage needed at its height would else stay theirs."""

    def through(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # another C library than glibc
            pass

    return through


def parts(df: DataFrame, least: int = 1) -> int:
    return max(least, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def volume(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """Rows and bytes of text: they set the number of blocks, so that a block is of bounded size."""
    r = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(column))), F.lit(0))).first()
    return int(r[0]), int(r[1])


def texts(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A string column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Consecutive slices of a batch that hold about ``limit`` bytes of a text column (one row at least)."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(size), 0
    while at < len(size):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, by elements."""
    x = x.astype(U64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U64(31)
        x *= U64(0x7FB5D329728EA185)
        x ^= x >> U64(27)
        x *= U64(0x81DADEF4BC2DD44D)
        x ^= x >> U64(33)
    return x


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one blob, each behind its length in bytes."""
    out = [np.array([len(arrays), *[a.nbytes for a in arrays]], np.int64).tobytes()]
    return b"".join([*out, *[np.ascontiguousarray(a).tobytes() for a in arrays]])


def unpack(blob: bytes, *kinds) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(blob, np.int64, n, 8), 8 * (n + 1), []
    for size, kind in zip(sizes, kinds, strict=True):
        kind = np.dtype(kind)
        out.append(np.frombuffer(blob, kind, int(size) // kind.itemsize, at))
        at += int(size)
    return out


def runs(keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def grouped(batches, key: str):
    """(key, list of record batches) for each run of equal keys over sorted batches.

    Holds one group at a time; groups are blocks of a bounded size."""
    held, now = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = runs(keys)
        for a, b in zip(cut[:-1], cut[1:]):
            if held and keys[a] != now:
                yield now, held
                held = []
            now = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield now, held


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """White-space tokens of texts: codes end to end, each text's bounds, and the strings of the codes."""
    words = pc.utf8_split_whitespace(texts(column))
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    return flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0], flat.dictionary.to_pylist()


def learnable(docs: DataFrame, id: str) -> DataFrame:
    """``held_out`` marks rows whose crc32 of the id as text is 1 modulo 3; null ids are neither held out nor learnt from."""
    r = F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % 3
    return docs.withColumn("held_out", F.coalesce(r == 1, F.lit(False))).withColumn("_learn", F.coalesce(r != 1, F.lit(False)))


def share(*columns: str, seed: str):
    """A fixed pseudo-random number from 0 to 1 of each row."""
    return (F.xxhash64(*columns, F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))


def salted(many: DataFrame, few: DataFrame, on: list[str], by: str, how: str = "inner", salts: int = 8) -> DataFrame:
    """``many`` joined with ``few``, which has a row a key; a key's rows of ``many`` are dealt to ``salts`` tasks by a hash of ``by``."""
    dealt = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return many.withColumn("_salt", F.pmod(F.xxhash64(by, F.lit("salt")), F.lit(salts)).cast("int")).join(dealt, [*on, "_salt"], how).drop("_salt")
