"""Vectors in shards and queries in blocks, brought together pair by pair of blobs.

A shard holds a bounded number of vectors, a block a bounded number of queries. Blocks, the smaller ones, are sent to
every shard; an index is sent once to each of the tasks that share its shard. A pair is one row that carries both, so
a task's memory is bounded and every query meets every vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import batch as rows_of, checkpoint, grouped, pack, parts

SHARD, BLOCK = 16_384, 1_024


def vectors(table: DataFrame, id: str, vector: str, *, nonzero: bool) -> DataFrame:
    """(id, v) of the rows that take part: no null or non-finite component, a non-null id, and not all zero if asked.

    A repeated id keeps every row; the dimension is the commonest one, and rows of another take no part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    d = table.select(F.col(f"`{id}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null and size(v) > 0")
    d = d.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    if nonzero:
        d = d.where(F.exists("v", lambda x: x != 0))
    return d


def commonest_size(d: DataFrame) -> int:
    r = d.groupBy(F.size("v").alias("k")).count().orderBy(F.desc("count"), "k").first()
    return int(r[0]) if r else 0


def _packed(d: DataFrame, n: int, dim: int) -> DataFrame:
    """(part, blob): rows dealt out by a hash of the id in n parts, each one blob of ids and a matrix."""
    schema = pa.schema([("part", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for key, held in grouped(batches, "part"):
            t = pa.Table.from_batches(held)
            flat = t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            yield rows_of(schema, np.array([key], np.int32), [pack(t.column("id").to_numpy(), np.asarray(flat, np.float64))])

    dealt = d.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    return dealt.repartition(max(1, min(n, parts(d))), "part").sortWithinPartitions("part", "id").mapInArrow(run, "part int, blob binary")


def search(table: DataFrame, every: int, per_pair, k: int, *, id: str, vector: str, nonzero: bool, build=None, score: str = "double", shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, id, score): the k best of each row whose id is divisible by ``every``, ties to smaller ids.

    build(ids, matrix) makes a shard's index, kept as blob; per_pair(index blob, ids, matrix) returns
    (query position, ids, scores) arrays of k candidates a query at least, all if fewer. A query is no candidate
    of its own. Empty input: no rows."""
    d = vectors(table, id, vector, nonzero=nonzero)
    dim = commonest_size(d)
    d = d.where(F.size("v") == dim)
    asked = d.where(F.pmod("id", F.lit(every)) == 0)
    n, m = (r := d.agg(F.count(F.lit(1)), F.count_if(F.pmod("id", F.lit(every)) == 0)).first())[0], r[1]
    shards, blocks = max(1, -(-n // shard)), max(1, -(-m // block))
    index_schema = pa.schema([("part", pa.int32()), ("index", pa.binary())])

    def index(batches):
        for b in batches:
            for part, blob in zip(b.column("part").to_pylist(), b.column("blob").to_pylist()):
                count = int(np.frombuffer(blob, np.int64, 1, 8)[0]) // 8
                ids = np.frombuffer(blob, np.int64, count, 24)
                yield rows_of(index_schema, np.array([part], np.int32), [build(ids, np.frombuffer(blob, np.float64, count * dim, 24 + 8 * count).reshape(count, dim))])

    made = checkpoint(_packed(d, shards, dim).mapInArrow(index, "part int, index binary"))
    # few shards: their blocks are dealt to several tasks, each with the index
    tasks = parts(d)
    lanes = max(1, min(blocks, -(-tasks // shards)))
    index_of = made.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).repartition(tasks, "part", "lane")
    asking = _packed(asked, blocks, dim).select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("part"), F.pmod("part", F.lit(lanes)).alias("lane"), "blob").repartition(tasks, "part", "lane")
    pairs = index_of.join(asking, ["part", "lane"])
    out_schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64() if score == "long" else pa.float64())])

    def run(batches):
        for b in batches:
            for ix, blob in zip(b.column("index").to_pylist(), b.column("blob").to_pylist()):
                count = int(np.frombuffer(blob, np.int64, 1, 8)[0]) // 8
                ids = np.frombuffer(blob, np.int64, count, 24)
                q, found, s = per_pair(ix, ids, np.frombuffer(blob, np.float64, count * dim, 24 + 8 * count).reshape(count, dim))
                yield rows_of(out_schema, ids[q], found, s)

    found = pairs.select("index", "blob").mapInArrow(run, f"query_id long, id long, score {score}").where("query_id <> id")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id), "score")
