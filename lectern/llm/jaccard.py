"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows are documents, columns are hashed word shingles. The product of the matrix with its transpose holds
all overlaps; it is formed in blocks and most of it is proved empty from set sizes:

1. Columns are dealt out in blocks by ranges of the hash. A column in one row only adds nothing off the
   diagonal and goes.
2. A row of n shingles must overlap a partner in ceil(t * n) columns at least, so rows that keep fewer go;
   of the others, any partner shares one of the rarest ``kept - ceil(t * n) + 1`` kept columns.
3. Rows that share such a column fall in one row group (components, smallest label); a group is dealt out in row
   blocks by classes of size, of a bounded number of rows and shingles, and each pair of row blocks that sizes
   allow is one task. It accumulates overlap counts from the columns' posting lists, discards pairs below the
   size-derived bound, and returns a spanning forest of the links, never all pairs.
4. Components of those forests are the answer. Equal sets are one row of the matrix throughout.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import U64, batch as rows_of, checkpoint, grouped, mix, pack, parts, runs, salted, slices, texts, unpack, volume, tidy
from .components import components

BLOCK_BYTES = 12 << 20  # text whose shingles make one column block
ROW_BLOCK = 1024  # rows of a row block, fewer of long rows
ROW = 512  # shingles that a row weighs besides its own
SENT = 4 << 20  # bytes of rows that leave a worker at once
MET = 1 << 21  # posting entries looked at together


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's word shingles, end to end, and where each text's begin and end.

    Words are maximal runs of anything but ASCII white space, with A-Z lower-cased. A text of fewer than k
    words but at least one has one shingle, its whole word sequence."""
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts(column)))
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    offsets = offsets - offsets[0]
    code = np.array([xxhash.xxh3_64_intdigest(x) if x else 0 for x in flat.dictionary.cast(pa.binary()).to_pylist()] or [0], U64)
    real = np.array([bool(x) for x in flat.dictionary.to_pylist()] or [False])
    index = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    w = code[index] if len(index) else np.zeros(0, U64)
    if len(index) and not real.all():
        keep = real[index]
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        w = w[keep]
    count = np.diff(offsets)
    n = np.where(count >= k, count - k + 1, (count > 0).astype(np.int64))
    with np.errstate(over="ignore"):
        m = max(0, len(w) - k + 1)
        h = np.zeros(m, U64)
        for j in range(k):
            h = h * U64(0x9E3779B97F4A7C15) + w[j : j + m]
            h ^= h >> U64(29)
        h = mix(h)
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(bounds[-1], U64)
    for i in range(len(count)):
        a, c = offsets[i], count[i]
        if c >= k:
            s = h[a : a + c - k + 1]
            s.sort()
            out[bounds[i] : bounds[i + 1]] = s
        elif c:
            out[bounds[i]] = xxhash.xxh3_64_intdigest(w[a : a + c].tobytes(), seed=int(c))
    first = np.ones(len(out), bool)
    first[1:] = out[1:] != out[:-1]
    first[bounds[:-1][n > 0]] = True
    return out[first], np.concatenate([[0], np.cumsum(first)])[bounds]


def _six(h: np.ndarray) -> np.ndarray:
    """The low six bytes of hashes: beside the column block they tell a row's columns apart."""
    return np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :6]).ravel()


def _eight(b: np.ndarray, block: int) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = b.reshape(-1, 6)
    return out.view(U64).ravel() | U64(block) << U64(48)


def _incidence(k: int, blocks: int, buckets: int):
    """Stage 1: rows (key, blob): key >= 0 a column block, key < 0 facts about the rows of a bucket."""

    schema = pa.schema([("key", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text"):
                sets, at = shingle_sets(b.column("text"), k)
                n = np.diff(at)
                raw = b.column("id")
                ids = pc.fill_null(raw, 0).to_numpy(zero_copy_only=False).astype(np.int64)
                null = np.asarray(raw.is_null())
                digest = [xxhash.xxh3_128_digest(sets[x:y].tobytes()) for x, y in zip(at[:-1], at[1:])]
                uid = np.array([xxhash.xxh3_64_intdigest(d, seed=int(i) & (2**64 - 1)) ^ int(z) for d, i, z in zip(digest, ids, null)], U64)
                keys, blobs = [], []
                bucket = (uid % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                every = np.frombuffer(b"".join(digest), np.uint8).reshape(-1, 16)
                cut = runs(bucket[order])
                for x, y in zip(cut[:-1], cut[1:]):
                    o = order[x:y]
                    keys.append(-1 - int(bucket[o[0]]))
                    blobs.append(pack(uid[o], ids[o], null[o].astype(np.uint8), n[o].astype(np.int32), every[o]))
                block = ((sets >> U64(48)) * U64(blocks) >> U64(16)).astype(np.uint16)
                order = np.argsort(block, kind="stable")
                row = np.repeat(np.arange(len(n), dtype=np.int32), n)[order]
                cut = runs(block[order])
                for x, y in zip(cut[:-1], cut[1:]):
                    r = runs(row[x:y])
                    keys.append(int(block[order[x]]))
                    blobs.append(pack(uid[row[x + r[:-1]]], np.diff(r).astype(np.int32), _six(sets[order[x:y]])))
                yield rows_of(schema, np.array(keys, np.int32), blobs)

    return run


def _columns(buckets: int):
    """Stage 2: of each column block, the entries of columns with two rows or more, by row bucket."""
    schema = pa.schema([("key", pa.int32()), ("kind", pa.int8()), ("blob", pa.binary())])

    def run(batches):
        for key, held in grouped(batches, "key"):
            blobs = [x for b in held for x in b.column("blob").to_pylist()]
            if key < 0:
                for x in blobs:
                    yield rows_of(schema, np.array([-1 - key], np.int32), np.array([0], np.int8), [x])
                continue
            read = [unpack(x, U64, np.int32, np.uint8) for x in blobs]
            uid = np.concatenate([np.repeat(u, c) for u, c, _ in read])
            h = _eight(np.concatenate([x[2] for x in read]), key)
            del read, blobs
            order = np.argsort(h)
            cut = runs(h[order])
            df = np.repeat(np.diff(cut), np.diff(cut))
            order, df = order[df > 1], np.minimum(df[df > 1], 65_535).astype(np.uint16)
            uid, h = uid[order], h[order]
            bucket = (uid % U64(buckets)).astype(np.uint16)
            order = np.lexsort((uid, bucket))
            uid, h, df, bucket = uid[order], h[order], df[order], bucket[order]
            cut = runs(bucket)
            for x, y in zip(cut[:-1], cut[1:]):
                r = runs(uid[x:y])
                yield rows_of(schema, np.array([bucket[x]], np.int32), np.array([1], np.int8), [pack(uid[x + r[:-1]], np.diff(r).astype(np.int32), _six(h[x:y]), df[x:y], np.array([key], np.int32))])

    return run


def _rows(percent: int):
    """Stage 3: each row with its size and set digest; rows that can have a partner also with their kept columns."""
    schema = pa.schema([("id", pa.int64()), ("uid", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("kept", pa.binary()), ("prefix", pa.list_(pa.int64()))])

    def run(batches):
        for _, held in grouped(batches, "key"):
            kinds = [k for b in held for k in b.column("kind").to_pylist()]
            blobs = [x for b in held for x in b.column("blob").to_pylist()]
            facts = [unpack(x, U64, np.int64, np.uint8, np.int32, np.uint8) for k, x in zip(kinds, blobs) if k == 0]
            entries = [unpack(x, U64, np.int32, np.uint8, np.uint16, np.int32) for k, x in zip(kinds, blobs) if k == 1]
            del blobs
            uid, ids, null, n, digest = (np.concatenate([f[i] for f in facts]) for i in range(5))
            digest = digest.reshape(-1, 16)
            kept, prefix = {}, {}
            if entries:
                size = dict(zip(uid.tolist(), n.tolist()))
                u = np.concatenate([np.repeat(e[0], e[1]) for e in entries])
                h = np.concatenate([_eight(e[2], int(e[4][0])) for e in entries])
                df = np.concatenate([e[3] for e in entries])
                order = np.argsort(u, kind="stable")
                u, h, df = u[order], h[order], df[order]
                cut = runs(u)
                for x, y in zip(cut[:-1], cut[1:]):
                    who = int(u[x])
                    need = -(-percent * size[who] // 100)
                    if y - x < need:
                        continue
                    s, first = np.unique(h[x:y], return_index=True)  # rows given twice have entries twice
                    if len(s) < need:
                        continue
                    rare = np.lexsort((s, df[x:y][first]))[: len(s) - need + 1]
                    kept[who], prefix[who] = s.tobytes(), s[rare].view(np.int64)
            out_uid = uid.tolist()
            seen = set()  # a repeated row carries its columns once
            has = [w in kept and not (w in seen or seen.add(w)) for w in out_uid]
            sent = np.cumsum([100 + (len(kept[w]) + prefix[w].nbytes if o else 0) for w, o in zip(out_uid, has)])
            cut = np.unique(np.concatenate([[0], np.searchsorted(sent, np.arange(SENT, sent[-1], SENT)) + 1, [len(sent)]]))
            for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()):
                some, ok = out_uid[a:z], has[a:z]
                yield rows_of(
                    schema,
                    pa.array(ids[a:z], mask=null[a:z].astype(bool)),
                    uid[a:z].view(np.int64),
                    n[a:z].astype(np.int64),
                    [x.tobytes() for x in digest[a:z]],
                    [kept[w] if o else None for w, o in zip(some, ok)],
                    [prefix[w] if o else None for w, o in zip(some, ok)],
                )

    return run


def link_forest(uid: np.ndarray, sets: list[np.ndarray], n: np.ndarray, percent: int, left: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (a, b) that span the components of a row block, or of the links between two.

    left: marks the rows of the first block; then only pairs across are compared. Overlaps of one row with all
    others are accumulated from posting lists at once; pairs whose overlap is below
    percent/(100+percent) * (n_a + n_b) are discarded."""
    m = len(sets)
    if m < 2:
        return []
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    cut = runs(flat[order])
    column = np.empty(len(flat), np.int64)
    column[order] = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    posting, at = row[order], cut
    del flat, order
    parent = list(range(m))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out, start = [], np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    for i in range(m):
        if left is not None and not left[i]:
            continue
        c = column[start[i] : start[i + 1]]
        c = c[at[c + 1] - at[c] > 1]
        if not len(c):
            continue
        overlap = np.zeros(m, np.int64)
        for some in np.array_split(c, -(-int((at[c + 1] - at[c]).sum()) // MET)):
            size = at[some + 1] - at[some]
            where = np.repeat(at[some] - np.cumsum(size) + size, size) + np.arange(size.sum())
            overlap += np.bincount(posting[where], minlength=m)
        ok = (100 + percent) * overlap >= percent * (n[i] + n)
        if left is None:
            ok[: i + 1] = False
        else:
            ok &= ~left
        for j in np.flatnonzero(ok).tolist():
            x, y = top(i), top(j)
            if x != y:
                parent[y] = x
                out.append((int(uid[i]), int(uid[j])))
    return out


def _product(percent: int):
    """Stage 4: one task group is a row block with itself (part 0 only) or a pair of row blocks (parts 0 and 1)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        out = []
        for _, held in grouped(batches, "task"):
            t = pa.Table.from_batches(held)
            uid, n, side = (t.column(c).to_numpy() for c in ("uid", "n", "side"))
            sets = [np.frombuffer(x, U64) for x in t.column("kept").to_pylist()]
            out += link_forest(uid, sets, n, percent, side == 0 if side.any() else None)
            if len(out) > 20_000:
                yield rows_of(schema, [x for x, _ in out], [y for _, y in out])
                out = []
        yield rows_of(schema, [x for x, _ in out], [y for _, y in out])

    return run


def jaccard_components(docs: DataFrame, *, id: str = "doc_id", text: str = "text", k: int = 3, percent: int = 90, block_bytes: int = BLOCK_BYTES, row_block: int = ROW_BLOCK) -> DataFrame:
    """(id, n_shingles, component_id) of every row: its set's size and the smallest id that links reach.

    Two rows link when 100 * intersection >= percent * union of their word k-shingle sets. Rows without words
    have 0 shingles, link with nothing and are their own component. A null text is empty; a null id stays null
    and counts as the largest when a component is named; repeated rows come back as often as they came. Other
    columns are not read. An empty table gives no rows.
    """
    d = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    _, size = volume(d)
    blocks = int(min(60_000, max(4, -(-size // block_bytes))))
    p = parts(d)
    key = "key int, blob binary"
    one = d.mapInArrow(tidy(_incidence(k, blocks, blocks)), key).repartition(p, "key").sortWithinPartitions("key")
    two = one.mapInArrow(tidy(_columns(blocks)), "key int, kind byte, blob binary").repartition(p, "key").sortWithinPartitions("key")
    rows = checkpoint(two.mapInArrow(tidy(_rows(percent)), "id long, uid long, n long, digest binary, kept binary, prefix array<long>"))

    live = rows.where("kept is not null and n > 0")
    same = live.groupBy("digest").agg(F.min("uid").alias("rep"))
    rep = live.select("digest", "uid", "n", "prefix").join(same, "digest").where("uid = rep").select("uid", "n", F.explode("prefix").alias("s"))
    lead = rep.groupBy("s").agg(F.min("uid").alias("b"), F.count(F.lit(1)).alias("c")).where("c > 1").select("s", "b")
    groups = components(rep.join(lead, "s").select(F.col("uid").alias("a"), "b"))

    # row blocks of a group by classes of size, a class dealt out by hash; without an order over a whole group
    member = groups.join(live.select("uid", "n").distinct(), groups.node == F.col("uid")).select("uid", "n", "label", F.floor(F.log("n") / math.log(100 / percent)).cast("int").alias("size") if percent < 100 else F.col("n").cast("int").alias("size"))
    deal = member.groupBy("label", "size").agg(F.sum(F.col("n") + ROW).alias("weight")).select("label", "size", F.ceil(F.col("weight") / (row_block * 2 * ROW)).alias("parts"))
    member = salted(member, deal, ["label", "size"], "uid").withColumn("i", F.pmod(F.xxhash64("uid", F.lit("row block")), "parts")).drop("parts")
    blocks_of = member.groupBy("label", "size", "i").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count(F.lit(1)).alias("c"))
    x, y = blocks_of.withColumn("next", F.explode(F.array(*[F.col("size") + d for d in range(3)]))).alias("x"), blocks_of.alias("y")
    later = "(x.size < y.size or x.i < y.i)"
    pairs = x.join(y, F.expr(f"x.label = y.label and x.next = y.size and ({later} and 100 * x.hi >= {percent} * y.lo and 100 * y.hi >= {percent} * x.lo or x.size = y.size and x.i = y.i and x.c > 1)"))
    task = F.xxhash64("x.label", "x.size", "x.i", "y.size", "y.i")
    end = lambda b, side: F.struct(F.col(f"{b}.size").alias("size"), F.col(f"{b}.i").alias("i"), F.lit(side).alias("side"), task.alias("task"))
    sides = pairs.select(F.col("x.label").alias("label"), F.explode(F.when(F.expr(later), F.array(end("x", 0), end("y", 1))).otherwise(F.array(end("x", 0)))).alias("z")).select("label", "z.*")
    work = member.join(sides, ["label", "size", "i"]).select("uid", "task", "side").join(live.select("uid", "n", "kept"), "uid")
    forest = work.repartition(p, "task").sortWithinPartitions("task", "side", "uid").mapInArrow(tidy(_product(percent)), "a long, b long")

    # every row learns the smallest id of its component by its set's digest; rows of one digest are summed first
    label = components(forest).select(F.col("node").alias("rep"), "label")
    named = same.join(label, "rep", "left").select("digest", F.coalesce("label", "rep").alias("label"))
    named = named.join(rows.where("n > 0").groupBy("digest").agg(F.min("id").alias("id")), "digest")
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    named = salted(named.select("digest", "label"), least, ["label"], "digest").select("digest", "component_id", F.lit(True).alias("linked"))
    placed = salted(rows.select("id", "uid", "n", "digest"), named, ["digest"], "uid", how="left")
    return placed.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.when(F.col("linked") & (F.col("n") > 0), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
