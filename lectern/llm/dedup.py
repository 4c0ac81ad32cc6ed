"""Removal of repeated byte strings by sharded suffix arrays.

A byte goes if a string of ``width`` bytes that covers it also starts in a document with a smaller id.
Windows of that width are dealt to shards by content: of each window the k-mer with the least hash, its
anchor, names the shard, so equal windows meet. Neighbouring windows share an anchor, so a row is a segment
of up to ``width - k + 1`` windows, sent as a hash. Then:

1. In a shard, a segment equal to one of a smaller document is removed whole, and of equal segments the
   smallest document's stand for all.
2. Anchors under which different segments of different documents remain fetch these segments' bytes, a few
   at the ends of each repeated passage.
3. Their suffixes are sorted with common prefixes by induced sorting, whole anchors at a time; runs of common
   prefixes of ``width`` or more tell each window's smallest document. An anchor with too many bytes for that has
   its windows sorted by leading symbols instead.
4. The removed spans meet the texts again. Both visits of the texts share one shuffle of compressed blobs.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import U64, batch as rows_of, grouped, mix, pack, parts, runs, slices, unpack, volume, tidy
from .induced import suffixes

WIDTH, K = 50, 16
BLOCK_BYTES = 12 << 20  # text whose anchors make one shard, and text of one bucket
CHUNK = (1 << 22) - 256  # bytes whose windows are looked at together
SORTED = 1 << 20  # bytes of segments whose suffixes are sorted at once
WHOLE = 4 << 20  # bytes of segments up to which one sort takes all their suffixes
WINDOWS = 1 << 18  # windows that are sorted at once where there are more bytes
ODD = 0x9E3779B97F4A7C15


def _text(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _fold(h: np.ndarray, size: int, other: np.ndarray, n: int) -> np.ndarray:
    """Hashes of strings of ``size`` bytes and of the strings behind them, as hashes of both together."""
    with np.errstate(over="ignore"):
        return h[:n] * U64(pow(ODD, size, 1 << 64)) + other[size : size + n]


def anchors(data: np.ndarray, width: int = WIDTH, k: int = K, valid: np.ndarray | None = None):
    """(anchor hash, segment hash, first window, windows, left mark, right mark) of the segments of a byte array.

    A window reaches half of its bytes besides the anchor beyond it on one side at least. The marks are 16-bit
    hashes of the anchor with so many bytes before and behind it, 0 if no window of the segment reaches as far:
    windows of two segments can only be equal if the segments agree in a mark.

    Which place of a window is its anchor follows from the window's bytes alone, so of several texts end to end
    the windows across two are just not ``valid``."""
    n = len(data) - width + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z.view(U64), z.view(U64), z, z, z.astype(np.uint16), z.astype(np.uint16)
    power = {1: mix(data.astype(U64) + U64(257))}
    size = 1
    while size * 2 <= width:
        h = power[size]
        power[size * 2] = _fold(h, size, h, len(h) - size)
        size *= 2

    def of(length):
        out, have = None, 0
        for p in sorted(power, reverse=True):
            if length & p:
                out = power[p] if out is None else _fold(out, have, power[p], len(data) - have - p + 1)
                have += p
        return out

    gram = mix(of(k))
    window = of(width)
    half = (width - k + 1) // 2
    wide = of(k + half)
    del power
    low = (gram & ~U64((1 << 22) - 1)) | np.arange(len(gram), dtype=U64)
    span, have = width - k + 1, 1
    while have * 2 <= span:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    if have < span:
        low = np.minimum(low[: n], low[span - have : span - have + n])
    at = (low[:n] & U64((1 << 22) - 1)).astype(np.int64)
    del low
    use = np.arange(n) if valid is None else np.flatnonzero(valid[:n])
    at = at[use]
    new = np.ones(len(use), bool)
    new[1:] = (at[1:] != at[:-1]) | (use[1:] != use[:-1] + 1)
    start = np.flatnonzero(new)
    first, last, place = use[start], use[np.append(start[1:], len(use)) - 1] if len(use) else use, at[start]
    with np.errstate(over="ignore"):
        segment = mix(mix(window[first]) * U64(ODD) + window[last] + (last - first).astype(U64) * U64(0xD1B54A32D192ED03) + (place - first).astype(U64))
    mark = lambda h: (mix(h) % U64(65_535)).astype(np.uint16) + np.uint16(1)
    left = np.where(place - first >= half, mark(wide[np.maximum(place - half, 0)]), 0).astype(np.uint16)
    right = np.where(place - last <= width - k - half, mark(wide[np.minimum(place, len(wide) - 1)]), 0).astype(np.uint16)
    return gram[place], segment, first, last - first + 1, left, right


def _of_documents(data: bytes, width: int, k: int):
    """The segments of one text: big texts in chunks that overlap by a window less a byte."""
    array = np.frombuffer(data, np.uint8)
    for a in range(0, max(1, len(array) - width + 1), CHUNK):
        gram, segment, first, *rest = anchors(array[a : a + CHUNK + width - 1], width, k)
        yield gram, segment, first + a, *rest


def _scan(blocks: int, width: int, k: int):
    """Phase 1: (block, blob) with the segments of a slice of texts that belong to a shard."""
    schema = pa.schema([("block", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for whole in batches:
            for b in slices(whole, "text", 2 << 20):
                ids, data = b.column("id").to_pylist(), _text(b.column("text"))
                use = [i for i, (w, d) in enumerate(zip(ids, data)) if w is not None and len(d) >= width]
                if not use:
                    continue
                if sum(len(data[i]) for i in use) <= CHUNK:  # all at once; segments must not cross texts
                    size = np.array([len(data[i]) for i in use])
                    end = np.cumsum(size)
                    joined = np.frombuffer(b"".join([data[i] for i in use]), np.uint8)
                    got = _together(joined, end - size, end, width, k)
                else:
                    got = [np.concatenate(x) for x in zip(*[(*some, np.full(len(some[0]), j)) for j, i in enumerate(use) for some in _of_documents(data[i], width, k)])]
                gram, segment, first, count, left, right, doc = got
                who = np.array([ids[i] for i in use], np.int64)
                check = np.array([zlib.crc32(data[i]) for i in use], np.uint32)
                # least hashes crowd at the low end, so the shard follows from them hashed again
                block = ((mix(gram) >> U64(48)) * U64(blocks) >> U64(16)).astype(np.uint16)
                order = np.argsort(block, kind="stable")
                gram, segment, first, count, left, right, doc, block = (x[order] for x in (gram, segment, first, count, left, right, doc, block))
                cut = runs(block)
                keys, blobs = [], []
                for x, y in zip(cut[:-1], cut[1:]):
                    r = runs(doc[x:y])
                    d = doc[x + r[:-1]]
                    keys.append(int(block[x]))
                    blobs.append(pack(who[d], check[d], np.diff(r).astype(np.uint32), gram[x:y].astype(np.uint32), segment[x:y], first[x:y].astype(np.uint32), count[x:y].astype(np.uint8), left[x:y], right[x:y]))
                yield rows_of(schema, np.array(keys, np.int32), blobs)

    return run


def _together(joined, start, end, width, k):
    """Segments of several texts laid end to end, each of ``width`` bytes at least or without segments."""
    edge = np.zeros(len(joined) + 1, np.int32)
    long = end - start >= width
    np.add.at(edge, start[long], 1)
    np.add.at(edge, end[long] - width + 1, -1)
    gram, segment, first, count, left, right = anchors(joined, width, k, np.cumsum(edge) > 0)
    doc = np.searchsorted(end, first, "right")
    return [gram, segment, first - start[doc], count, left, right, doc]


def _shard(buckets: int, width: int):
    """Phase 2: (bucket, kind, block, blob): kind 1, spans to remove; kind 2, segments whose bytes are wanted."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("block", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for key, held in grouped(batches, "block"):
            read = [unpack(x, np.int64, np.uint32, np.uint32, np.uint32, U64, np.uint32, np.uint8, np.uint16, np.uint16) for b in held for x in b.column("blob").to_pylist()]
            who = np.concatenate([np.repeat(r[0], r[2]) for r in read])
            check = np.concatenate([np.repeat(r[1], r[2]) for r in read])
            gram, segment, first, count, left, right = (np.concatenate([r[i] for r in read]) for i in range(3, 9))
            del read
            order = np.argsort(gram, kind="stable")
            cut = runs(gram[order])
            many = np.repeat(np.diff(cut) > 1, np.diff(cut))
            order = order[many]
            who, check, gram, segment, first, count, left, right = (x[order] for x in (who, check, gram, segment, first, count, left, right))
            order = np.lexsort((who, segment, gram))
            who, check, gram, segment, first, count, left, right = (x[order] for x in (who, check, gram, segment, first, count, left, right))
            if not len(who):
                continue
            pair = np.ones(len(who), bool)
            pair[1:] = (gram[1:] != gram[:-1]) | (segment[1:] != segment[:-1])
            starts = np.flatnonzero(pair)
            least = np.repeat(who[starts], np.diff(np.append(starts, len(who))))
            gone = who > least
            # of the rest, anchors with several segments and several documents
            group = runs(gram)
            size = np.diff(group)
            kinds = np.add.reduceat(pair.astype(np.int64), group[:-1])
            span = np.maximum.reduceat(who, group[:-1]) > np.minimum.reduceat(who, group[:-1])
            want = np.repeat((kinds > 1) & span, size) & ~gone
            want &= _agrees(gram, left, who) | _agrees(gram, right, who)
            for kind, m in ((1, gone), (2, want)):
                bucket = _bucket(who[m], buckets)
                o = np.lexsort((first[m], check[m], who[m], bucket))
                w, c, f, n, g, bucket = who[m][o], check[m][o], first[m][o], count[m][o], gram[m][o], bucket[o]
                cut = runs(bucket)
                for x, y in zip(cut[:-1], cut[1:]):
                    some = [w[x:y], c[x:y], f[x:y], f[x:y] + n[x:y].astype(np.uint32) + np.uint32(width - 1)]
                    if kind == 1:
                        some = _merged(*some)
                    yield rows_of(schema, np.array([bucket[x]], np.int32), np.array([kind], np.int8), np.array([key], np.int32), [pack(*some, *([g[x:y]] if kind == 2 else []))])

    return run


def _agrees(gram, mark, who):
    """Whether another document has the anchor with the same mark."""
    order = np.lexsort((mark, gram))
    g, m, w = gram[order], mark[order], who[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (m[1:] != m[:-1])
    at = np.flatnonzero(new)
    several = np.maximum.reduceat(w, at) > np.minimum.reduceat(w, at)
    out = np.empty(len(order), bool)
    out[order] = np.repeat(several, np.diff(np.append(at, len(order)))) & (m > 0)
    return out


def _merged(who, check, lo, hi):
    """Spans of a text, sorted by begin, joined where they touch or overlap."""
    if not len(who):
        return [who, check, lo, hi]
    text = np.zeros(len(who), np.int64)
    text[1:] = np.cumsum((who[1:] != who[:-1]) | (check[1:] != check[:-1]))
    far = np.maximum.accumulate(hi.astype(np.int64) + (text << 33))  # of this text and, lower, of those before
    new = np.ones(len(who), bool)
    new[1:] = lo[1:].astype(np.int64) + (text[1:] << 33) > far[:-1]
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(who)) - 1
    return [who[at], check[at], lo[at], (far[end] - (text[end] << 33)).astype(np.uint32)]


def _bucket(who: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(who.view(U64)) % U64(buckets)).astype(np.int32)


def _texts(buckets: int, carry: tuple[str, ...]):
    """Texts by bucket, compressed, and the rows' other columns as they are."""
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for b in slices(whole, "text", 16 << 20):
                raw = b.column("id")
                null = np.array([x is None for x in raw.to_pylist()], bool)
                who = np.array([x or 0 for x in raw.to_pylist()], np.int64)
                data = _text(b.column("text"))
                bucket = _bucket(who, buckets)
                order = np.argsort(bucket, kind="stable")
                cut = runs(bucket[order])
                for x, y in zip(cut[:-1], cut[1:]):
                    o = order[x:y]
                    joined = b"".join([data[i] for i in o])
                    yield rows_of(schema, np.array([bucket[o[0]]], np.int32), [pack(who[o], null[o].astype(np.uint8), np.array([len(data[i]) for i in o], np.int64), np.frombuffer(squeeze.compress(joined), np.uint8), _columns(b, carry, o))])

    return run


def _columns(b: pa.RecordBatch, carry: tuple[str, ...], rows: np.ndarray) -> np.ndarray:
    if not carry:
        return np.zeros(0, np.uint8)
    some, sink = b.select(list(carry)).take(pa.array(rows)), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, some.schema) as out:
        out.write_batch(some)
    return np.frombuffer(squeezed(sink.getvalue().to_pybytes()), np.uint8)


def squeezed(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def _carried(table: pa.Table) -> pa.Table:
    """The other columns of a bucket's rows, in the order of ``_open``."""
    read = []
    for blob in table.column("blob").to_pylist():
        packed = unpack(blob, np.int64, np.uint8, np.int64, np.uint8, np.uint8)[4].tobytes()
        read.append(pa.ipc.open_stream(zstandard.decompress(packed)).read_all())
    return pa.concat_tables(read)


def _open(table: pa.Table):
    """(id, is null, bytes) of a bucket's texts, blob by blob."""
    loose = zstandard.ZstdDecompressor()
    for blob in table.column("blob").to_pylist():
        who, null, size, packed, _ = unpack(blob, np.int64, np.uint8, np.int64, np.uint8, np.uint8)
        data, at = loose.decompress(packed.tobytes(), max_output_size=int(size.sum())) if size.sum() else b"", 0
        for w, z, n in zip(who.tolist(), null.tolist(), size.tolist()):
            yield w, bool(z), data[at : at + n]
            at += n


def _fetch(left: pa.Table, right: pa.Table) -> pa.Table:
    """Phase 3: (block, blob) with the bytes of the wanted segments of a bucket, by shard; spans, under a negative
    block that names their bucket, pass through."""
    want: dict[tuple[int, int], list] = {}
    passed = []
    for bucket, kind, block, blob in zip(*[right.column(c).to_pylist() for c in ("bucket", "kind", "block", "blob")]):
        if kind == 1:
            passed.append((-1 - bucket, blob))
            continue
        who, check, lo, hi, gram = unpack(blob, np.int64, np.uint32, np.uint32, np.uint32, np.uint32)
        cut = runs(who.astype(np.int64) * 3 + check)
        for x, y in zip(cut[:-1], cut[1:]):
            want.setdefault((int(who[x]), int(check[x])), []).append((block, lo[x:y], hi[x:y], gram[x:y]))
    out: dict[int, list] = {}
    for w, null, data in _open(left) if want else ():
        if null:
            continue
        key = w, zlib.crc32(data)
        for block, lo, hi, gram in want.pop(key, ()):  # a repeated row is fetched once
            o = out.setdefault(block, [[], [], [], [], [], []])
            o[0].append(np.full(len(lo), w)), o[1].append(np.full(len(lo), key[1], np.uint32)), o[2].append(lo), o[3].append(hi), o[4].append(gram)
            o[5] += [data[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
    blobs = [pack(*[np.concatenate(x) for x in o[:5]], np.frombuffer(zstandard.compress(b"".join(o[5]), 1), np.uint8)) for o in out.values()]
    return pa.table({"block": pa.array([*out, *[b for b, _ in passed]], pa.int32()), "blob": pa.array([*blobs, *[x for _, x in passed]], pa.binary())})


def repeated(who: np.ndarray, segments: list[bytes], width: int) -> list[tuple[int, int, int]]:
    """(segment, first, last window) of the windows that also start in a segment of a smaller document.

    Sorts all suffixes of the segments, which zeros keep apart; over ``WHOLE`` bytes, the windows by leading symbols."""
    size = np.array([len(x) for x in segments], np.int64)
    start = np.cumsum(size + 1) - size - 1
    if int(size.sum()) > WHOLE:
        return _spans(_by_symbols(who, segments, start, size, width), start)
    text = np.zeros(int((size + 1).sum()), np.int16)
    flat = np.frombuffer(b"".join(segments), np.uint8)
    where = np.arange(len(flat)) + np.repeat(np.arange(len(size)), size)
    text[where] = flat.astype(np.int16) + 1
    owner = np.repeat(np.arange(len(size)), size + 1)
    hit = np.zeros(len(text), bool)

    def settle(p, e):
        """One stretch of suffixes, whole groups of equal windows."""
        seg = owner[p]
        room = start[seg] + size[seg] - p >= width
        group = np.flatnonzero(np.append(True, e[1:] < width))
        doc = np.where(room, who[seg], np.iinfo(np.int64).max)
        least = np.minimum.reduceat(doc, group)
        least = np.repeat(least, np.diff(np.append(group, len(p))))
        hit[p[room & (doc > least)]] = True

    held: list = []
    for p, e in suffixes(text, width):
        cut = np.flatnonzero(e < width)
        if not len(cut):
            held.append((p, e))
            continue
        a, b = cut[0], cut[-1]
        held.append((p[:a], e[:a]))
        q, f = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
        if len(q):
            settle(q, f)
        if b > a:
            settle(p[a:b], e[a:b])
        held = [(p[b:], e[b:])]
    if held:
        settle(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
    return _spans(hit, start)


def _by_symbols(who: np.ndarray, segments: list[bytes], start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """Which places of the segments, end to end with one byte between, start a window of a smaller document too.

    Windows of one leading symbol are looked at together, and split by further symbols while they are more than
    ``WINDOWS``; a part is sorted by all that is left of its windows. Besides the bytes and two flags each, only the
    places of one leading symbol are held."""
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    edge = np.zeros(len(text) + 1, np.int8)
    long = size >= width
    edge[start[long]] = 1
    edge[(start + size - width + 1)[long]] -= 1
    room = np.cumsum(edge[:-1], dtype=np.int8).view(bool)
    hit = np.zeros(len(text), bool)
    for c in range(256):
        todo = [(np.flatnonzero(room & (text == c)), 1)]
        while todo:
            at, d = todo.pop()
            if len(at) < 2:
                continue
            if len(at) > WINDOWS and d < width:
                at = at[np.argsort(text[at + d], kind="stable")]
                cut = runs(text[at + d])
                todo += [(at[a:b].copy(), d + 1) for a, b in zip(cut[:-1], cut[1:])]
                continue
            doc = who[np.searchsorted(start, at, "right") - 1]
            first = np.zeros(1, np.int64)
            if d < width:
                rest = np.zeros((len(at), -(-(width - d) // 8) * 8), np.uint8)
                for k in range(d, width):
                    rest[:, k - d] = text[at + k]
                keys = rest.view(">u8").astype(np.uint64)
                order = np.lexsort(keys.T[::-1])
                at, doc, keys = at[order], doc[order], keys[order]
                first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
            least = np.repeat(np.minimum.reduceat(doc, first), np.diff(np.append(first, len(at))))
            hit[at[doc > least]] = True
    return hit


def _spans(hit: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
    """(segment, first, last window) of runs of places."""
    at = np.flatnonzero(hit)
    if not len(at):
        return []
    cut = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1] + 1) + 1, [len(at)]])
    first, last = at[cut[:-1]], at[cut[1:] - 1]
    seg = np.searchsorted(start, first, "right") - 1
    return list(zip(seg.tolist(), (first - start[seg]).tolist(), (last - start[seg]).tolist()))


def _sorted(buckets: int, width: int):
    """Phase 4: (bucket, kind 1, blob) with the spans that a shard's suffix order shows to be repeated."""
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("block", pa.int32()), ("blob", pa.binary())])

    def run(batches):
        for key, held in grouped(batches, "block"):
            blobs = [x for b in held for x in b.column("blob").to_pylist()]
            if key < 0:
                for x in blobs:
                    yield rows_of(schema, np.array([-1 - key], np.int32), np.array([1], np.int8), np.array([key], np.int32), [x])
                continue
            read = [unpack(x, np.int64, np.uint32, np.uint32, np.uint32, np.uint32, np.uint8) for x in blobs]
            who, check, lo, hi, gram = (np.concatenate([r[i] for r in read]) for i in range(5))
            segments = []
            for r in read:
                data, at = zstandard.decompress(r[5].tobytes(), max_output_size=int((r[3].astype(np.int64) - r[2]).sum())), 0
                for n in (r[3].astype(np.int64) - r[2]).tolist():
                    segments.append(data[at : at + n])
                    at += n
            # equal windows have equal anchors, so whole anchors are sorted together, about SORTED bytes at a time
            order = np.argsort(gram, kind="stable")
            cut = runs(gram[order])
            size = np.add.reduceat((hi.astype(np.int64) - lo)[order], cut[:-1])
            found, at, held_bytes = [], 0, 0
            for j in range(len(size)):
                held_bytes += size[j]
                if held_bytes >= SORTED or j == len(size) - 1:
                    some = order[cut[at] : cut[j + 1]]
                    found += [(some[q], a, b) for q, a, b in repeated(who[some], [segments[i] for i in some.tolist()], width)]
                    at, held_bytes = j + 1, 0
            if not found:
                continue
            seg, a, b = (np.array(x, np.int64) for x in zip(*found))
            w, c, f, t = who[seg], check[seg], lo[seg] + a.astype(np.uint32), lo[seg] + (b + width).astype(np.uint32)
            bucket = _bucket(w, buckets)
            o = np.lexsort((f, c, w, bucket))
            w, c, f, t, bucket = w[o], c[o], f[o], t[o], bucket[o]
            cut = runs(bucket)
            for x, y in zip(cut[:-1], cut[1:]):
                yield rows_of(schema, np.array([bucket[x]], np.int32), np.array([1], np.int8), np.array([key], np.int32), [pack(*_merged(w[x:y], c[x:y], f[x:y], t[x:y]))])

    return run


RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string"


def _finish(keep: bool, carry: dict[str, pa.DataType]):
    """Phase 5: a bucket's texts without its spans."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        spans: dict[tuple[int, int], list] = {}
        for blob in right.column("blob").to_pylist():
            who, check, lo, hi = unpack(blob, np.int64, np.uint32, np.uint32, np.uint32)
            for w, c, a, b in zip(who.tolist(), check.tolist(), lo.tolist(), hi.tolist()):
                spans.setdefault((w, c), []).append((a, b))
        out = [[] for _ in range(7)]
        for w, null, data in _open(left):
            cut = sorted(spans.get((w, zlib.crc32(data)), ())) if not null and spans else []
            kept, at, removed, n = [], 0, 0, 0
            end = -1
            for a, b in cut:
                if a > end:
                    kept.append(data[max(end, 0) : a])
                    removed += b - a
                    n += 1
                    end = b
                elif b > end:
                    removed += b - end
                    end = b
            kept.append(data[max(end, 0) :])
            rest = b"".join(kept)
            for o, x in zip(out, (None if null else w, len(data), removed, n, hashlib.sha256(rest).hexdigest(), rest if keep else None, rest.decode("utf-8", "ignore") if keep else None)):
                o.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string())
        other = _carried(left) if carry and left.num_rows else None
        more = [other.column(c).combine_chunks().cast(t) if other is not None else pa.array([], t) for c, t in carry.items()]
        return pa.table([*[pa.array(o, t) for o, t in zip(out, kinds)], *more], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text", *carry])

    return run


def remove_repeats(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = WIDTH, k: int = K, block_bytes: int = BLOCK_BYTES, keep: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row, with ``keep`` also
    the bytes kept and their text without broken characters; the columns named in ``carry`` (of plain types) come along.

    Removed is each byte under a ``width``-byte string that also starts in a row with a smaller id, judged on the
    input; n_spans counts maximal removed runs. A null text is empty. Rows with a null id are kept whole and
    remove nothing. Rows with one id don't remove from each other; repeated rows come back as often as they came.
    Other columns are not read. An empty table gives no rows.
    """
    d = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), *[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(carry)])
    held_columns = tuple(f"_{i}" for i in range(len(carry)))
    _, size = volume(d)
    blocks = int(min(60_000, max(4, -(-size // block_bytes))))
    p = parts(d)
    small = "bucket int, kind byte, block int, blob binary"
    shards = d.select("id", "text").mapInArrow(tidy(_scan(blocks, width, k)), "block int, blob binary").repartition(p, "block").sortWithinPartitions("block")
    found = shards.mapInArrow(tidy(_shard(blocks, width)), small).repartition(p, "bucket")
    held = d.mapInArrow(tidy(_texts(blocks, held_columns)), "bucket int, blob binary").repartition(p, "bucket").groupBy("bucket")
    fetched = held.cogroup(found.groupBy("bucket")).applyInArrow(_fetch, "block int, blob binary")
    exact = fetched.repartition(p, "block").sortWithinPartitions("block").mapInArrow(tidy(_sorted(blocks, width)), small)
    kinds = {c: to_arrow_type(d.schema[c].dataType) for c in held_columns}
    done = held.cogroup(exact.repartition(p, "bucket").groupBy("bucket")).applyInArrow(_finish(keep, kinds), RESULT + "".join(f", {c} {d.schema[c].dataType.simpleString()}" for c in held_columns))
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept", "kept_text"] * keep]
    return done.select(F.col("id").alias(id), *names, *[F.col(h).alias(c) for h, c in zip(held_columns, carry)])
