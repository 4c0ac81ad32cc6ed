"""Best-fit packing of tokenised documents by minimum bin slack.

The packing depends on lengths only, and there are at most ``capacity`` different ones. So the plan is made
on the histogram of lengths, which stays that small at any size: for one bin a bitset subset-sum dynamic
program finds the fullest feasible combination of available lengths; the combination is taken as often as the
histogram allows, after which fewer of one length are left than it took. So the number of combinations is bounded by
the lengths and how often each fits a bin (about capacity * ln(capacity)), whatever the size of the corpus.
Pieces then look up their place by rank among pieces of their length, a rank counted per partition and
shifted by prefix sums, so a frequent length is never gathered in one task.
"""

from __future__ import annotations

import functools
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import batch as rows_of, checkpoint, texts, tidy

CAPACITY, EOS = 1024, 2
CACHED = 200_000  # units whose ids a worker remembers


class ByteBpe:
    """Token ids of whole texts, as 4-byte little-endian strings.

    Text is cut where a space follows a character that is no white space: no token of this pre-tokenizer spans
    such a place and none of its look-ahead crosses it. The units repeat, so their ids are remembered. Texts
    with other white space than single spaces and line breaks are encoded whole. All this holds for files whose
    merges are in the order of their ids and whose only pre-tokenizer is byte-level with the usual pattern; for any
    other the library encodes the texts itself."""

    odd = re.compile(r"[^\S \n]|\s\s|[\x1c-\x1f]|<\|endoftext\|>")

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        whole.no_truncation(), whole.no_padding()
        vocab, spec = whole.get_vocab(), json.loads(whole.to_str())
        model, cut = spec["model"], spec["pre_tokenizer"] or {}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        usual = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True) and not spec["normalizer"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        self.library = None if usual and plain and merged == sorted(set(merged)) else whole
        if self.library:
            return
        special = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
        # the vocabulary's byte alphabet: printable bytes stand for themselves, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if t not in special}
        words = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.coder = tiktoken.Encoding("byte_bpe", pat_str=words, mergeable_ranks=ranks, special_tokens=special)
        self.after_space: dict[str, bytes] = {}

    def unit(self, u: str) -> bytes:
        return np.array(self.coder.encode_ordinary(" " + u), np.uint32).tobytes()

    def ids(self, text: str) -> bytes:
        if self.library:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()
        if self.odd.search(text):
            return np.array(self.coder.encode(text, allowed_special="all"), np.uint32).tobytes()
        first, *units = text.split(" ")
        known = self.after_space
        if len(known) > CACHED:
            known.clear()
        out = [np.array(self.coder.encode_ordinary(first), np.uint32).tobytes()]
        for u in units:
            got = known.get(u)
            if got is None:
                got = self.unit(u)
                if len(u) < 64:
                    known[u] = got
            out.append(got)
        return b"".join(out)


@functools.lru_cache(2)
def _coder(path: str) -> ByteBpe:
    return ByteBpe(path)


def pieces(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, eos: int = EOS) -> DataFrame:
    """(id, piece, start, length, ids_crc32): each document's ids and ``eos``, cut only if longer than ``capacity``.

    All pieces of a cut document but the first are full. Null text is empty, so its one piece is ``eos``; null
    ids and repeated rows are kept as they are."""
    schema = pa.schema([("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([eos], np.uint32).tobytes()

    def run(batches):
        coder = _coder(tokenizer)
        for b in batches:
            who, piece, start, length, crc = [], [], [], [], []
            for i, t in zip(b.column("id").to_pylist(), texts(b.column("text")).to_pylist()):
                ids = coder.ids(t) + end
                n = len(ids) // 4
                at, to, k = 0, (n - 1) % capacity + 1, 0
                while at < n:
                    who.append(i), piece.append(k), start.append(at), length.append(to - at)
                    crc.append(zlib.crc32(ids[4 * at : 4 * to]))
                    at, to, k = to, to + capacity, k + 1
            yield rows_of(schema, who, piece, start, length, crc)

    d = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return d.mapInArrow(tidy(run), "id long, piece int, start long, length long, ids_crc32 long")


def fullest(count: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination of available lengths with the longest one in it: length -> how often.

    ``reach`` holds a bit for each fill that the lengths so far can make; copies enter in powers of two."""
    longest = max(count)
    room, steps, reach, mask = capacity - longest, [], 1, (1 << (capacity - longest + 1)) - 1
    for length in sorted((x for x in count if x <= room), reverse=True):
        left, g = min(count[length] - (length == longest), room // length), 1
        while left > 0:
            g = min(g, left)
            steps.append((length, g, reach))
            reach |= (reach << (length * g)) & mask
            left -= g
            g *= 2
        if reach >> room & 1:
            break
    fill, used = reach.bit_length() - 1, {longest: 1}
    for length, g, before in reversed(steps):
        if not before >> fill & 1:
            fill -= length * g
            used[length] = used.get(length, 0) + g
    return used


def plan(count: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, times in a bin, bins, first bin, offset) of every length of every combination."""
    left, out, base, taken = {k: v for k, v in count.items() if v > 0}, [], 0, dict.fromkeys(count, 0)
    while left:
        used = fullest(left, capacity)
        bins = min(left[k] // v for k, v in used.items())
        offset = 0
        for k, v in used.items():
            out.append((k, taken[k], v, bins, base, offset))
            taken[k] += v * bins
            left[k] -= v * bins
            offset += v * k
            if not left[k]:
                del left[k]
        base += bins
    return out


def place(items: DataFrame, *, length: str = "length", order: tuple[str, ...] = ("id", "piece"), capacity: int = CAPACITY) -> DataFrame:
    """``items`` with (sequence_id, offset): bins of at most ``capacity`` without gaps, whole items only.

    Lengths must be from 1 to ``capacity``; a null or other length is an error. Nulls in other columns and repeated
    rows are items like others. Names of columns must not be those that are added, nor ``_part``, ``_len``, ``_n``,
    ``_row``, ``_shift`` or ``_rank``: an error too. Items are checkpointed first, so that ranks don't change when a
    lost executor's tasks run again. Empty input: no rows."""
    taken = {"sequence_id", "offset", "_part", "_len", "_n", "_row", "_shift", "_rank"} & {c.lower() for c in items.columns}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the way")
    kept = checkpoint(items).withColumn("_part", F.spark_partition_id())
    counts = checkpoint(kept.groupBy("_part", F.col(length).alias("_len")).agg(F.count(F.lit(1)).alias("_n")))
    histogram = {r[0]: r[1] for r in counts.groupBy("_len").agg(F.sum("_n")).collect()}  # at most ``capacity`` rows
    if any(k is None or not 0 < k <= capacity for k in histogram):
        raise ValueError("lengths must be from 1 to the capacity")
    before = W.partitionBy("_len").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select("_part", "_len", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    ranked = kept.withColumn("_len", F.col(length)).withColumn("_row", F.row_number().over(W.partitionBy("_part", "_len").orderBy(*order)) - 1)
    ranked = ranked.join(shift, ["_part", "_len"]).withColumn("_rank", F.col("_row") + F.col("_shift"))
    rows = np.array(sorted(plan(histogram, capacity)) or np.zeros((0, 6)), np.int64)

    def run(batches):
        index = {k: i for i, k in enumerate(np.unique(rows[:, 0]).tolist())}
        span = int(rows[:, 1].max(initial=0)) + 1
        at = np.array([index[k] for k in rows[:, 0].tolist()], np.int64) * span + rows[:, 1]
        for b in batches:
            size, rank = b.column("_len").to_numpy().astype(np.int64), b.column("_rank").to_numpy()
            lookup = np.array([index[int(k)] for k in size], np.int64) * span + np.minimum(rank, span - 1)
            r = rows[np.searchsorted(at, lookup, "right") - 1]
            within = rank - r[:, 1]
            seq, offset = r[:, 4] + within // r[:, 2], r[:, 5] + within % r[:, 2] * size
            names = [n for n in b.schema.names if n not in ("_part", "_len", "_row", "_shift", "_rank")]
            yield pa.RecordBatch.from_arrays([*[b.column(n) for n in names], pa.array(seq), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ranked.mapInArrow(tidy(run), f"{out}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, eos: int = EOS) -> DataFrame:
    """Every document's pieces with their places in sequences of at most ``capacity`` tokens."""
    return place(pieces(docs, tokenizer, id=id, text=text, capacity=capacity, eos=eos), capacity=capacity).withColumnRenamed("id", id)
