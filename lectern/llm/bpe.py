"""BPE encoding and decoding of whole texts, long unsplit runs by tree concatenation.

A text is cut at spaces, where this vocabulary's pre-tokenizer always cuts, and units are encoded once a
worker. A pre-token longer than a leaf is encoded as a tree: its leaves (halves of halves) in parallel, then
each join re-encodes a window of the last tokens on its left and the first on its right, and widens it until
the window begins with the token that the left side had there and ends with the one the right side had. Then
every neighbouring pair of tokens is the encoding of its own text, which makes the whole the encoding.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch as rows_of, texts, tidy

LEAF = 256  # symbols of a leaf
CACHED = 600_000  # units whose encoding a worker remembers
STOPS = frozenset(".,;:!?")


class WordBpe:
    """The encoder of one tokenizer file; no decoder in the file, so decoding joins tokens by spaces."""

    def __init__(self, path: str, leaf: int = LEAF):
        from tokenizers import Tokenizer, models

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        # units between white space, words apart from stops and in lower case: only for files that cut texts so
        how, cut = (spec.get("normalizer") or {}).get("normalizers", []), (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        white = [n for n in how if n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " "]
        apart = cut[0].get("type") == "Split" and cut[0].get("invert") and cut[0].get("behavior") == "Removed" and cut[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        if not white or not apart or "Lowercase" not in [n["type"] for n in how] or spec.get("decoder"):
            raise ValueError(f"{path}: its normaliser, pre-tokenizer or decoder is none that this encoder knows")
        self.whole, self.leaf = Tokenizer.from_file(path), leaf
        self.whole.no_truncation(), self.whole.no_padding()
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        suffix = model.get("end_of_word_suffix") or ""
        self.inner = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges))
        self.last = Tokenizer(models.BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=suffix or None))
        self.suffix = suffix
        self.special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        size = max([*self.whole.get_vocab().values(), 0]) + 1
        self.token = [self.whole.id_to_token(i) or "" for i in range(size)]
        self.length = [len(t) - len(suffix) * bool(suffix and t.endswith(suffix)) for t in self.token]
        self.known: dict[str, tuple[int, str, str]] = {}

    def _again(self, symbols: str, at_end: bool) -> list[int]:
        return [t.id for t in (self.last if at_end else self.inner).model.tokenize(symbols)] if symbols else []

    def join(self, symbols: str, a: list[int], b: list[int], at_end: bool) -> list[int]:
        """The encoding of ``symbols``, whose two parts have the encodings a and b."""
        split, i, j = sum(self.length[t] for t in a), 1, 1
        while True:
            i, j = min(i, len(a)), min(j, len(b))
            lo = split - sum(self.length[t] for t in a[len(a) - i :])
            hi = split + sum(self.length[t] for t in b[:j])
            new = self._again(symbols[lo:hi], at_end and j == len(b))
            left = i == len(a) or new[0] == a[-i]
            right = j == len(b) or new[-1] == b[j - 1]
            if left and right:
                return a[: len(a) - i] + new + b[j:]
            i, j = i * (1 if left else 2), j * (1 if right else 2)

    def word(self, symbols: str) -> list[int]:
        """Ids of one pre-token, given in the vocabulary's alphabet."""
        if len(symbols) <= self.leaf:
            return self._again(symbols, True)
        cuts = [symbols[i : i + self.leaf] for i in range(0, len(symbols), self.leaf)]
        level = [(s, e.ids) for s, e in zip(cuts, self.inner.encode_batch(cuts[:-1], add_special_tokens=False))]
        level.append((cuts[-1], self._again(cuts[-1], True)))
        while len(level) > 1:
            up = []
            for k in range(0, len(level) - 1, 2):
                (s, a), (t, b) = level[k], level[k + 1]
                up.append((s + t, self.join(s + t, a, b, k + 2 == len(level))))
            level = up + level[len(level) - len(level) % 2 :]
        return level[0][1]

    def unit(self, text: str) -> list[int]:
        """Ids of a text without regard to its length."""
        if len(text) <= self.leaf // 2:
            return self.whole.encode(text, add_special_tokens=False).ids
        out: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for symbols, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(part)):
                    out += self.word(symbols)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for u in text.split(" ") for i in self.unit(u)]

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.token[i] for i in ids)

    def _unit(self, u: str) -> tuple[int, str, str]:
        """(tokens, ids, decoded) of one unit. A word with a stop behind it is two pre-tokens, and ASCII is looked up
        in lower case, so that a word is encoded once in all its dresses."""
        if u[-1:] in STOPS and u[:-1].isalpha():
            a, b = self._known(u[:-1]), self._known(u[-1])
            return a[0] + b[0], f"{a[1]} {b[1]}", f"{a[2]} {b[2]}"
        if u.isascii() and u.isalpha() and (low := u.lower()) != u:
            return self._known(low)
        ids = self.unit(u)
        return len(ids), " ".join(map(str, ids)), self.decode(ids)

    def _known(self, u: str) -> tuple[int, str, str]:
        got = self.known.get(u)
        if got is None:
            got = self._unit(u)
            if len(u) < 64:
                self.known[u] = got
        return got

    def units(self, text: str) -> list[tuple[int, str, str]]:
        """(tokens, ids, decoded) of each unit that has tokens."""
        if len(self.known) > CACHED:
            self.known.clear()
        get, known = self.known.get, self._known
        return [got for u in text.replace("\n", " ").split(" ") if u and (got := get(u) or known(u))[0]]


@functools.lru_cache(2)
def _coder(path: str) -> WordBpe:
    return WordBpe(path)


def encode_documents(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text; with ``ids`` also token_ids and decoded.

    The digests are of the decimal ids joined by spaces and of the decoded text in UTF-8. Null or empty text: no
    tokens, digests of the empty string. Null ids, ties and repeated rows come back as they are."""
    fields = [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + [("token_ids", pa.list_(pa.int32())), ("decoded", pa.string())] * ids)

    def run(batches):
        coder = _coder(tokenizer)
        for b in batches:
            n, first, second, raw, back = [], [], [], [], []
            for t in texts(b.column("text")).to_pylist():
                units = coder.units(t)
                n.append(sum(u[0] for u in units))
                decimal, decoded = " ".join([u[1] for u in units]), " ".join([u[2] for u in units])
                first.append(hashlib.sha256(decimal.encode()).hexdigest())
                second.append(hashlib.sha256(decoded.encode()).hexdigest())
                if ids:
                    raw.append([int(x) for x in decimal.split()])
                    back.append(decoded)
            yield rows_of(schema, b.column("id"), n, first, second, *([raw, back] if ids else []))

    d = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return d.mapInArrow(tidy(run), "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>, decoded string" * ids).withColumnRenamed("id", id)
