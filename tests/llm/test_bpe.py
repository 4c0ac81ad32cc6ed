import random

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from lectern.llm.bpe import WordBpe
from lectern.llm.packing import ByteBpe

ODD = ["", " ", "  ", "a", " a", "a ", "it's 're'll 'S x's", "''s '-'s 'd", "Ünïcödé ½ ２ 日本語テキスト", "a\n\nb \n c\t\td\r\n", "x   y", "!\x1c! a\x1fb", "<|endoftext|> x<|startoftext|>y <|endoftext|", "é ́e İI ΑΣ ΣΑΣ", "1234 5.6e7 $$$%%%", "🙂🙂 a🙂b", " a  b\x85c", "ﬁ ﬀ Å Å"]


def words(seed, n):
    r = random.Random(seed)
    alphabets = ["abc", "aab", "etaoin shrdlu", "the and ing er", "éèàçäöüß", "0123456789", "$%&*'", "日本語", "\n \t"]
    return ["".join(r.choice(r.choice(alphabets)) for _ in range(r.randint(0, 400))) for _ in range(n)]


@pytest.fixture(scope="module")
def samples():
    return ODD + words(1, 400)


def test_byte_bpe_equals_library(samples):
    path = P.path("byte_bpe_50k.json")
    mine, theirs = ByteBpe(path), Tokenizer.from_file(path)
    for s in samples:
        want = theirs.encode(s, add_special_tokens=False).ids
        got = mine.ids(s)
        assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want, repr(s)


@pytest.mark.parametrize("leaf", [2, 5, 16, 256])
def test_word_bpe_equals_library(samples, leaf):
    path = P.path("word_bpe_49k.json")
    mine, theirs = WordBpe(path, leaf=leaf), Tokenizer.from_file(path)
    for s in samples:
        want = theirs.encode(s, add_special_tokens=False).ids
        assert mine.encode(s) == want, repr(s)
        units = mine.units(s)
        assert " ".join(u[1] for u in units) == " ".join(map(str, want))
        assert " ".join(u[2] for u in units) == theirs.decode(want, skip_special_tokens=False)


def test_tree_concatenation_of_long_runs():
    path, r = P.path("word_bpe_49k.json"), random.Random(3)
    mine, theirs = WordBpe(path), Tokenizer.from_file(path)
    for s in ["a" * 5000, "ab" * 3001, "".join(r.choice("abcdeèß") for _ in range(20_000)), "".join(r.choice("aaaab") for _ in range(9_000)), "$%" * 2000 + "x" * 999 + "'s" * 700]:
        assert mine.encode(s) == theirs.encode(s, add_special_tokens=False).ids


def test_documents_nulls_repeats_and_none(spark):
    import hashlib

    from lectern.llm import bpe
    from lectern.llm.queries import tokenizer
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rows = [(1, "Some WORDS, and a stop."), (1, "Some WORDS, and a stop."), (2, None), (3, ""), (None, "No id; <|endoftext|> \u2003 it's"), (4, "x" * 5000 + " \n\t end")]
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], "doc_id long, text string, ids_sha256 string, n_tokens int")
    got = bpe.encode_documents(df, path).collect()
    want = []
    for i, t in rows:
        e = whole.encode(t or "", add_special_tokens=False)
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want.append((i, len(e.ids), digest(" ".join(map(str, e.ids))), digest(whole.decode(e.ids, skip_special_tokens=False))))
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert bpe.encode_documents(df.limit(0), path).collect() == []
