"""Byte-level BPE against the tokenizers library and by exact round trips."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyrisk.llm import bpe

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
LIBRARY = Tokenizer.from_file(PATH)
MINE = bpe.load(PATH)
TEXTS = [None, "", " ", "  two  spaces \n\n tabs\t\tx ", "Hello world, it's DON'T we'll I've", "über straße ñandú 東京 ١٢٣",
         "<|endoftext|>", "a<|endoftext|>  <|endoftext|>b", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "🙂🙃 ‍́ x y",
         "x" * 5000, "ab" * 3000 + " " * 500, "1234567890.12e-4", "\r\n\r\n a", "\x00\x01\x7f", "thnterble onthtionhent"]


@pytest.mark.parametrize("text", [t for t in TEXTS if t is not None])
def test_equals_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert MINE.encode(text) == ids
    assert MINE.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=80))
def test_any_text(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert MINE.encode(text) == ids and MINE.decode(ids) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=30))
def test_any_tokens(ids):
    assert MINE.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.data())
def test_tree_root_is_the_minimum(values, data):
    tree = bpe.PairTree(list(values))
    for _ in range(10):
        at, v = data.draw(st.integers(0, len(values) - 1)), data.draw(st.integers(0, 20))
        tree.set(at, v)
        values[at] = v
        assert tree.tree[1] == min(values)


def test_frames(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "x"), (4, TEXTS[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = bpe.token_digests(docs, PATH).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        assert by[i].n_tokens == len(ids)
        assert by[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    both = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH)
    assert both.filter("decoded <> coalesce(text, '')").count() == 0 and both.count() == len(rows)
    assert bpe.token_digests(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_a_piece_of_over_a_megabyte_and_a_full_store(monkeypatch):
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from tallyrisk.llm import bpe as P
    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    theirs, ours = Tokenizer.from_file(path), P.ByteBPE(path)
    text = "ab" * 600_000 + " x"
    assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(P, "REMEMBERED_BYTES", 3_000)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(30)) for _ in range(20)]
    sizes = []
    for t in texts:
        assert ours.encode(t) == theirs.encode(t, add_special_tokens=False).ids
        sizes.append(ours.held)
    assert max(sizes[1:]) < 12_000 and ours.held < 12_000
