import hashlib

import pytest

from zonarium.llm import bpe
from zonarium.llm.queries import vocabulary

tokenizers = pytest.importorskip("tokenizers")
TEXTS = [
    None,
    "",
    " ",
    "The cat's 12 hats, they'll   go.\n\n  Yes!\t ",
    "déjà vu — 日本語 😀 <|endoftext|> after<|endoftext|>",
    "a" * 3000,
    "x y" * 2000,
    "\x00\x1c ſ ² '",
]


@pytest.fixture(scope="module")
def spec():
    return vocabulary()


def test_equals_the_library(spec):
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = bpe.ByteBPE(spec)
    for text in TEXTS[1:]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == ids
        assert encoder.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_small_memory_gives_the_same(spec):
    small, large = bpe.ByteBPE(spec, memo_words=2), bpe.ByteBPE(spec)
    for text in TEXTS[1:]:
        assert small.digest(text) == large.digest(text)


def test_digests_and_round_trip(make, spec):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "two rows", "x"), (3, TEXTS[3], "x")]
    docs = make(rows, "doc_id long, text string, ids string")
    encoder = bpe.ByteBPE(spec)
    got = sorted(map(tuple, bpe.encoding_digests(docs, spec).collect()), key=repr)
    assert got == sorted(((i, *encoder.digest(t or "")) for i, t, _ in rows), key=repr)
    back = bpe.decode_ids(bpe.encode_texts(docs, spec), spec).collect()
    assert sorted(map(tuple, back), key=repr) == sorted(((i, t or "") for i, t, _ in rows), key=repr)
    empty = bpe.encoding_digests(docs.limit(0), spec).collect()
    assert empty == []
    assert encoder.digest("")[1] == hashlib.sha256(b"").hexdigest()
