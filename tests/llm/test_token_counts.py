import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from silverbrook.llm.common import table
from silverbrook.llm.queries import QUERIES
from silverbrook.llm.token_counts import Lengths, check_vocabulary, load, slices, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


def by_library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_query_against_the_library(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    got = QUERIES["op12_token_counts"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = {
        d: (len((t or "").encode()), n, n > 2048)
        for (d, t), n in zip(rows.items(), by_library(rows.values()), strict=True)
    }
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    assert any(over for *_, over in want.values())


def test_edge_cases(spark, edge_docs, clashing_docs, edge_rows, no_docs):
    want = sorted(
        (repr(d), len((t or "").encode()), n)
        for (d, t, *_), n in zip(edge_rows, by_library(t for _, t, *_ in edge_rows), strict=True)
    )
    for docs in (edge_docs, clashing_docs):
        assert sorted((repr(r[0]), *r[1:]) for r in token_counts(docs, PATH).collect()) == want
    assert token_counts(no_docs, PATH).count() == 0


def test_any_characters_with_and_without_the_table(spark):
    rng = random.Random(3)
    odd = [*range(1, 0x250), *range(0x300, 0x370), 0x1680, 0x2000, 0x200B, 0x2028, 0x3000, 0x1F600, 0x4E2D, 0x3C3, 0x130, 0x1100, 0x1161]
    characters = [*map(chr, odd), *[" "] * 60, *["'s", "'S", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll"] * 8, *["a", "B", "1", "."] * 10]
    texts = ["".join(rng.choices(characters, k=rng.randint(0, 60))) for _ in range(3000)]
    want = by_library(texts)
    raw = [t.encode() for t in texts]
    assert Lengths(PATH, (b"", b"")).count(raw) == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert {r.doc_id: r.n_tokens for r in token_counts(docs, PATH).collect()} == dict(enumerate(want))


def test_a_small_cache_and_small_slices_change_nothing(monkeypatch):
    from silverbrook.llm import token_counts as module

    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcAé1.,'", k=rng.randint(1, 50))) for _ in range(200)) for _ in range(20)]
    want = by_library(texts)
    for name, value in {"CACHED": 50, "AT_ONCE": 7, "SLICE": 30}.items():
        monkeypatch.setattr(module, name, value)
    tiers = Lengths(PATH, (b"a b", b"\x01\x00\x01\x00"))
    assert tiers.count([t.encode() for t in texts]) == want
    assert len(tiers.cache) <= 50
    text = texts[0].encode()
    assert b" ".join(slices(text, 30)) == text and max(map(len, slices(text, 30))) <= 30 + 52
    assert list(slices(b"x" * 100, 30)) == [b"x" * 100] and list(slices(b"", 30)) == [b""]


def test_other_vocabularies_are_refused():
    check_vocabulary(load(PATH))
    with pytest.raises(ValueError):
        check_vocabulary(load(public_tokenizers.path("byte_bpe_50k.json")))
