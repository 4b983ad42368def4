import hashlib
import random

import pytest
import regex
import tiktoken

from millrace.llm import bpe, pretokens

ALPHABET = [*"abrevlstmdREé' '''  \n\t\x0b\x1c　\xa0129½#$.,😀漢<|>", "'s", "'re", "'ll", "<|endoftext|>", "'ve", "ing"]


@pytest.fixture(scope="module")
def texts():
    random.seed(5)
    return ["", *("".join(random.choices(ALPHABET, k=random.randrange(30))) for _ in range(3000)), "ab" * 3000, " " * 500, "don't 'tis we're"]


def test_pieces_are_those_of_the_pattern(texts, pack_texts):
    import public_tokenizers

    pattern = regex.compile(public_tokenizers.PATTERN)
    text, starts, heads = bpe.pieces_of(*pack_texts(texts))
    for i, t in enumerate(texts):
        at = starts[heads[i] : heads[i + 1] + 1]
        assert [text[a:b] for a, b in zip(at[:-1], at[1:], strict=True)] == pattern.findall(t)


def test_functions_compose():
    _, nexts, _, maps, compose, basic = pretokens.tables()
    for y in range(pretokens.SYMBOLS):
        assert (maps[basic[y]] == nexts[:, y]).all()
    for f in range(len(maps)):
        for g in range(len(maps)):
            assert (maps[compose[f, g]] == maps[g][maps[f]]).all()


def test_ids_are_the_librarys(texts, pack_texts, vocabulary):
    import public_tokenizers

    tool = bpe.encoder(vocabulary("byte_bpe_50k.tiktoken"))
    want = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tool.ranks, special_tokens={})
    for t, ids in zip(texts, tool.encode_batch(*pack_texts(texts)), strict=True):
        assert ids == want.encode_ordinary(t)
        assert tool.decode(ids) == t.encode()


def test_long_pieces_merge_as_short_ones(vocabulary):
    ranks = bpe.encoder(vocabulary("byte_bpe_50k.tiktoken")).ranks
    random.seed(6)
    for _ in range(300):
        piece = "".join(random.choices("theingaon ", k=random.randrange(2, 60))).encode()
        assert bpe._merge_long(piece, ranks) == bpe.merge(piece, ranks) or piece in ranks


def test_offsets_lead_back_to_the_text(vocabulary):
    tool = bpe.encoder(vocabulary("byte_bpe_50k.tiktoken"))
    text = "Hällo wörld, it's 12 o'clock"
    spans = tool.encode_with_offsets(text)
    assert b"".join(text.encode()[a:b] for _, a, b in spans) == text.encode()
    assert [i for i, _, _ in spans] == tool.encode(text)


def test_cache_is_bounded():
    cache = bpe.Cache(lambda p: (1,), most=3)
    for p in "abcde":
        cache[p]
    cache.trim()
    assert len(cache) == 0


def test_digests(docs, vocabulary):
    path = vocabulary("byte_bpe_50k.tiktoken")
    got = bpe.digests(docs, path).collect()
    assert len(got) == docs.count()
    tool = bpe.encoder(path)
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    for r in got:
        if r.doc_id is not None:
            t = texts[r.doc_id] or ""
            assert r.n_tokens == len(tool.encode(t))
            assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
            assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, tool.encode(t))).encode()).hexdigest()
    assert bpe.digests(docs.limit(0), path).count() == 0
