import random

import pytest
from tokenizers import Tokenizer

from millrace.llm import token_counts

ALPHABET = [*"abrevlstmdREé' '''  \n\t\x0b　129½#$.,😀漢<|>thein", "'s", "'re", "'ll", "<|endoftext|>", "'ve", "ing", " the"]


@pytest.fixture(scope="module")
def library(vocabulary):
    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def counter(vocabulary):
    return token_counts.counter(vocabulary("byte_bpe_50k.json"))


def lengths(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_are_the_librarys(library, counter, pack_texts):
    random.seed(7)
    texts = ["".join(random.choices(ALPHABET, k=random.randrange(30))) for _ in range(2000)]
    assert list(counter.count_batch(*pack_texts(texts))) == lengths(library, texts)


def test_every_prefix(library, counter):
    random.seed(8)
    for text in ["", " ", "a  b", "it'll", *("".join(random.choices(ALPHABET, k=20)) for _ in range(150))]:
        assert counter.text_prefixes(text).tolist() == lengths(library, [text[:j] for j in range(len(text) + 1)])


def test_budget(library, counter):
    text = "The ferry left the harbour shortly before dawn, and it's gone."
    for budget in range(20):
        n = counter.longest_prefix(text, budget)
        assert lengths(library, [text[:n]])[0] <= budget
        assert all(c > budget for c in lengths(library, [text[:j] for j in range(n + 1, len(text) + 1)]))


def test_counts(docs, library, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    got = token_counts.counts(docs, path, limit=512).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None:
            t = texts[r.doc_id]
            assert (r.n_bytes, r.n_tokens) == (len(t.encode()), lengths(library, [t])[0])
        assert r.over_limit == (r.n_tokens > 512)
    assert token_counts.counts(docs.limit(0), path, limit=1).count() == 0
