import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import alignment

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def paths(vocabulary):
    return vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries(paths):
    import sentencepiece
    from tokenizers import Tokenizer

    from millrace.llm.bpe import byte_letters

    a, b, letters = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1]), byte_letters()
    a.encode_special_tokens = True

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def both(text):
        one = a.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in one], [(i, piece(i)) for i in b.encode(text)]

    return both


def groups_of(text, both):
    if not text:
        return []
    a, b = both(text)
    want = (" " + text).encode()
    if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
        return []
    groups, end_a, end_b, now = [], 0, 0, ([], [])
    a, b = [*a], [*b]
    while a or b:
        if end_a <= end_b:
            i, x = a.pop(0)
            now[0].append(i)
            end_a += len(x)
        else:
            i, x = b.pop(0)
            now[1].append(i)
            end_b += len(x)
        if end_a == end_b and now[0] and now[1]:
            groups.append(now)
            now = ([], [])
    return groups


def brute(rows, both):
    found = [(i, groups_of(t, both)) for i, t in rows]
    holds, links = Counter(), Counter()
    for _, groups in found:
        own = Counter((a, b) for x, y in groups for a in x for b in y)
        holds.update(own.keys())
        links.update(own)
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    out = []
    for i, groups in found:
        own = [(a, b) for x, y in groups for a in x for b in y]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(own), sum(holds[p] == most[p[0]] for p in own), sum(holds[p] for p in own), hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str), {p: (holds[p], links[p]) for p in holds}


TEXTS = [
    "One two three four five six seven.", "one TWO three", None, "", "   \n\t ", "x", "word " * 300, "Ein Text mit Umlauten: äöü ÄÖÜ.", "😀 emoji 漢字 text 漢字漢字",
    "ends with <|endoftext|> and <s> here </s> <unk> <0x41>", "a▁b", "tabs\t\tand\r\nlines\n\n\n  blanks", "\x00 nul", "été naïve", "é", "ﬁligature ①", " nbsp 　", "🏳️‍🌈🏳️‍🌈🏳️‍🌈",
]


def test_results_are_those_of_the_libraries(spark, paths, libraries):
    rows = [*enumerate(TEXTS), (0, TEXTS[0]), (None, TEXTS[7]), (None, None), (5, "another")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = alignment.align(frame, *paths)
    want, pairs = brute(rows, libraries)
    assert tuple(got.columns) == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert {(r.a, r.b): (r.documents, r.links) for r in alignment.pairs(frame, *paths).collect()} == pairs


def test_small_blocks_and_passes(spark, paths, libraries, monkeypatch):
    for name, value in (("HELD", 50), ("PAIRS", 40), ("ROWS", 7)):
        monkeypatch.setattr(alignment, name, value)
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    monkeypatch.setattr(alignment, "runs", lambda texts: ((i, i + 1) for i in range(len(texts))))
    assert sorted(map(tuple, alignment.align(frame, *paths).collect()), key=str) == brute(rows, libraries)[0]


def test_bitmaps_round_trip_and_merge():
    rng = np.random.default_rng(2)
    runs = [np.sort(rng.choice(alignment.BLOCK_DOCS, n, replace=False)) for n in (1, 5, 4095, 4096, 30_000, 65_536, 2)]
    for some in (runs, runs[:3]):
        made = alignment.bitmaps(np.cumsum([0, *map(len, some)]), np.concatenate(some)).to_pylist()
        assert all((alignment.members_of(b) == r).all() for b, r in zip(made, some, strict=True))
        assert all(len(b) <= alignment.BITS for b in made)
    block = alignment.Block(9)
    block.add(np.array([4, 4, 1]), np.array([0, 0, 3]), np.array([2, 3, 1]))
    block.add(np.array([4, 1, 4]), np.array([7, 8, 9]), np.array([1, 4, 2]))
    rows = [r for b in block.postings() for r in b.to_pylist()]
    read = {(r["pair"], r["plane"]): alignment.members_of(r["bitmap"]).tolist() for r in rows}
    assert read == {(1, -1): [3, 8], (4, -1): [0, 7, 9], (1, 0): [8], (4, 0): [9], (1, 1): [8], (4, 2): [0]}
    assert all(r["n"] == len(read[r["pair"], r["plane"]]) and r["block"] == 9 for r in rows)


def test_a_long_text_and_a_large_group(spark, paths, libraries):
    rows = [(1, "the cat sat " * 20_000), (2, "漢字" * 3000), (3, " " * 5000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, alignment.align(frame, *paths).collect()), key=str) == brute(rows, libraries)[0]


def test_odd_rows_and_empty_tables(spark, paths, docs, libraries):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(tuple, alignment.align(docs, *paths).collect()), key=str) == brute(rows, libraries)[0]
    empty = alignment.align(spark.createDataFrame([], "doc_id long, text string"), *paths)
    assert empty.count() == 0 and tuple(empty.columns) == COLUMNS
    bad = spark.sql("SELECT 1L AS doc_id, cast(x'616263ff20646566' AS string) AS text")
    assert alignment.align(bad, *paths).first().n_a > 0
