import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import test_simhash
import tiktoken
import tiktoken.load
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_feed_the_next(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("lang_pred", F.lit("x")).withColumn("predicted", F.lit(9))
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.columns == columns
        assert 0 < docs.count() <= before
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


def test_run(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert len(got) and (got.offset + got.length).max() <= 1024
    assert len(corpus_pipeline.STAGES) == 4


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_each_query_returns_a_row_for_each_of_its_rows(spark, name):
    got = queries.queries()[name](spark, SF)
    n = got.count()
    if name in ("op6_topk",):
        assert n == 5 * spark.read.parquet(f"{SF}/embeddings.parquet").where("vec_id % 50 = 0").count()
    elif name == "op12_lexical":
        assert n == 10 * spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id").distinct().count()
    elif name == "op10_packing":
        assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    else:
        table = "pages" if name.startswith("op9") else "documents"
        assert n == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_agrees(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_stages_on_odd_rows(spark, docs, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows and ids, a run of white space that the library refuses, clashing names."""
    table = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    long_run = table.limit(1).withColumn("doc_id", F.lit(777_777).cast("long")).withColumn("text", F.concat("text", F.repeat(F.lit(" "), 1_100_000), "text"))
    repeated = table.limit(20).unionByName(table.limit(5).withColumn("doc_id", F.lit(None).cast("long")))
    rows = table.unionByName(repeated).unionByName(long_run).withColumn("Score", F.lit(1)).withColumn("fp", F.lit("x")).unionByName(docs.select("doc_id", "text", "lang", "source", "n_chars", F.lit(1).alias("Score"), F.lit("y").alias("fp")))
    given = rows
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, rows, SF).write.parquet(str(tmp_path / str(k)))
        rows = spark.read.parquet(str(tmp_path / str(k)))
        assert rows.columns == given.columns
        assert rows.exceptAll(given).count() == 0
    assert rows.count() == rows.select("text").distinct().count()
    assert rows.where("text is null").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, SF)
    assert pieces.where("start = 0").count() == rows.count()


def test_stages_on_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


@pytest.mark.parametrize(("name", "columns"), [("op1_simhash", 3), ("op3_repetition", 8), ("op5_byte_bpe", 4), ("op7_token_counts", 4), ("op10_packing", 7)])
def test_queries_are_those_of_brute_force(spark, name, columns):
    """Of the small table's documents, counted with the libraries and plain Python."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {}
    for r in queries.queries()[name](spark, SF).collect():
        assert len(r) >= columns
        got.setdefault(r.doc_id, []).append(r)
    if name == "op1_simhash":
        prints = [test_simhash.brute_fingerprint(r.text) for r in rows]
        least = {}
        roots = test_simhash.brute_groups(prints)
        for r, root in zip(rows, roots, strict=True):
            least[root] = min(least.get(root, r.doc_id), r.doc_id)
        assert {i: (g.fingerprint, g.component_id) for i, (g,) in got.items()} == {r.doc_id: (f"{p:016x}", least[root]) for r, p, root in zip(rows, prints, roots, strict=True)}
        return
    ranks = tiktoken.load.load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    bpe = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows:
        text = r.text or ""
        mine = got[r.doc_id]
        if name == "op5_byte_bpe":
            ids = bpe.encode_ordinary(text)
            want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
            assert (mine[0].n_tokens, mine[0].ids_sha256, mine[0].decoded_sha256) == want
        elif name == "op7_token_counts":
            n = len(whole.encode(text, add_special_tokens=False).ids)
            assert (mine[0].n_bytes, mine[0].n_tokens, mine[0].over_limit) == (len(text.encode()), n, n > 512)
        elif name == "op10_packing":
            ids = [*whole.encode(text, add_special_tokens=False).ids, 2]
            for p in sorted(mine, key=lambda p: p.piece):
                assert p.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[p.start : p.start + p.length]))
            assert sum(p.length for p in mine) == len(ids)
        else:
            words = re.findall(r"[^\x20\x09-\x0D]+", text)
            windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
            inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
            seen, dup = set(), 0
            for line in text.split("\n"):
                if re.search(r"[^\x20\x09-\x0D]", line):
                    dup += line in seen
                    seen.add(line)
            want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside))
            assert (mine[0].n_words, mine[0].word_chars, mine[0].n_symbols, mine[0].n_dup_lines, mine[0].n_repeat_words) == want
            failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
            assert mine[0].base_failed == failed and not (failed and mine[0].kept)
