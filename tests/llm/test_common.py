import pyarrow as pa
import pytest
from pyarrow import fs

from millrace.llm import bpe, common, repetition, token_counts


def test_bytes_that_are_not_utf8_are_replaced():
    bad = pa.Array.from_buffers(pa.string(), 3, pa.array([b"abc\xff", b"fine", b"\xc3"], pa.binary()).buffers())
    assert common.valid(bad).to_pylist() == ["abc\ufffd", "fine", "\ufffd"]
    good = pa.array(["a", None, "ä"])
    assert common.valid(good) is good
    assert common.decoded(bad) == ["abc\ufffd", "fine", "\ufffd"] and common.decoded(good) == ["a", "", "ä"]


def test_operators_take_bytes_that_are_not_utf8(spark, vocabulary):
    bad = spark.sql("SELECT 1L AS doc_id, cast(x'6f6e652074776f20ff207468726565' AS string) AS text UNION ALL SELECT 2L, 'one two \ufffd three'")
    for made in (repetition.judge(bad), bpe.digests(bad, vocabulary("byte_bpe_50k.tiktoken")), token_counts.counts(bad, vocabulary("byte_bpe_50k.json"), limit=512)):
        one, other = (r.asDict() for r in made.orderBy("doc_id").collect())
        same = {k for k in one if k not in ("doc_id", "n_bytes")}
        assert {k: one[k] for k in same} == {k: other[k] for k in same}


@pytest.mark.parametrize(("uri", "kind", "path"), [("file:///tmp/x", fs.LocalFileSystem, "/tmp/x"), ("file:/tmp/x", fs.LocalFileSystem, "/tmp/x"), ("dbfs:/a/b", fs.LocalFileSystem, "/dbfs/a/b"), ("/tmp/x", fs.LocalFileSystem, "/tmp/x"), ("s3a://bucket/a/b?region=eu-west-1", fs.S3FileSystem, "bucket/a/b")])
def test_addresses_of_hadoop_are_understood(uri, kind, path):
    where, at = common.file_system(uri)
    assert isinstance(where, kind) and at == path
