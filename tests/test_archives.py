import gzip
import hashlib
import json

from pyspark.sql import functions as F

from millrace.sources import archives


def test_bytes_depend_on_the_rows_alone(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("ä "), F.col("id").cast("string"))).alias("name"))
    whole = []
    for i, dealt in enumerate((df.repartition(7), df.coalesce(1), df.orderBy(F.desc("name")))):
        told = archives.export(dealt, ["k"], f"{tmp_path}/{i}.gz", rows=64)
        with open(f"{tmp_path}/{i}.gz", "rb") as f:
            whole.append(f.read())
        assert told.count() == 16
    assert whole[0] == whole[1] == whole[2]
    lines = gzip.decompress(whole[0]).decode().splitlines()
    assert [json.loads(x)["k"] for x in lines] == list(range(1000)) and lines[0] == '{"k":0,"name":null}'
    assert whole[0][4:8] == b"\0\0\0\0" and not whole[0][3]  # neither a time nor a name in the header
    for r in told.orderBy("member").collect():
        text = "".join(x + "\n" for x in lines[r.member * 64 : r.member * 64 + r.rows]).encode()
        assert (r.bytes, r.sha256) == (len(text), hashlib.sha256(text).hexdigest())
        assert gzip.decompress(whole[0][r["at"] :]).startswith(text)


def test_places_follow_the_keys(spark):
    df = spark.createDataFrame([(3, "x"), (None, "n"), (1, "b"), (1, "a"), (1, "a")], "k int, v string").repartition(3)
    got = {r["at"]: json.loads(r["json"]) for r in archives.numbered(df, ["k"]).collect()}
    assert [got[i]["v"] for i in range(5)] == ["n", "a", "a", "b", "x"]


def test_an_empty_table(spark, tmp_path):
    assert archives.export(spark.range(0), ["id"], f"{tmp_path}/e.gz").count() == 0
    with open(f"{tmp_path}/e.gz", "rb") as f:
        assert gzip.decompress(f.read()) == b""
