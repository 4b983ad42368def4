import random

import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.llm import language_id, queries
from millrace.llm.common import fold

WORDS = {
    "en": "the of and to in that was with for on from have this which not are they one were there been would their".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden".split(),
    "fr": "le la les et des une est dans que pour qui sur pas au par avec plus sont mais ou leur nous cette aux".split(),
}


@pytest.fixture(scope="module")
def world(spark):
    random.seed(17)
    rows = [(i, " ".join(random.choices(WORDS[lang], k=random.randrange(15, 120))), lang) for i in range(450) for lang in [random.choice([*WORDS])]]
    return spark.createDataFrame([*rows, (9001, "no language", None), (9002, None, "en"), (9003, "12 34", "de")], "doc_id long, text string, lang string").cache()


def test_accuracy_on_held_out_texts(world):
    learned = language_id.fit(world.where("doc_id % 5 <> 0"))
    assert sorted(learned) == ["de", "en", "fr"]
    got = language_id.predict(world.where("doc_id % 5 = 0 and doc_id < 9000"), learned)
    assert got.where("lang_pred = lang").count() / got.count() > 0.97
    assert got.where("accepted").count() / got.count() > 0.95
    assert got.where("score < 0 or score > 1").count() == 0


def test_whole_texts_count(world):
    learned = language_id.fit(world)
    sizer = language_id.Sizer(learned)
    text = " ".join(WORDS["en"] * 30) + " " + " ".join(WORDS["fr"] * 300)
    assert sizer.predict(text, 0.0)[0] == "fr"


def test_rejection_and_no_letters(docs, world):
    learned = language_id.fit(world)
    clashing = docs.withColumn("lang_pred", F.lit("old"))
    got = {r.doc_id: r for r in language_id.predict(clashing, learned).collect() if r.doc_id is not None}
    for i in (2, 3, 4):
        assert (got[i].lang_pred, got[i].score, got[i].accepted) == ("und", 0.0, False)
    assert all(r.lang_pred in ("de", "en", "fr", "und") for r in got.values())
    sizer = language_id.Sizer({"a": b"same", "b": b"same"})
    assert sizer.predict("anything at all", 0.001)[::2] == ("a", False)


def test_nothing_learned(docs, spark):
    learned = language_id.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in language_id.predict(docs, learned).collect()} == {"und"}
    only = language_id.predict(docs, {"en": b"one two three"})
    assert only.where("lang_pred = 'en' and score = 1.0 and accepted").count() > 0
    assert language_id.predict(docs.limit(0), {"en": b"x"}).count() == 0


def brute_language(text, learned):
    """Each 2 KiB block compressed for itself with each language's content before it; the smallest sum, the first name of equals."""
    if not learned or text is None or not any(c.isalpha() for c in text):
        return "und"
    raw, sums = text.lower().encode("utf-8", "replace"), {}
    for name, content in learned.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        tool = lambda: zstandard.ZstdCompressor(level=5, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)  # noqa: E731, B023
        d.precompute_compress(level=5)
        sums[name] = sum(len(tool().compress(raw[i : i + 2048])) for i in range(0, len(raw), 2048))
    return min(sorted(sums), key=sums.get)


def test_the_query_is_that_of_brute_force_and_right_on_held_out_texts(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    learned = language_id.fit(language_id.training(docs, fold("doc_id", 5) == 0))
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    got = queries.op8_language_id(spark, d).collect()
    assert len(got) == len(texts)
    assert all(r.lang_pred == brute_language(texts[r.doc_id][0], learned) for r in got)
    held = [r for r in got if r.held_out and texts[r.doc_id][1] is not None]
    assert sum(r.lang_pred == texts[r.doc_id][1] for r in held) >= 0.9 * len(held) > 0


def test_all_languages_are_learned(world, spark):
    assert sorted(language_id.fit(world.where("lang <> 'fr' or doc_id < 20"))) == ["de", "en", "fr"]
    assert all(len(content) <= 1000 for content in language_id.fit(world, dict_bytes=1000).values())
    many = spark.range(3000).selectExpr("id AS doc_id", "concat('l', id % 300) AS lang", "concat(repeat(concat('x', id % 300 * 7919, ' '), 12), id) AS text")
    learned = language_id.fit(many, all_windows=600)
    assert len(learned) == 300 and all(0 < len(content.split(b"\n")) < 12 for content in learned.values())
    got = language_id.predict(many.where("doc_id < 300"), learned).collect()
    assert sum(r.lang_pred == r.lang for r in got) > 250
    with pytest.raises(ValueError, match="more than 299"):
        language_id.fit(many, all_windows=299)


def test_an_id_on_many_rows_gives_no_more_windows(spark):
    one = spark.range(4000).selectExpr("7L AS doc_id", "'en' AS lang", "concat('text number ', id % 2000) AS text")
    assert len(language_id.fit(one, windows=50)["en"].split(b"\n")) < 100
    same = spark.range(4000).selectExpr("7L AS doc_id", "'en' AS lang", "'one text' AS text")
    assert language_id.fit(same) == {"en": b"one text"}


def test_bytes_that_are_not_utf8(spark, world):
    bad = spark.sql("SELECT 1L AS doc_id, cast(x'616263ff20646566' AS string) AS text")
    assert language_id.predict(bad, language_id.fit(world)).count() == 1
