import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import unmarked_pages
from millrace.llm import html_content, labelled_pages
from millrace.llm.html_content import parse


@pytest.fixture(scope="module")
def model():
    return html_content.learn([(p, y, 1.0) for p, y in labelled_pages.labelled_pages()])


def test_parse_closes_what_is_open():
    page = parse("<ul><li>one<li>two <b>bold</b></ul><p>a<p>b &amp; c<div>d</div>e<br>f")
    assert [t for _, t in page.blocks] == ["one", "two bold", "a", "b & c", "d", "e", "f"]
    assert [t for _, t in parse("a < b <3 <!-- <p>no</p> --> &lt;i&gt;<script>if (a<b) '</p>'</script>x").blocks] == ["a < b <3 <i>", "x"]
    assert [t for _, t in parse("<table><tr><td>1<td>2<tr><td>3</table>").blocks] == ["1", "2", "3"]
    assert parse("").blocks == [] and parse("<p>").blocks == []


def test_messages_give_exact_marginals(model):
    random.seed(18)
    source = "<div><p>a few words here.</p><div class='menu'><a>x</a></div><section><p>more words, and more.</p><h2>t</h2></section></div>"
    page = parse(source)
    own = html_content.features(page) @ model.weights
    own[0] = -html_content.ROOT
    n, weight, total = len(own), np.zeros(len(own)), 0.0
    for labels in itertools.product((0, 1), repeat=n):
        w = math.exp(sum(o * y for o, y in zip(own, labels, strict=True))) * math.prod(model.pair[labels[page.parents[i]], labels[i]] for i in range(1, n))
        total += w
        weight += w * np.array(labels)
    assert np.allclose(model.marginals(page), weight / total, atol=1e-9)


def test_labelled_pages_are_learned(model):
    wrong = total = 0
    for page, labels in labelled_pages.labelled_pages():
        keep = model.marginals(page) >= 0.5
        wrong += sum(keep[b] != labels[b] for b, _ in page.blocks)
        total += len(page.blocks)
    assert wrong / total < 0.1


def test_broken_markup_does_no_harm(model):
    random.seed(19)
    pieces = ["<", "p", ">", "</p>", "<div class='", "'", '"', "<a href=x>", "</a>", "<!--", "-->", "<script>", "</script>", "&amp;", "&#x41;", "&", "<![", "<?", "text. ", "<li>", "<ul>", "</ul>", "<td>", "<br/>", "<svg/>", "</", "\x00", "<b>"]
    for _ in range(1500):
        model.extract("".join(random.choices(pieces, k=random.randrange(40))))
    model.extract("<div>" * 5000 + "x" + "</p>" * 5000 + '<a "' * 5000)


def test_extract(spark):
    article = "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title &eacute;</h1><p>First  paragraph\n here, with enough words to be one.</p><p>Second one.</p></article><footer>Imprint</footer></body></html>"
    rows = [(1, "u", article), (2, "u", None), (3, None, ""), (None, "u", article), (1, "u", article)] + [(i, "u", article) for i in range(10, 40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    fitted = html_content.fit(pages)
    got = html_content.extract(pages, fitted).collect()
    assert len(got) == len(rows)
    for r in got:
        want = "" if r.page_id in (2, 3) else "Title é\nFirst paragraph here, with enough words to be one.\nSecond one."
        assert (r.text, r.n_chars) == (want, len(want))
    assert html_content.extract(pages.limit(0), html_content.fit(pages.limit(0))).count() == 0


def main_text(source):
    page = parse(source)
    labels = html_content.self_labelled(page)
    return "\n".join(t for b, t in page.blocks if labels[b])


@pytest.fixture(scope="module")
def fitted(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return html_content.fit(pages.where("page_id % 2 = 0"))


def test_pages_without_an_article(fitted):
    hit = got = want = 0
    for source, text in unmarked_pages.PAGES:
        a, b = Counter(fitted.extract(source).split()), Counter(text.split())
        hit, got, want = hit + sum((a & b).values()), got + sum(a.values()), want + sum(b.values())
    assert hit / got > 0.95 and hit / want > 0.95


def test_comments_go_and_linked_paragraphs_stay(fitted):
    assert [fitted.extract(source) for source, _ in unmarked_pages.READERS] == [text for _, text in unmarked_pages.READERS]


def test_comments_made_of_the_articles_words_go(spark, fitted):
    sources = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("page_id % 2 = 1").collect()]
    wrong = total = 0
    for turn, source in enumerate(sources):
        page = parse(source)
        labels = html_content.self_labelled(page)
        for some in ((page, labels), (html_content.unmarked(page), labels), html_content.unwrapped(page, labels)):
            more, kept = html_content.commented(*some, turn + 1)
            assert kept.sum() == some[1].sum() and len(kept) == len(more.tags)
            found = fitted.marginals(more) >= 0.5
            wrong += any(found[b] != kept[b] for b, _ in more.blocks)
            total += 1
    assert wrong < 0.05 * total


def test_the_tables_pages_with_and_without_their_mark(spark, fitted):
    sources = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("page_id % 2 = 1").collect()]
    wants = list(map(main_text, sources))
    assert [fitted.extract(s) for s in sources] == wants
    for stripped in ([re.sub("(</?)article", r"\1div", s) for s in sources], [re.sub("</?article>", "", s) for s in sources]):
        assert sum(fitted.extract(s) == w for s, w in zip(stripped, wants, strict=True)) > 0.9 * len(sources)


def test_unwrapped_pages_have_the_same_text_and_labels():
    page = parse("<body><nav>x</nav><article>a<p>b</p><section><p>c</p></section></article><p>d</p></body>")
    labels = html_content.self_labelled(page)
    bare, kept = html_content.unwrapped(page, labels)
    assert "article" not in bare.tags and [t for _, t in bare.blocks] == [t for _, t in page.blocks]
    assert bare.parents == parse("<body><nav>x</nav>a<p>b</p><section><p>c</p></section><p>d</p></body>").parents
    assert [kept[b] for b, _ in bare.blocks] == [0, 0, 1, 1, 0]
