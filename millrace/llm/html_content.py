"""Main text of web pages by a graphical model on the DOM tree.

Each box (an element that isn't inline) is a variable: content or not. A logistic potential of the box's own features
speaks for the box, a potential of two boxes for parent and child, and sum-product messages, up from the leaves and down
from the root, give every box's marginal. Text in boxes whose marginal is at least a half is the page's text. The
potentials are learned from labelled pages: a few written for the purpose (:mod:`millrace.llm.labelled_pages`) and a
bounded sample of pages that mark their article themselves. Each of these is learned from four times: as it is, with a
plain ``div`` for the article, with the article's boxes in the body itself, so that pages which mark nothing are judged by
what is in them, and one of the three with readers' comments made of the article's own words.

Defined cases: null or empty html gives empty text; markup that is cut off or badly nested is closed as browsers do where
that is simple (a paragraph ends where the next box begins, unknown end tags are skipped); a ``<`` that begins no tag is
text; ``br`` ends a block; no text is dropped or cut for its length; equal pages give equal texts.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages of the corpus that are looked at for training, on average at most, and their longest html.
SAMPLE_PAGES, SAMPLE_CHARS = 400, 50_000

#: Strength of the penalties on the weights of features and, for each labelled box, on the pair potentials.
RIDGE, COUPLING_RIDGE = 0.05, 0.0055

# Element names of the HTML standard, by what they mean for text.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = set("script style template textarea select datalist button svg iframe title head".split())
RAW = set("script style textarea title iframe template".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img math mi mn mo mrow ms mtext msup msub msubsup mfrac msqrt mroot mover munder font".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HOLDS = set("ul ol dl table html body div article section main".split())
#: Element names that are features, and words in class, id and role that are, by what they name.
TAGS = "html body main article section div p h1 h2 h3 h4 h5 h6 header footer nav aside form fieldset ul ol li dl dt dd table tr td th blockquote pre figure figcaption address details dialog menu".split()
WORDS = {
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar pager pagination tabs skip",
    "header": "header masthead banner branding logo",
    "footer": "footer foot bottom copyright legal colophon contentinfo",
    "side": "sidebar side aside rail widget complementary column related recommended popular trending more",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay toast",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner-ad",
    "form": "form search newsletter subscribe signup login contact",
    "comment": "comment comments reply replies discussion disqus respond review reviews",
    "share": "share social sharing follow tags meta byline",
    "content": "content article post entry story body text main page-content prose",
}
WORD_OF = {w: k for k, ws in WORDS.items() for w in ws.split()}

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?/](?![a-zA-Z])[^>]*(?:>|\Z)|<![^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
NAME_PARTS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
ENDS = (".", "!", "?", "…", ":", ";", "。")
#: Signs in a short text that it is about the site.
SITE = re.compile(
    r"©|\(c\)\s|copyright (?:©|\d|by)|rights reserved|^imprint\b|^sponsored\b|sponsored (?:by|content|post)|subscribe (?:to|now|for|today)|^subscribe\b"
    r"|privacy (?:policy|notice|settings)|cookie (?:policy|notice|settings)|(?:we|this site|website) (?:also )?uses? cookies|accept (?:all )?cookies",
    re.I,
)
#: Words of a text above which such signs mean nothing.
SITE_WORDS = 40
#: Words from which a linked text that ends as sentences do is one.
LINKED_WORDS = 4

#: Elements that are not content even inside an article.
NEVER = set("nav aside footer form header script style menu dialog".split())

#: Log odds against the root, which stands for the page as a whole.
ROOT = 12.0

FEATURES = ["bias", *(f"tag {t}" for t in TAGS), "tag other", *(f"named {w}" for w in WORDS), "hidden", "link share", "words", "sentences", "has text", "top", "deep", "site", "in mark", "siblings", "share", "linked sentence", "under comments", "under aside"]
PLACE = {f: i for i, f in enumerate(FEATURES)}


@dataclass
class Page:
    """Boxes in page order: tag, parent (-1 at the root), attributes; and blocks: (box, text)."""

    tags: list[str]
    parents: list[int]
    attributes: list[str]
    blocks: list[tuple[int, str]]
    linked: list[int]


def parse(source: str) -> Page:
    page = Page(["#root"], [-1], [""], [], [0])
    stack: list[tuple[str, int]] = [("#root", 0)]  # open elements, each with the box it lies in
    open_ = Counter()
    texts: list[str] = []
    at, unread, end = 0, 0, len(source)

    def flush() -> None:
        if texts:
            text = " ".join("".join(texts).split())
            texts.clear()
            if text:
                page.blocks.append((stack[-1][1], text))

    def close(upto: int) -> None:
        nonlocal unread
        while len(stack) > upto:
            name = stack[-1][0]
            if name not in INLINE:
                flush()
            stack.pop()
            open_[name] -= 1
            unread -= name in UNREAD

    def say(text: str) -> None:
        if text and not unread:
            text = html.unescape(text)
            texts.append(text)
            if open_["a"]:
                page.linked[stack[-1][1]] += len(text.strip())

    while at < end:
        less = source.find("<", at)
        if less < 0:
            say(source[at:])
            break
        say(source[at:less])
        m = TAG.match(source, less)
        if not m:
            say("<")
            at = less + 1
            continue
        at = m.end()
        closing, name, attributes = m[1], m[2] or m[4], m[3] or m[5] or ""
        if closing:
            closing = closing.lower()
            if closing == "br":
                flush()
            elif open_[closing] > 0:
                k = len(stack) - 1
                while stack[k][0] != closing:
                    k -= 1
                close(k)
            continue
        if not name:
            continue
        name = name.lower()
        if name in INLINE:
            if name in VOID:
                continue
            if name == "a" and open_["a"] > 0:
                k = len(stack) - 1
                while stack[k][0] != "a" and stack[k][0] in INLINE:
                    k -= 1
                if stack[k][0] == "a":
                    close(k)
            stack.append((name, stack[-1][1]))
            open_[name] += 1
            continue
        flush()
        if name in VOID:
            continue
        k = len(stack) - 1
        while stack[k][0] in INLINE:
            k -= 1
        if stack[k][0] == "p":
            close(k)
        if name in CLOSES:
            k = len(stack) - 1
            while stack[k][0] not in HOLDS and stack[k][0] not in CLOSES[name] and k:
                k -= 1
            if stack[k][0] in CLOSES[name]:
                while k > 1 and stack[k - 1][0] in CLOSES[name]:
                    k -= 1
                close(k)
        if name == "body" and open_["head"] > 0:
            k = len(stack) - 1
            while stack[k][0] != "head":
                k -= 1
            close(k)
        page.tags.append(name)
        page.parents.append(stack[-1][1])
        page.attributes.append(attributes)
        page.linked.append(0)
        if attributes.endswith("/") and name not in TAGS:
            continue
        stack.append((name, len(page.tags) - 1))
        open_[name] += 1
        unread += name in UNREAD
        if name in RAW:
            m = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            at = m.end() if m else end
            close(len(stack) - 1)
    close(1)
    flush()
    return page


def own_text(page: Page) -> list[str]:
    out = [""] * len(page.tags)
    for box, text in page.blocks:
        out[box] = f"{out[box]} {text}" if out[box] else text
    return out


def features(page: Page) -> np.ndarray:
    """A row of numbers for each box; pages that mark an article or main element and others have columns of their own."""
    n = len(page.tags)
    marked = [t in ("article", "main") for t in page.tags]
    any_mark = any(marked)
    both = np.zeros((n, 2 * len(FEATURES)))
    out = both[:, : len(FEATURES)] if any_mark else both[:, len(FEATURES) :]
    out[:, 0] = 1
    depth, texts, discussed, apart = [0] * n, own_text(page), [False] * n, [t in NEVER for t in page.tags]
    # words of text that isn't linked: of each box, of it and all below it, and of its parent's boxes together
    size = [(t.count(" ") + 1) * max(0.0, 1 - page.linked[i] / len(t)) if t else 0.0 for i, t in enumerate(texts)]
    below, beside = size[:], [0.0] * n
    for i in range(n - 1, 0, -1):
        below[page.parents[i]] += below[i]
        beside[page.parents[i]] += size[i]
    for i, (tag, attributes, text) in enumerate(zip(page.tags, page.attributes, texts, strict=True)):
        row = out[i]
        row[PLACE.get(f"tag {tag}", PLACE["tag other"])] = 1
        depth[i] = depth[page.parents[i]] + 1 if i else 0
        if attributes:
            for a in ATTRIBUTE.finditer(attributes):
                if a[1].lower() in ("class", "id", "role"):
                    for part in NAME_PARTS.findall((a[2] or a[3] or a[4] or "").lower()):
                        if part in WORD_OF:
                            row[PLACE[f"named {WORD_OF[part]}"]] = 1
            row[PLACE["hidden"]] = bool(HIDDEN.search(attributes))
        if text:
            words = text.count(" ") + 1
            row[PLACE["has text"]] = 1
            row[PLACE["link share"]] = min(1.0, page.linked[i] / len(text))
            row[PLACE["words"]] = math.log1p(words) / 5
            row[PLACE["sentences"]] = text.endswith(ENDS)
            row[PLACE["site"]] = words <= SITE_WORDS and bool(SITE.search(text))
            row[PLACE["linked sentence"]] = words >= LINKED_WORDS and text.endswith(ENDS) and 2 * page.linked[i] > len(text)
        if i:
            marked[i] = marked[i] or marked[page.parents[i]]
            row[PLACE["siblings"]] = math.log1p(beside[page.parents[i]]) / 5
        discussed[i] = bool(row[PLACE["named comment"]]) or (i > 0 and discussed[page.parents[i]])
        row[PLACE["under comments"]] = discussed[i]
        apart[i] = apart[i] or (i > 0 and apart[page.parents[i]])
        row[PLACE["under aside"]] = apart[i]
        row[PLACE["in mark"]] = marked[i]
        row[PLACE["share"]] = below[i] / below[0] if below[0] else 0.0
        row[PLACE["top"]] = depth[i] <= 2
        row[PLACE["deep"]] = min(depth[i], 12) / 12
    return both


@dataclass
class Model:
    weights: np.ndarray
    #: pair[parent label][child label]
    pair: np.ndarray

    def marginals(self, page: Page) -> np.ndarray:
        """Probability of each box to be content: messages go up to the root and down again."""
        own = (features(page) @ self.weights).tolist()
        (p00, p01), (p10, p11) = self.pair.tolist()
        own[0] = -ROOT
        n = len(own)
        below, up = own[:], [0.0] * n

        def ratio(x: float, a: float, b: float, c: float, d: float) -> float:
            """log (a + b e^x) / (c + d e^x)"""
            if x > 0:
                e = math.exp(-x)
                return math.log((a * e + b) / (c * e + d))
            e = math.exp(x)
            return math.log((a + b * e) / (c + d * e))

        for i in range(n - 1, 0, -1):
            up[i] = ratio(below[i], p10, p11, p00, p01)
            below[page.parents[i]] += up[i]
        total = below[:]
        for i in range(1, n):
            total[i] += ratio(total[page.parents[i]] - up[i], p01, p11, p00, p10)
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))

    def extract(self, source: str | None) -> str:
        if not source:
            return ""
        page = parse(source)
        keep = self.marginals(page) >= 0.5
        return "\n".join(text for box, text in page.blocks if keep[box])


def labels_of(page: Page, main: list[bool], other: list[bool]) -> np.ndarray:
    """1 for boxes in a main box, unless a box in between is marked as other."""
    out = np.zeros(len(page.tags), np.int64)
    for i in range(len(out)):
        above = out[page.parents[i]] if i else 0
        out[i] = 0 if other[i] else 1 if main[i] else above
    return out


def self_labelled(page: Page) -> np.ndarray | None:
    """Labels of a page that marks one article; None for other pages."""
    marks = [t == "article" for t in page.tags]
    if sum(marks) != 1:
        return None
    return labels_of(page, marks, [t in NEVER for t in page.tags])


def unmarked(page: Page) -> Page:
    """The page with plain boxes in place of articles."""
    return replace(page, tags=["div" if t == "article" else t for t in page.tags], attributes=["" if t == "article" else a for t, a in zip(page.tags, page.attributes, strict=True)])


def unwrapped(page: Page, labels: np.ndarray) -> tuple[Page, np.ndarray]:
    """The page and its labels with articles taken out and their boxes and text in what held them."""
    gone = [t == "article" for t in page.tags]
    place, up = list(accumulate((not g for g in gone), initial=0)), list(range(len(gone)))
    for i in range(1, len(gone)):
        if gone[i]:
            up[i] = up[page.parents[i]]
    stays = [i for i, g in enumerate(gone) if not g]
    linked = [0] * len(stays)
    for i, n in enumerate(page.linked):
        linked[place[up[i]]] += n
    parents = [place[up[page.parents[i]]] if i else -1 for i in stays]
    blocks = [(place[up[b]], t) for b, t in page.blocks]
    return Page([page.tags[i] for i in stays], parents, [page.attributes[i] for i in stays], blocks, linked), labels[stays]


#: How comments may be named, on their list, each of them, and its author; and what their heading says.
COMMENTED = (
    (" id='comments'", " class='comment'", " class='comment-author'", "{n} comments"), (" class='comments'", "", "", "Comments"), (" class='discussion'", " class='reply'", "", "{n} replies"),
    (" id='respond'", " class='comment-body'", " class='author'", "What readers say"), (" class='comment-list'", " id='comment-{n}'", "", "{n} thoughts on this"),
)


def commented(page: Page, labels: np.ndarray, turn: int) -> tuple[Page, np.ndarray]:
    """The page and its labels with readers' comments after the article, beside it or at the end of the body.

    Their words are the article's own, so that nothing but place and names tells them apart.
    """
    texts = [t for b, t in page.blocks if labels[b]][:4]
    main = next((i for i in range(len(labels)) if labels[i]), 0)
    body = next((i for i, t in enumerate(page.tags) if t == "body"), 0)
    made = Page(*map(list, (page.tags, page.parents, page.attributes, page.blocks, page.linked)))
    whole, one, author, heading = COMMENTED[turn % len(COMMENTED)]

    def box(tag: str, parent: int, attributes: str = "", text: str = "") -> int:
        made.tags.append(tag)
        made.parents.append(parent)
        made.attributes.append(attributes)
        made.linked.append(0)
        if text:
            made.blocks.append((len(made.tags) - 1, text))
        return len(made.tags) - 1

    around = box(("section", "div", "ol")[turn % 3], page.parents[main] if turn % 2 and main else body, whole)
    box(("h2", "h3")[turn % 2], around, "", heading.format(n=len(texts)))
    for n, text in enumerate(texts):
        each = box(("div", "li")[turn % 3 == 2], around, one.format(n=n))
        if author:
            box("div", each, author, "Ann")
        box("p", each, "", text)
        if n % 2:  # a reply inside
            box("p", box("div", each, one.format(n=f"{n}-1")), "", text)
    return made, np.concatenate([labels, np.zeros(len(made.tags) - len(labels), np.int64)])


def couplings(page: Page, labels: np.ndarray) -> np.ndarray:
    """How each pair potential (parent label, child label: 00, 01, 10, 11) moves each box's log odds, its relatives' labels given."""
    out = np.zeros((len(labels), 4))
    for i in range(1, len(labels)):
        p = page.parents[i]
        out[i, 2 * labels[p] + 1] += 1
        out[i, 2 * labels[p]] -= 1
        out[p, 2 + labels[i]] += 1
        out[p, labels[i]] -= 1
    return out


def learn(pages: list[tuple[Page, np.ndarray, float]], ridge: float = RIDGE, coupling_ridge: float = COUPLING_RIDGE, steps: int = 60) -> Model:
    """Potentials of greatest pseudo-likelihood for labelled pages (page, labels, weight): each box given its features and
    the labels of its parent and children."""
    x = np.concatenate([np.hstack([features(p), couplings(p, labels)]) for p, labels, _ in pages])
    y = np.concatenate([labels for _, labels, _ in pages]).astype(float)
    c = np.concatenate([np.full(len(labels), w) for _, labels, w in pages])
    weights = np.zeros(x.shape[1])
    bound = np.full(len(weights), ridge)
    bound[-4:] = coupling_ridge * c.sum()  # else the labels of relatives alone explain a box, and its features count for nothing
    for _ in range(steps):  # Newton steps of ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (c * (p - y)) + bound * weights
        curve = (x * (c * p * (1 - p))[:, None]).T @ x + np.diag(bound)
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return Model(weights[:-4], np.exp(weights[-4:]).reshape(2, 2))


def fit(pages: DataFrame, key: str = "page_id", source: str = "html", *, sample: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> Model:
    """Learn from the written labelled pages and about ``sample`` pages of the table, chosen by a hash of their id, of at most ``chars`` characters."""
    from millrace.llm.labelled_pages import labelled_pages

    span = 1 << 31
    usable = pages.where(F.col(key).isNotNull() & (F.length(source) <= chars))
    n = usable.count()
    share = min(1.0, sample / max(n, 1))
    chosen = usable.where(F.pmod(F.xxhash64(key), F.lit(span)) < F.lit(int(share * span))).select(F.xxhash64(key).alias("h"), F.col(source).alias("s")).orderBy("h", "s").limit(2 * sample).collect()
    found = []
    for row in sorted(chosen, key=lambda r: (r["h"], r["s"])):
        page = parse(row["s"])
        labels = self_labelled(page)
        if labels is not None:
            kinds = [(page, labels), (unmarked(page), labels), unwrapped(page, labels)]
            turn = len(found) // 4
            found += [(p, y, 1 / 4) for p, y in (*kinds, commented(*kinds[turn % 3], turn))]
    written = labelled_pages()
    boxes = sum(len(p.tags) for p, _, _ in found) / 4
    weight = max(1.0, boxes / max(1, sum(len(p.tags) for p, _ in written)))
    return learn([*((p, y, weight) for p, y in written), *found])


def extract(pages: DataFrame, model: Model, source: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Text and its length for each page."""
    schema = T.StructType([*(pages.schema[k] for k in keep), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.extract(s.as_py()) for s in batch.column(source)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, keep), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=schema.names)

    return pages.select(*keep, source).mapInArrow(run, schema)
