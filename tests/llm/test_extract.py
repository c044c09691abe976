import html as entities
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from bureauframe.llm import extract
from bureauframe.llm.common import table

SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
     T.StructField("html", T.StringType()), T.StructField("text", T.StringType()),
     T.StructField("host", T.StringType()), T.StructField("row", T.StringType())]
)

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=/x>Menu</a></ul></nav><div class="cookie-notice">We use</div>
<div id=side class="sideBar"><p>Aside text</div><article class="post"><header><h1>Head&amp;line</h1></header>
<p>First <b>bo</b>ld<br>line<p>Second &lt;p&gt; a&nbsp;b &am<script>var t="</p>";</script><!-- no <p> -->
<div class='ad'>Buy</div><aside>Look</aside><form>Name <input name=a></form><p data-x="a>b">Third</p>
<section class="comments"><p>I disagree</section></article><footer>&copy; us</footer></body></html>"""


def test_roles():
    found = extract.blocks(PAGE)
    assert [t for main, t in found if main] == ["Head&line", "First bold", "line", "Second <p> a b &am", "Third"]
    assert [t for main, t in found if not main] == []
    assert extract.blocks("") == [] and extract.blocks("<p") == [] and extract.blocks("a < b") == [(False, "a < b")]
    assert extract.blocks("<div>x<p>y</div>z") == [(False, "x"), (False, "y"), (False, "z")]


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_and_cover(seed):
    rng = random.Random(seed)
    tokens = np.array([rng.randrange(3) for _ in range(rng.randint(1, 60))])
    assert extract.suffix_array(tokens).tolist() == sorted(range(len(tokens)), key=lambda i: tokens[i:].tolist())
    shared = [str(i) for i in range(10)]
    pages = [[[rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(3)] for _ in range(9)]
    for page in pages[:4]:
        page[1][len(page[1]) // 2 : len(page[1]) // 2] = shared
    got = extract.covered(pages, 5, 3)

    def common(run, whole):
        fits = (lambda b, j: b == run) if whole else (lambda b, j: b[j : j + 5] == run)
        return sum(any(fits(b, j) for b in p for j in range(len(b) + 1)) for p in pages) >= 3

    for page, hits in zip(pages, got, strict=True):
        for block, hit in zip(page, hits, strict=True):
            want = [len(block) < 5 and common(block, True)] * len(block)
            for i in range(len(block) - 4):
                if common(block[i : i + 5], False):
                    want[i : i + 5] = [True] * 5
            assert hit.tolist() == want


def plain(page):
    """The article between its tags, for pages of the test tables."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    pieces = re.split(r"</?(?:p|br|h1)>", body)
    pieces = [" ".join(entities.unescape(re.sub(r"</?b>", "", x)).split()) for x in pieces]
    return " ".join(x for x in pieces if x)


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_tables_against_plain_version(spark, size):
    pages = table(spark, f"/root/testdata/sf{size}", "pages")
    rows = {r.page_id: r for r in pages.collect()}
    got = extract.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == plain(rows[r.page_id].html) and r.url == rows[r.page_id].url and r.n_chars == len(r.text)


def test_hosts_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(extract, "CHUNK_PAGES", 20)
    base = "all rights of this site are reserved by its many owners"
    rows = [(i, f"http://h.example/{i}", f"<div>story number {i} here</div><div>{base}</div>") for i in range(90)]
    rows += [(900, "http://one.example/", f"<div>{base}</div>"), (901, None, None), (None, "", ""), (5, "no url", "<nav>x</nav>"),
             (902, "http://h.example/long", "<article>" + "<p>w &amp; x</p>" * 50_000)]
    rows += [rows[0], rows[0]]
    got = extract.extract(spark.createDataFrame([(*r, "t", "h", "r") for r in rows], SCHEMA)).collect()
    text = {}
    for r in got:
        text.setdefault((r.page_id, r.url), []).append(r.text)
    assert len(got) == len(rows) and text[(1, "http://h.example/1")] == ["story number 1 here"]
    assert text[(900, "http://one.example/")] == [base] and text[(901, None)] == [""] and text[(None, "")] == [""]
    assert text[(902, "http://h.example/long")][0].startswith("w & x w & x") and text[(5, "no url")] == [""]
    assert len(text[(0, "http://h.example/0")]) == 3
    assert extract.extract(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chunks_of_a_host_count_pages_together(spark, monkeypatch):
    rng = random.Random(8)
    notice = "this notice stands on just three of the pages"
    rows = []
    for i in range(24):
        own = " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(12))
        extra = f"<div>{notice}</div><div>see also</div>" if i in (2, 11, 19) else "<div>only two</div>" if i in (5, 6) else ""
        rows.append((i, f"http://h.example/{i}", f"<div>{own}</div>{extra}", "t", "h", "r"))
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = {r.page_id: r.text for r in extract.extract(pages).collect()}
    assert all(len(want[i].split()) == (14 if i in (5, 6) else 12) for i in range(24))
    monkeypatch.setattr(extract, "CHUNK_PAGES", 1)
    assert {r.page_id: r.text for r in extract.extract(pages).collect()} == want


def test_what_class_and_attributes_say():
    named = '<article class="promotion-news"><p>The town promotes its <i>mayor</i></p></article><div>Loose</div>'
    assert extract.blocks(named) == [(extract.DOUBT, "The town promotes its mayor"), (extract.LOOSE, "Loose")]
    two = "<article><p>Story</p></article><article class='related'>Other story</article>"
    assert [t for level, t in extract.blocks(two) if level == extract.MARKED] == ["Story"]
    inner = """<article><p data-class="ad" style="x: hidden">Kept</p><section class="reader-responses"><p>Not mine</section>
    <article class="comment">Nor this</article><div itemprop=comment>Nor that</div><p hidden>Unseen</p>
    <p hidden="until-found">Found</p><p aria-hidden="true">Sign</p></article>"""
    assert [t for _, t in extract.blocks(inner)] == ["Kept", "Found", "Sign"]


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))


@pytest.mark.parametrize("chunk", [512, 4])
def test_unmarked_pages_keep_copies_and_phrases(spark, monkeypatch, chunk):
    monkeypatch.setattr(extract, "CHUNK_PAGES", chunk)
    rng = random.Random(4)
    menu, notice, phrase = words(rng, 9), words(rng, 40), words(rng, 7)
    shell = f"<div>{menu}</div><div>%s</div><div>{notice}</div>"
    own = {i: words(rng, 30) for i in range(20)}
    rows = [(i, f"http://h.example/{i}", shell % own[i]) for i in own]
    for i in range(20, 24):  # sentences that share a phrase
        own[i] = f"{words(rng, 6)} {phrase} {words(rng, 6)}"
        rows.append((i, f"http://h.example/{i}", shell % own[i]))
    article = words(rng, 60)
    for i in range(24, 28):  # an article under several addresses, each with a line of its own
        line = words(rng, 4)
        own[i] = f"{article} {line}"
        rows.append((i, f"http://h.example/{i}", shell % f"{article}</div><div>{line}"))
    for i in range(28, 34):  # one page, six rows
        own[i] = own[0] + " again"
        rows.append((i, "http://h.example/again", shell % own[i].replace(" again", "</div><div>again")))
    alone = words(rng, 12)
    rows += [(i, "http://copies.example/x", f"<div>{alone}</div>") for i in range(40, 43)]
    own.update(dict.fromkeys(range(40, 43), alone))
    got = extract.extract(spark.createDataFrame([(*r, "t", "h", "r") for r in rows], SCHEMA)).collect()
    assert {r.page_id: r.text for r in got} == own and len(got) == len(rows)


def test_common_prefixes_and_their_intervals():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 40, 300):
        for kinds in (1, 2, 5):
            tokens = rng.integers(0, kinds, n)
            order = extract.suffix_array(tokens)
            lists = [tokens[i:].tolist() for i in order]
            want = [0] * min(n, 1) + [len(os.path.commonprefix([a, b])) for a, b in zip(lists, lists[1:])]
            assert extract.common_prefixes(tokens, order).tolist() == want
    pages = [[["a", "b"] * 6, ["c", "d", "e"]], [["b", "a", "b", "a", "x"]], [["d", "a", "b", "a"], []]]
    whole, group, on, texts, short = extract._runs(pages, 3)
    found = {}
    for at, g in zip(whole.tolist(), group.tolist()):
        found.setdefault(g, set()).add(tuple(texts[at : at + 3]))
    assert all(len(kinds) == 1 for kinds in found.values()) and len(found) == len(on)
    where = {}
    for i, page in enumerate(pages):
        for block in page:
            for k in range(len(block) - 2):
                where.setdefault(tuple(block[k : k + 3]), set()).add(i)
    assert {kinds.pop(): on[g] for g, kinds in found.items()} == {k: len(v) for k, v in where.items()}
    assert short == {(): {2}}


@pytest.mark.parametrize("chunk", [512, 4])
def test_marked_pages_are_in_the_suffix_array(spark, monkeypatch, chunk):
    monkeypatch.setattr(extract, "CHUNK_PAGES", chunk)
    rng = random.Random(6)
    menu, notice, quote = words(rng, 9), words(rng, 12), words(rng, 12)
    own = {i: words(rng, 30) for i in range(24)}
    rows = []
    for i in range(24):
        if i < 12:  # half of the pages have the notice in their article; a quote is on some
            block = f"<p>{own[i]}</p><p>{notice}</p><p>by me</p>" + f"<p>{quote}</p>" * (i < 5)
            page = f"<div>{menu} {words(rng, 2)}</div><article>{block}</article>"
            own[i] += f" {quote}" * (i < 5)
        elif i < 14:  # pages without an article: their menu stands beside the articles too
            page = f"<div>{menu}</div><div>{own[i]}</div>"
        else:
            page = f"<article><p>{own[i]}</p></article>"
        rows.append((i, f"http://h.example/{i}", page))
    rows += [(50 + i, f"http://few.example/{i}", f"<article><p>{words(rng, 20)}</p><p>{notice}</p></article>") for i in range(6)]
    rows += rows[:2]
    got = extract.extract(spark.createDataFrame([(*r, "t", "h", "r") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows) and {r.page_id: r.text for r in got if r.page_id < 50} == own
    assert all(notice in r.text for r in got if r.page_id >= 50)
