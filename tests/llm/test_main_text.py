"""Texts of given and hand-made pages, and the cut against all labellings."""

import html
import itertools
import random
import re
import time

import numpy as np
import pytest

from patronage.llm import main_text as m

PAGES = "page_id bigint, url string, html string"


def plain_article(page):
    """The given pages: what stands in <article>, cut at its paragraphs."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks)
    return "\n\n".join(t for t in texts if t)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r["page_id"]: plain_article(r["html"]) for r in pages.collect()}
    got = m.extract_main_text(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


LONG = "A sentence of the article, long enough to look like prose, follows here. It ends with a mark. " * 3


@pytest.mark.parametrize(
    "page, text",
    [
        ("<main><p>one &amp; two&nbsp;three &#x41;&lt;b&gt;<p>four<br>five</main>", "one & two three A<b>\n\nfour five"),
        ("<header>top</header><article><header><h1>T</h1></header><p>x</p><aside>more</aside><p>y</p></article>", "T\n\nx\n\ny"),
        ("<article><p>x</p><section id=comments><p>reader</p></section><div class='share-box'>s</div></article>", "x"),
        ("<article><p>a</p><form><p>mail</p></form><p>b</p><script>if (a</p>b) '</article>'</script><p>c</article>", "a\n\nb\n\nc"),
        ("<article><ul><li>i<li>j</ul><table><tr><td>k<td>l</table><pre>m\n  n</pre></article>", "i\n\nj\n\nk\n\nl\n\nm n"),
        ("<article><p hidden>h</p><p>in<b>li</b>ne <i>x</i></article><div class=cookie-notice>c</div>", "inline x"),
        (f"<nav><a href=1>Home</a> <a href=2>News</a></nav><div><p>{LONG}</p><p>{LONG}</p></div><footer>© x</footer>", f"{LONG.strip()}\n\n{LONG.strip()}"),
        ("", ""),
        (None, ""),
        ("a < b", None),
        ("<article><p>open <b", None),
        ("<p <p <p \" ' <", None),
        ("<!-- never closed <article>x</article>", ""),
        ("<script>never closed", ""),
        ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
    ],
)
def test_hand_made_pages(page, text):
    blocks = m.page_blocks(page or "")
    trained = m.fit(*_sample())
    got = "\n\n".join(b.text for b, true in zip(blocks, m.label_blocks(blocks, trained)) if true)
    assert text is None or got == text


def _sample():
    content = [m.Block(LONG * k, 1, (0,), 0, False) for k in (1, 2, 3)] + [m.Block("Short one.", 1, (0,), 0, False)]
    other = [m.Block(t, -1, (0,), len(t) * k, False) for t in ("Home", "About us", "© 2020 all | rights") for k in (0, 1)]
    return m.measure(content + other), np.array([1.0] * len(content) + [0.0] * len(other))


def test_cut_is_the_cheapest_labelling():
    pick = random.Random(6)
    for _ in range(300):
        n = pick.randrange(1, 9)
        gain = [pick.randrange(-9, 10) for _ in range(n)]
        edges = [(i, j, pick.randrange(1, 9)) for i in range(n) for j in range(i + 1, n) if pick.random() < 0.5]

        def cost(label):
            return -sum(g for g, t in zip(gain, label) if t) + sum(w for i, j, w in edges if label[i] != label[j])

        every = {label: cost(label) for label in itertools.product([False, True], repeat=n)}
        cheapest = [label for label, c in every.items() if c == min(every.values())]
        assert tuple(m.minimum_cut(gain, edges)) == min(cheapest, key=sum)


def test_rows(spark):
    rows = [(1, "u", "<article><p>x</p></article>"), (1, "u", "<article><p>x</p></article>"), (None, None, None), (2, "v", "")]
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], PAGES + ", text string, n_chars bigint")
    got = sorted((str(r["page_id"]), str(r["url"]), r["text"], r["n_chars"]) for r in m.extract_main_text(frame).collect())
    assert got == [("1", "u", "x", 1), ("1", "u", "x", 1), ("2", "v", "", 0), ("None", "None", "", 0)]
    assert m.extract_main_text(spark.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article><p>a</p><svg class=i /><p>b</p><iframe src='x'/><p>c</p></article>", "a\n\nb\n\nc"),
        ("<article><p>a</p><button>Ok<p>b</p><object data=x><p>c</p></article><p>d <svg><path/></p>", "a\n\nOk\n\nb\n\nc"),
        ("<article><object><object><p>x</p></object><p>y</p></object><p>a</p><iframe src=1><p>b</p><iframe src=2></iframe></article>", "a\n\nb"),
        ("<article><div><canvas></div><p>a</p><textarea><p>b</p><video><p>no</p></video>in<button>x</button>line</article></canvas>", "a\n\nb\n\nin line"),
    ],
)
def test_elements_without_an_end_lose_nothing(page, text):
    trained = m.fit(*_sample())
    blocks = m.page_blocks(page)
    assert "\n\n".join(b.text for b, true in zip(blocks, m.label_blocks(blocks, trained)) if true) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<div class='right-sidebar page'><main><p>a</p></main></div>", "a"),
        ("<div class='widget'><div id=menu><article><p>a</p><div class=comments><article><p>no</p></article></div></article></div></div>", "a"),
        (f"<div class='has-sidebar no-header'><p>{LONG}</p></div>", LONG.strip()),
        (f"<div id=with-menu class=widget><p>{LONG}</p><p>{LONG}</p></div><div class=widget><p>Home</p></div>", f"{LONG.strip()}\n\n{LONG.strip()}"),
        ("<nav><article><p>no</p></article></nav><div hidden><main><p>no</p></main></div>", ""),
    ],
)
def test_names_of_wrappers_do_not_decide_alone(page, text):
    trained = m.fit(*_sample())
    blocks = m.page_blocks(page)
    assert "\n\n".join(b.text for b, true in zip(blocks, m.label_blocks(blocks, trained)) if true) == text


PROSE = "I liked this a lot, and my friends did as well. It is a pity that it ends so soon, though! " * 3


@pytest.mark.parametrize("name", ["comments", "comment-list", "cookie-notice", "sponsored ad", "newsletter", "social share", "related"])
@pytest.mark.parametrize("frame", ["<div class='{0}'>{1}</div>", "<section id='{0}'>{1}</section>", "<div class='{0}'><article class=comment>{1}</article></div>"])
def test_prose_of_readers_and_adverts_stays_outside(name, frame):
    trained = m.fit(*_sample())
    part = frame.format(name, f"<p>{PROSE}</p><p>{PROSE}</p>")
    for page in (f"<article><h1>T</h1><p>{LONG}</p>{part}<p>{LONG}</p></article>", f"<article><h1>T</h1><p>{LONG}</p><p>{LONG}</p></article>{part}"):
        blocks = m.page_blocks(page)
        got = [b.text for b, true in zip(blocks, m.label_blocks(blocks, trained)) if true]
        assert got == ["T", LONG.strip(), LONG.strip()]


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='social page'><main><p>{LONG}</p></main></div>", LONG.strip()),
        (f"<div id=share-page><h1>{LONG}</h1><p>{LONG}</p><div class=share>Send</div></div>", f"{LONG.strip()}\n\n{LONG.strip()}"),
        (f"<article><p>x</p><a title=\"t>link</a><p>{LONG}</p></article>", f"x\n\nlink\n\n{LONG.strip()}"),
        ("<article><p title='a > b'>x</p><p data-x=\"<b>\">y</p></article>", "x\n\ny"),
        ("<article><!DOCTYPE x><p>1</p><!-- <p>2</p> --><p>3 <! 4", "1\n\n3 <! 4"),
    ],
)
def test_wrappers_and_quotes(page, text):
    trained = m.fit(*_sample())
    blocks = m.page_blocks(page)
    assert "\n\n".join(b.text for b, true in zip(blocks, m.label_blocks(blocks, trained)) if true) == text


def test_digits_count_over_the_whole_block():
    blocks = m.page_blocks(f"<p>{'a' * 300}{'1' * 300}</p>")
    assert m.measure(blocks)[0][6] == 0.5


@pytest.mark.parametrize("piece", ["<div>a", "<div>", "<a \"", "<a title=\"x>b ", "<p>", "<ul><li>a", "<!-- ", "<b x='", "<td>a", "<div class=comments>a", "<button>"])
def test_long_broken_pages_take_little_time(piece):
    start = time.process_time()
    blocks = m.page_blocks("<article>" + piece * (1_000_000 // len(piece)))
    m.label_blocks(blocks, m.fit(*_sample()))
    assert time.process_time() - start < 20
