import math
import random
from html import unescape

import numpy as np
import pytest
from helpers import sentence

from emporia.llm import html_paths as H

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header"><a href=/>Home</a> Site name</header>
<div id="cookieNotice">We use cookies. Accept all, please.</div><nav class=menu><ul><li><a href="/x">One</a><li><a href=y>Two</a></ul></nav>
<div class="sidebar"><p>About us, this is a text. Popular posts, and more.</p></div>%s<div class="comments"><p>Great article, I loved it.
Really, very much, thanks.</p></div><aside>Related: this, that.</aside><footer>(c) 2020 Foo, Inc. All rights.</footer></body></html>"""
BODY = """<h2>Heading here</h2><p>First para with, commas &amp; stuff. It is a <b>bold</b>word, and <a href="x">a link</a>. More&nbsp;text, yes.
<p>Second   para,\n is long enough too. With sentences. And <i>more</i>.<ul><li>item one<li>item two</ul><blockquote>Quote, it is.</blockquote>
<form><input name=a> Your name: <button>Send</button></form><script>if (a < b) { "</p>" }</script><p>Last.</p>"""
TEXT = ("Heading here First para with, commas & stuff. It is a boldword, and a link. More text, yes. Second para, is long enough too. "
        "With sentences. And more. item one item two Quote, it is. Last.")


@pytest.mark.parametrize("box", ["<article>%s</article>", '<div class="content">%s</div>', "<main><article class='post'>%s</article></main>"])
def test_article_in_several_layouts(box):
    assert H.main_text(PAGE % (box % BODY)) == TEXT


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain text, only. yes", "plain text, only. yes"), ("<p>a", "a"), ("<div><p>one, two.<p>three", "one, two. three"),
    ("<p>x, y.<!-- open <p>z", "x, y."), ("a < b and c > d", "a < b and c > d"), ("<nav>menu</nav><footer>end</footer>", ""),
    ("<p>x&lt;y &#233; &unknown; &amp;amp;</p>", "x<y é &unknown; &amp;"), ("<p>one<br>two</p>", "one two"), ("</p></b></div>x", "x"),
])
def test_broken_and_small_pages(html, text):
    assert H.main_text(html) == text


def test_long_page_and_deep_nesting():
    import random
    rng = random.Random(1)
    paragraphs = [sentence(rng, 30) for _ in range(800)]
    page = PAGE % ("<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>")
    assert H.main_text(page) == " ".join(paragraphs)
    assert H.main_text("<div>" * 3000 + "deep, text." + "</div>" * 3000) == "deep, text."


def test_table_with_nulls_repeats_and_extra_columns(spark):
    rows = [(1, "u", PAGE % f"<article>{BODY}</article>"), (1, "u", PAGE % f"<article>{BODY}</article>"), (2, None, None), (None, "v", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars")
    got = sorted(map(tuple, H.extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=repr)
    assert H.extract(pages.limit(0)).count() == 0


def test_given_pages_equal_their_article(spark, sf_dir):
    import re
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        assert H.main_text(r.html) == " ".join(unescape(re.sub("<[^>]*>", " ", article)).split())


def restated(html, threshold=H.THRESHOLD):
    """Whether each block is content: path sums, smoothing, fusion and cut, one number after the other."""
    live = H.live_blocks(html)
    paths = [b.element.path for b, _ in live]
    ratio = []
    for p in paths:
        own = [(t, min(b.linked, len(t))) for (b, t), q in zip(live, paths) if q == p]
        text = sum(len(t) for t, _ in own)
        ratio.append((text / len(own), (1 + sum(len(H.MARKS.findall(t)) for t, _ in own)) / len(own), 1 - sum(k for _, k in own) / max(1, text)))
    fused = []
    for i, (b, _) in enumerate(live):
        near = [(math.exp(-d * d / 2), ratio[i + d]) for d in range(-2, 3) if 0 <= i + d < len(live)]
        total = sum(w for w, _ in near)
        fused.append(sum(w * r[0] for w, r in near) / total * ratio[i][1] * ratio[i][2] * b.element.weight)
    mean = sum(fused) / len(fused)
    spread = math.sqrt(sum((x - mean) ** 2 for x in fused) / len(fused))
    return fused, [x >= threshold * (spread + H.OF_MEAN * mean) for x in fused]


def random_page(rng):
    def part(depth):
        kind = rng.choice(["p", "p", "p", "h2", "ul", "div", "div class=related", "div class=note", "blockquote", "a", "p class=share-price"])
        if kind.startswith("div") and depth < 3:
            return f"<{kind}>" + "".join(part(depth + 1) for _ in range(rng.randint(1, 4))) + "</div>"
        if kind == "ul":
            return "<ul>" + "".join(f"<li>{sentence(rng, rng.randint(1, 6))}" for _ in range(rng.randint(1, 4))) + "</ul>"
        if kind == "a":
            return f"<p><a href=x>{sentence(rng, 4)}</a></p>"
        return f"<{kind}>{sentence(rng, rng.randint(1, 40))}</{kind.split(' ')[0]}>"
    return "<body>" + "".join(part(0) for _ in range(rng.randint(1, 9))) + "</body>"


def test_ratios_and_cut_equal_the_plain_restatement():
    rng = random.Random(11)
    for page in [PAGE % f"<article>{BODY}</article>", PAGE % f"<div>{BODY}</div>", *(random_page(rng) for _ in range(150))]:
        live = H.live_blocks(page)
        if live:
            fused, content = restated(page)
            got = H.fused_ratios(live)
            assert np.allclose(got, fused, rtol=1e-9, atol=1e-9)
            close = np.abs(got - H.cut(got)) < 1e-6
            assert ((got >= H.cut(got)) == content)[~close].all()
            # All content stays.
            text = H.main_text(page)
            for (_, t), c, near in zip(live, content, close):
                assert not c or near or t in text


def test_the_threshold_decides():
    pages = [PAGE % (box % BODY) for box in ("<article>%s</article>", '<div class="content">%s</div>')]
    for page in pages:
        assert H.main_text(page, 0) != H.main_text(page)  # everything is content, the sidebar too
        assert "Popular posts" in H.main_text(page, 0) and H.main_text(page, 1e9) == ""


def test_pages_of_divs_keep_title_and_lead():
    lead = "This is the lead of the text, which says in a line or two, what the text is about, and for whom."
    paragraphs = [f"Paragraph {i} has a number of words, some commas, and an end. It goes on, for a while." for i in range(30)]
    page = (f"<body><div class=top><a href=/>Home</a> <a href=/x>All pages</a></div><div class=headline><h1>The title</h1></div><div class=lead><p>{lead}</p></div>"
            f"<div class=text>{''.join(f'<p>{p}</p>' for p in paragraphs)}<h2>Short</h2><p>Last.</p></div><div class=bottom>Contact us</div></body>")
    assert H.main_text(page) == " ".join(["The title", lead, *paragraphs, "Short", "Last."])


@pytest.mark.parametrize("name", ["share-price", "related", "alert", "notice", "search"])
def test_paragraphs_of_the_article_stay_whatever_their_class(name):
    page = PAGE % f"<article><h1>Head</h1><p>First, a sentence. And one more, of some length, to read.</p><p class={name}>The price was 7.50, up from 7.</p><p>End, of it.</p></article>"
    assert "The price was 7.50, up from 7." in H.main_text(page)
    inner = PAGE % f"<article><p>First, a sentence. And one more, of some length, to read. It goes on, as it does.</p><div class={name}><p>See also this</p></div><p>End, of it, now.</p></article>"
    assert "See also this" not in H.main_text(inner)


def test_very_long_pages():
    page = "<p>" + "word, " * 200_000 + "<p>" * 5_000 + "<a " * 50_000
    assert H.main_text(page).startswith("word, word,")
