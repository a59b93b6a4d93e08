import itertools
import random

import pytest

from tessera.llm.html_mincut import blocks_of, extract, main_text, min_cut

PAGE = """<!doctype html><html><head><title>T &amp; t</title><style>p{x:"</p>"}</style></head><body class="no-sidebar-x">
<header class="site"><h1>Site</h1><a href=/>home</a></header><div class="cookie-notice">We use cookies.</div>
<nav><ul><li><a>x</a><li><a>y</a></ul></nav><div class="ad">Buy this long thing, it is really very good and cheap.</div>
<main><article class=post><header><h1>Headline &amp; more</h1><p class=byline>By X</p></header><p>First&nbsp;para<br>two &lt;b&gt;</p>
<aside><p>related stuff that is long enough to look like an article.</p></aside><form><label>Email</label><button>Go</button></form>
<ul><li>one<li>two <a href=x>link</a></ul><table><tr><td>c1<td>c2</table><p title="a > b">Quoted.</p><p>Be.</p>
<script>if (a<b) x("</article>")</script><div hidden>not shown</div></article>
<section id="comments"><article class="comment"><p>I think this is a long comment that goes on and on.</p></article></section></main>
<div id=sidebar><p>Side text.</p></div><footer>(c) all</footer></body></html>"""


def test_article_without_the_rest():
    assert main_text(PAGE).split("\n") == ["Headline & more", "First para two <b>", "one", "two link", "c1", "c2", "Quoted.", "Be."]


def test_page_without_landmarks_is_decided_by_the_cut():
    long = "This is a paragraph of the main text, with a number of words, and it ends in a period."
    page = f"<body><div><a>Home</a> <a>News</a></div><div><div>{long}</div><div>Short one.</div><div>{long}</div></div><div><a>Terms</a> | <a>Privacy</a></div>"
    assert main_text(page) == f"{long}\nShort one.\n{long}"


@pytest.mark.parametrize("page, said", [(None, ""), ("", ""), ("   ", ""), ("<p>", ""), ("<article>un<b>closed <i>x<p>y", "unclosed x\ny"),
                                        ("<article><p>a<!-- never closed <p>b", "a"), ("<article>1 < 2 & 3 &amp;amp; 4</article>", "1 < 2 & 3 &amp; 4"),
                                        ("<article><script>x", ""), ("<article><p>é&#233;&eacute;　\xa0 z</p>", "ééé z")])
def test_edges(page, said):
    assert main_text(page) == said


def test_very_long_page():
    text = " ".join(f"word{i}" for i in range(50_000)) + "."
    assert main_text(f"<article><p>{text}</p></article>") == text
    many = "<article>" + "".join(f"<p>Line {i}</p>" for i in range(20_000)) + "</article>"
    assert main_text(many).count("\n") == 19_999


def test_min_cut_is_the_least_of_all_labellings():
    rnd = random.Random(3)
    for _ in range(200):
        n = rnd.randrange(1, 9)
        scores = [rnd.uniform(-3, 3) for _ in range(n)]
        edges = {(i, j): rnd.uniform(0, 2) for i, j in itertools.combinations(range(n), 2) if rnd.random() < 0.5}

        def cost(x):
            return (sum(max(0, -s) if k else max(0, s) for s, k in zip(scores, x)) + sum(w for (i, j), w in edges.items() if x[i] != x[j]))

        assert cost(min_cut(scores, edges)) == pytest.approx(min(map(cost, itertools.product([False, True], repeat=n))))


def test_frame(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (None, None, None, "y"), (1, "u", PAGE, "x")], "page_id long, url string, html string, main string")
    got = extract(df).select("page_id", "url", "main.*").collect()
    assert sorted(r.n_chars for r in got) == [0, len(main_text(PAGE)), len(main_text(PAGE))]
    assert extract(df.where("1 = 0")).count() == 0


def test_blocks_are_in_page_order():
    assert [b.text for b in blocks_of("<p>a<div>b<p>c</div>d")] == ["a", "b", "c", "d"]


@pytest.mark.parametrize("page, said", [('<article><p>a</p><svg class="i"/><p>b</p></article>', "a\nb"), ("<article><p>a</p><video-js></video-js><p>b</p></article>", "a\nb"),
                                        ("<article><p>a</p><svg-icon>c</svg-icon><title-bar>d</title-bar><p>b</p></article>", "a\ncd\nb"),
                                        ("<article><p>a <svg width='1'><text>no</text></svg>b</p><svg/><p>c</p></article>", "a b\nc"),
                                        ("<article><p>As <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p><math/><p>b</p></article>", "As x=1 holds\nb"),
                                        ("<article><script/>no</script><SELECT><option>no</SELECT >b</article>", "b")])
def test_only_elements_without_text_are_dropped(page, said):
    assert main_text(page) == said


LONG = "This is a paragraph of the main text, with a number of words, and it ends in a period."


@pytest.mark.parametrize("page", [f'<article class="post no-sidebar"><p>{LONG}</p></article>', f'<div class="content with-comments"><p>{LONG}</p></div>',
                                  f'<article class="post tags-open"><p>{LONG}</p></article>', f'<article><p class="more">{LONG}</p></article>',
                                  f'<article><p class="share">{LONG}</p></article>', f'<article class="no-header"><p>{LONG}</p></article>',
                                  f'<body class="sidebar header-fixed"><main id="main-menu-open"><p>{LONG}</p></main>'])
def test_a_word_in_a_class_name_does_not_decide_alone(page):
    assert main_text(page) == LONG


@pytest.mark.parametrize("other", [f'<div class="sidebar"><p>{LONG}</p></div>', f'<div class="cookie-notice">{LONG}</div>', '<div class="related-posts"><ul><li><a>One</a><li><a>Two</a></ul></div>',
                                   f'<div role="complementary">{LONG}</div>', f"<section id=comments><article class=comment><p>{LONG}</p></article></section>"])
def test_boilerplate_names_inside_an_article(other):
    assert main_text(f"<article><p>{LONG}</p>{other}</article>") == LONG


def test_names_of_parts_make_no_landmark():
    assert main_text(f'<div><p>{LONG}</p></div><div class="main-menu"><a>Home</a> <a>News</a></div>') == LONG


def test_the_cut_weighs_doubts():
    lines = [f"<div>{LONG}</div>", '<div class="widget-area">Short words here</div>']
    assert main_text(lines[0] + lines[1]) == LONG
    assert main_text(f'{lines[0]}<div class="text-widget">{LONG}</div>{lines[0]}') == "\n".join([LONG] * 3)


@pytest.mark.parametrize("page, said", [("<article><p data-t=it's>two</p></article>", "two"), ('<article><a href=x">link</a> text</article>', "link text"),
                                        ("<article>one<p a='x' b=\"y>z\" c>two</p></article>", "one\ntwo"), ('<article>one<p title="abc>two', "one"),
                                        ("<article>one <b", "one"), ("<article>one</ x>two<!x>three<?y?>four</article>", "onetwothreefour"),
                                        ("<article><i / >x</i>y</article>", "xy")])
def test_stray_quotes_and_unclosed_tags(page, said):
    assert main_text(page) == said


@pytest.mark.parametrize("page", ['<article class="widget"><p>{}</p></article>', '<main><div id="more"><p>{}</p></div></main>'])
def test_names_do_not_leave_a_page_without_text(page):
    assert main_text(page.format(LONG)) == LONG
    assert main_text(page.format(LONG) + f"<nav>{LONG}</nav><div class=sidebar>{LONG}</div>") == LONG


def test_no_text_where_all_is_boilerplate():
    assert main_text(f"<nav>{LONG}</nav><div class=sidebar>{LONG}</div><section id=comments><article class=comment><p>{LONG}</p></article></section>") == ""


@pytest.mark.parametrize("page", ["<a " * 200_000, "<!" * 200_000, "</ " * 200_000, "<a b='" * 100_000, "<b>" * 60_000 + "</i>" * 60_000, "<b>" * 40_000 + "<p>x</p>y" * 20_000,
                                  "<script>" * 100_000, "<svg" * 100_000, "<li><b>" * 50_000, "<a =" * 200_000, "<!--" * 100_000])
def test_time_grows_with_the_page(page):
    import time
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 5


def test_flow_over_very_many_undecided_blocks():
    import time
    rnd = random.Random(5)
    n = 50_000
    edges = {(i - 1, i): .8 for i in range(1, n)} | {(i - d, i): .6 / d for i in range(4, n) for d in (2, 3, 4) if rnd.random() < .3}
    for scores in ([rnd.uniform(-1.5, 1.5) for _ in range(n)], [.7 if i % 2 else -.7 for i in range(n)]):
        start = time.process_time()
        min_cut(scores, edges)
        assert time.process_time() - start < 6
