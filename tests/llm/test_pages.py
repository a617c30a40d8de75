"""Main text of pages."""

import pytest
from feedlake.llm import html_text, queries

STORY = "The story of the man that went to the market, and of the things he saw there on the way to the sea."

CASES = [
    (None, ""),
    ("", ""),
    ("just text without tags that is in the middle of a page and of the things that are said in it to all the people", None),
    (f"<article><h1>A title</h1><p>{STORY}</p><p>Short.</p></article>", f"A title {STORY} Short."),
    (f"<nav><a href='/'>Home</a></nav><main><p>{STORY}<p>Two &amp; three&nbsp;&lt;b&gt;<br>x</main><footer>end</footer>", f"{STORY} Two & three <b> x"),
    (f"<article><p>{STORY}</p><aside>{STORY}</aside><div class='ad'>{STORY}</div><section id=comments><p>{STORY}</p></section></article>", STORY),
    (f"<article><p>{STORY}</p><script>var t='</p><p>no';</script><style>p{{}}</style><!-- <p>no</p> --><form>{STORY}</form></article>", STORY),
    (f"<article><p>a<b>b</b>c <i>{STORY}", f"abc {STORY}"),
    (f"<div><ul><li><a href=x>One</a></li><li><a href=y>Two</a></li></ul><p>{STORY}</p><p>So it was.</p><p>{STORY}</p><div class=sidebar>{STORY}</div></div>", f"{STORY} So it was. {STORY}"),
    (f"<header><h1>Site</h1></header><article><header><h1>Title</h1><p>By me</p></header><p>{STORY}</p></article>", f"Title {STORY}"),
    (f"<p title='a > b'>{STORY}</p>", STORY),
    ("<" * 2000, None),
    ("<p " * 2000, None),
]


RUSSIAN = "Прошлой зимой мы жили у моря и каждый день ходили смотреть, как рыбаки чинят сети и лодки на берегу."
CHINESE = "去年冬天我们住在海边,每天都去看渔民在岸上修理渔网和小船,晚上大家坐在一起讲故事。"
GREEK = "Τον περασμένο χειμώνα μέναμε κοντά στη θάλασσα και κάθε μέρα βλέπαμε τους ψαράδες."
CASES += [
    (f"<article><p>{STORY}</p><p>See <a>the full report</a>.</p><p><a>All of it.</a></p><p>{STORY}</p></article>", f"{STORY} See the full report. All of it. {STORY}"),
    (f"<article><h2><a href=x>A title</a></h2><p>{STORY}</p><ul><li><a>One</a><li><a>Two</a></ul></article>", f"A title {STORY}"),
    *((f"<div><a href=x>{t[:9]}</a></div><div>{t}</div><div>{t[:20]}</div><div>{t}</div>", f"{t} {t[:20].strip()} {t}") for t in (RUSSIAN, GREEK)),
    (f"<div><a href=x>{CHINESE[:4]}</a></div><div>{CHINESE}</div>", CHINESE),
    (f"<html class='no-js menu'><body class='has-sidebar sidebar'><main id=comments><article class='post hidden'><p>{STORY}</p></article></main></body></html>", STORY),
    (f"<html><head><title>T</title><meta charset=utf-8><body><p>{STORY}</p></body></html>", STORY),
    (f"<head><title>T</title><style>p{{}}</style><p>{STORY}</p>", STORY),
]


CARD = "<article class=card><h3><a href=x>Another</a></h3><p>The tale of a dog that ran to the hills and of the man that went after it in the end.</p></article>"
CASES += [
    # a link holds the blocks within it, a missing end tag ends with its block
    (f"<div><p>{STORY}</p><a href=x><div>{STORY}</div><div>{STORY}</div></a></div>", STORY),
    (f"<div><p><a href=x>Home<p>{STORY}</p></div>", STORY),
    (f"<div><p><a href=x>Home</p><p>{STORY}</p><p>{STORY} <a>End.</a></p></div>", f"{STORY} {STORY} End."),
    # cards beside the story, beside an article, inside it, and alone
    (f"<div><p>{STORY}</p></div>{CARD}", STORY),
    (f"<article><p>{STORY}</p></article>{CARD}", STORY),
    (f"<article><p>{STORY}</p>{CARD}</article>", STORY),
    (f"<article class='post card'><p>{STORY}</p></article>", STORY),
    (f"<article><p>{STORY}</p></article><article><p>{STORY}</p></article>", f"{STORY} {STORY}"),
    # names of an article's own parts, and of furniture in it
    (f"<article><p>{STORY}</p><section class='share-price'><p>{STORY}</p></section><div class='legal'>{STORY}</div></article>", f"{STORY} {STORY} {STORY}"),
    *(
        (f"<article><p>{STORY}</p><div class='{name}'><p>{STORY}</p></div></article>", STORY)
        for name in ("share", "share-buttons", "post-reply", "social_links", "ad-slot", "x promo-legal", "comments-area", "notice", "related posts")
    ),
    # sources as wholly linked paragraphs; formulas
    (f"<article><p>{STORY}</p><p><a>One source</a></p><p><a>Two source</a></p></article>", f"{STORY} One source Two source"),
    (f"<article><p>{STORY} <math><mi>x</mi><mo>=</mo><mn>1</mn></math></p></article>", f"{STORY} x=1"),
    # an open paragraph ends at the next block
    (f"<article><p class=ad>Buy this<div>{STORY}</div><p>{STORY}</article>", f"{STORY} {STORY}"),
    (f"<article><p class=ad>Buy this<hr>{STORY}</article>", STORY),
    # what looks like a tag, at the end
    (f"<p>{STORY} So < 5 apples", f"{STORY} So < 5 apples"),
    (f"<p>{STORY}</p>< 5 apples", f"{STORY} < 5 apples"),
    (f"<p>{STORY}</p><a href='x", STORY),
    # pages that hold nothing else
    ("Hello world.", "Hello world."),
    ("<nav><a href=x>Home</a></nav><p>Hello world.</p><footer>End</footer>", "Hello world."),
    ("<nav><a href=x>Home</a></nav>", ""),
    ("<a>" * 2000 + "x", None),
]


@pytest.mark.parametrize(("html", "text"), CASES)
def test_pages(html, text):
    got = html_text.main_text(html)
    assert text is None or got == text


def test_query_keeps_articles_and_nothing_else(spark, small):
    import re
    from html import unescape

    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = queries.op3_extract_text(spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        inner = re.sub(r"</?(p|h1|br|li|ul|div)\b[^>]*>", " ", inner)
        assert r.text == " ".join(unescape(re.sub(r"<[^>]*>", "", inner)).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_awkward_pages(spark):
    rows = [(1, None, None), (1, "u", ""), (None, "u", CASES[3][0]), (2, "u", "x" * 200_000)]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    got = sorted((str(r.page_id), r.n_chars) for r in html_text.extract(df).collect())
    assert [n for _, n in got][:3] == [0, 0, 0] and len(got) == 4
    assert html_text.extract(df.limit(0)).count() == 0
