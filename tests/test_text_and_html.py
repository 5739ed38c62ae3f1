import html
import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from pagemill.functions.html import ARTICLE_BODY, BLOCK_TAGS, element, html_to_text, page_title
from pagemill.functions.text import (
    name_ascii, name_normalise, newline_cleanup, token_count, token_truncate,
)

SENTENCE = "Hello, How are you? We are building an api for a chatbot."


def apply(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_token_count(spark):
    assert apply(spark, token_count, SENTENCE, "", " \n\t", None, "a b c") == [12, 0, 0, None, 2]


def test_truncate_keeps_spacing(spark):
    cut = apply(spark, lambda c: token_truncate(c, 3), "  a\n\nb \t c   d ", "a b c  ", "a b", "", None)
    assert cut == ["  a\n\nb \t c", "a b c  ", "a b", "", None]
    assert apply(spark, lambda c: token_truncate(c, 10), SENTENCE) == [" ".join(SENTENCE.split()[:10])]


def test_truncate_at_the_limit_and_long(spark):
    words = " ".join(f"w{i}" for i in range(4001))
    exact = words.rsplit(" ", 1)[0]
    long = "x " * 200_000
    out = apply(spark, lambda c: token_truncate(c, 4000), words, exact, long)
    assert out == [exact, exact, ("x " * 4000).rstrip()]


def test_newlines(spark):
    out = apply(spark, newline_cleanup, "\n\n\na\n\n\n\nb\n\nc\n  \n", "", None, "a\n \n\nb")
    assert out == ["a\n\nb\n\nc", "", None, "a\n \n\nb"]


def test_names(spark):
    names = ["jo.d-o é@x@y.com", "@first", "plain name", "a\nb@c", ""]
    assert apply(spark, name_normalise, *names) == ["jo_d_o_é_x", "_first", "plain_name", "a_b", ""]
    assert apply(spark, name_ascii, "a..é")[0] == "a___"


def test_article_body_is_balanced(spark):
    page = ('<div>no</div><DIV class="a" itemprop="articleBody">x<div>y</div>'
            "<script>'</div>'</script>z</DIV><div>after</div>")
    body = lambda c: element(c, *ARTICLE_BODY)
    out = apply(spark, body, page, "<div itemprop='articleBody'>open<div>", "<div>none</div>", "", None,
                "<div itemprop=articleBody id=x>u</div>", "<div data-itemprop='articleBody'>no</div>")
    assert out == ['<DIV class="a" itemprop="articleBody">x<div>y</div>z</DIV>',
                   "<div itemprop='articleBody'>open<div>", None, None, None,
                   "<div itemprop=articleBody id=x>u</div>", None]


def test_first_of_several_articles(spark):
    page = "<articles>no</articles><article a=b>1<article>2</article></article><article>3</article>"
    assert apply(spark, lambda c: element(c, "article"), page) == ["<article a=b>1<article>2</article></article>"]


def test_entities_decode_once(spark):
    out = apply(spark, html_to_text, "&amp;lt;b&amp;gt; &lt;i&gt; &#233;&#xE9;&eacute;&#x1F600;",
                "&bogus; &#0; &#xD800; &#99999999; & &;", "a<p>b</p>c<b>d</b><br/>e",
                "x<!-- <p>no</p> -->y<style>p{}</style>z", "&nbsp;&#160;&apos;&#39;&quot;&copy;&NotEqualTilde;")
    assert out == ["&lt;b&gt; <i> ééé\U0001F600", "&bogus; \ufffd \ufffd \ufffd & &;",
                   "a\nb\ncd\ne", "xyz", "\u00a0\u00a0''\"©\u2242\u0338"]


def test_titles(spark):
    out = apply(spark, page_title, "<h1>A <b>B</b> &amp; C</h1><h1>D</h1>", "<h2>x</h2>", "",
                "<h1 class=x>attr</h1>")
    assert out == ["A B & C", "", "", ""]


@pytest.mark.parametrize("seed", range(3))
def test_truncate_against_python(spark, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choice("ab \n\t.") for _ in range(rnd.randrange(60))) for _ in range(200)]
    got = apply(spark, lambda c: token_truncate(c, 5), *texts)
    for text, out in zip(texts, got):
        assert out.split() == text.split()[:5] and text.startswith(out)


class Reader(HTMLParser):
    """Text as Python's own parser reads it, with the line ends of block tags."""

    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.out.append("\n" * (tag in BLOCK_TAGS))
        self.hidden += tag in ("script", "style")

    def handle_startendtag(self, tag, attrs):
        self.out.append("\n" * (tag in BLOCK_TAGS))

    def handle_endtag(self, tag):
        self.out.append("\n" * (tag in BLOCK_TAGS))
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def parsed(page):
    reader = Reader()
    reader.feed(page)
    reader.close()
    return "".join(reader.out)


PIECES = ["a", " < ", "<b>", "</b>", "<p>", "</p>", "<br/>", "<", " 1 <2> 3 ", "x", "&#150;", "&#x80;", "&#0;", "&amp;", "&eacute;", "&#233;",
          "<script>if (a<b) '</p>'</script>", "<style>p{}</style>", "<!-- c <p> -->", "<!x>", "<?y>", "</ z>", "</>", "<articles>", ">", "-->"]


@pytest.mark.parametrize("seed", range(3))
def test_text_against_a_parser(spark, seed):
    rnd = random.Random(seed)
    pages = ["".join(rnd.choices(PIECES, k=rnd.randrange(1, 14))) for _ in range(300)]
    pages += ["<p>if 1 < 2 then stop. Long tail here</p><p>second para</p>see <b>bold</b> end",
              "x <b unclosed", "x <!-- un", "x <script>un", "<p>y</p> <script un", "a<script>b</script x>c", "x<", "a<b<c>d"]
    for page, out in zip(pages, apply(spark, html_to_text, *pages)):
        assert out == parsed(page), page
    assert apply(spark, html_to_text, "x <!-- un <p>y</p>") == ["x <!-- un \ny\n"]


@pytest.mark.parametrize("bad", ["<!--", "<script>", "<script ", "<style>", "<p ", "</div", "<", "<!-- -- >", "<b <!--", "</script ", "&"])
def test_bad_megabyte_is_linear(spark, bad):
    page = "<p>start</p>" + bad * (1_000_000 // len(bad))
    start = time.time()
    apply(spark, html_to_text, page, page + ">", page + "-->")
    assert time.time() - start < 15


QUOTED = ['<a title="x>y">', "<a title='x>y' b>", '<p class="a" id=\'b>"c\'>', '<b a=b"c>', "<b it's>", '<div data-x = "<p>q</p>" >', "<br alt='</b>'/>",
          '<a b=c="d>', '<a ="e>', "<p a='\"'>", '<i x="" y=">">', 'say "a > b"', " a='b' ", '<script src="a>b">x</script>', "<!-- a='> -->", '</p title="k">', "&gt;"]


@pytest.mark.parametrize("seed", range(3))
def test_quoted_brackets_against_a_parser(spark, seed):
    rnd = random.Random(seed)
    pages = QUOTED + ["".join(rnd.choices(QUOTED + PIECES, k=rnd.randrange(1, 10))) for _ in range(400)]
    for page, out in zip(pages, apply(spark, html_to_text, *pages)):
        assert out == parsed(page), page


def test_quoted_brackets_in_elements(spark):
    page = '<div title="</article><article>">no</div><article data-a="1>2" b=\'<article>\'>x<i alt="</article>">y</i></article>z'
    assert apply(spark, lambda c: element(c, "article"), page) == [
        "<article data-a=\"1&gt;2\" b='&lt;article&gt;'>x<i alt=\"&lt;/article&gt;\">y</i></article>"]
    assert apply(spark, lambda c: html_to_text(element(c, "article")), page) == ["\nxy\n"]


def test_an_open_quote_is_no_quote(spark):
    assert apply(spark, html_to_text, '<p>a</p><b x="1>2">c<a title="never>closed</a><p>d</p>')[0].endswith("d\n")


@pytest.mark.parametrize("bad", ['="x>', "='<", '<a b="c>d">', "<a b='", "\"'", '<a b="<script>">t', "= \" >"])
def test_quoted_megabyte_is_linear(spark, bad):
    page = '<a t="x>y">start</a>' + bad * (1_000_000 // len(bad))
    start = time.time()
    apply(spark, html_to_text, page)
    assert time.time() - start < 15


def test_every_character_of_a_text_stays(spark):
    plain = [chr(c) for c in range(0x20, 0x11000) if not 0xD800 <= c < 0xE000 and chr(c) not in "<&"] + [chr(0xFDD0 + i) * 2 for i in range(8)]
    text = "".join(plain) + "\ufdd2\ufdd3a\ufdd4\ufdd01\ufdd4" + "0"
    assert apply(spark, html_to_text, text, f"<p>{text}</p>") == [text, f"\n{text}\n"]
    shown = f"<script>x</script>{text}"
    assert apply(spark, lambda c: element(c, "p"), f"<p>{shown}</p>") == [f"<p>{text}</p>"]


def test_references_without_a_semicolon(spark):
    page = "&copy 2 &copy2 &notit; &notin; &amp &ampere &eacutes &#65 &#x41g &#65b &lt&gt &unknown &#; &#x; &AMP &nbspx &ETH &sup &sup2"
    assert apply(spark, html_to_text, page) == [html.unescape(page)]
    numbers = [*range(0, 0x200), 0xD7FF, 0xD800, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x1FFFE, 0x10FFFD, 0x10FFFF, 0x110000, 10 ** 30]
    refs = "|".join(f"&#{n};&#x{n:X}" for n in numbers)
    assert apply(spark, html_to_text, refs) == [html.unescape(refs)]


def test_windows_references(spark):
    codes = range(0x80, 0xA0)
    page = "".join(f"&#{c};&#x{c:x};" for c in codes)
    assert apply(spark, html_to_text, page) == [parsed(page)]
