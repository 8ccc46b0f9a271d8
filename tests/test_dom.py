"""Selectors on clean and broken pages."""

import pytest

from pageloom.operators.dom import Page, compile_path, css_to_path
from pageloom.plans.rules import RULE_SETS

PAGE = """<html><head><meta property="og:title" content="Og"><script>var t="</p>";</script></head>
<body><!-- <h1>hidden</h1> --><h1 class="pdp-title big"> Name <b>bold</b></h1>
<div class="price-box"><span class="mrp">Rs 99</span><span>mid</span><span class="sale Price">49</span></div>
<p>one<p>two <i>three</i></p><ul><li>a<li>b</ul>
<table><tr><th>Brand</th><td>Acme</td></tr><tr><th>ASIN</th><td> X1 </td><td>X2</td></tr></table>
<input id="main-Color" checked value="red"><input id="main-Color-2" value="blue"></body></html>"""


@pytest.fixture(scope="module")
def page():
    return Page(PAGE)


@pytest.mark.parametrize("path, want", [
    ("//meta[@property='og:title']/@content | //h1/text()", ["Og", " Name "]),
    ("//h1/text() | //meta[@property='og:title']/@content", ["Og", " Name "]),
    ("//h1//text()", [" Name ", "bold"]),
    ("//h1", [" Name bold"]),
    ("//*[contains(@class,'mrp')]//text()", ["Rs 99"]),
    ("//*[contains(concat(' ', normalize-space(@class), ' '), ' sale ')]//text()", ["49"]),
    ("//span[contains(translate(@class,'ABCP','abcp'),'price')]/text()", ["49"]),
    ("//span[contains(text(),'Rs')]/following-sibling::span[1]", ["mid"]),
    ("//th[contains(text(),'ASIN')]/following-sibling::td/text()", [" X1 ", "X2"]),
    ("//tr[th[contains(text(),'Brand')]]/td//text()", ["Acme"]),
    ("//input[contains(@id,'Color') and @checked]/@value", ["red"]),
    ("//input[not(@checked)]/@value", ["blue"]),
    ("//li/text()", ["a", "b"]),
    ("//p/text()", ["one", "two "]),
    ("//div/span[2]/text()", ["mid"]),
    ("//input[@id and string-length(@id)>11]/@value", ["blue"]),
    ("//span[@class='mrp' or @class='none']/text()", ["Rs 99"]),
    ("//nothing/@x", []),
])
def test_select(page, path, want):
    assert page.select(path) == want


def test_css(page):
    assert page.select(css_to_path("div.price-box > span.sale::text")) == ["49"]
    assert page.select(css_to_path('meta[property="og:title"]::attr(content)')) == ["Og"]
    assert page.select(css_to_path("#main-Color::attr(value)")) == ["red"]


def test_broken_html_never_raises():
    for text in ("", "<", "<p", "<p><b>x<br><p>y", "</div></p>", "<![CDATA[x", "<a href=>", "<p>" * 500):
        Page(text).select("//p//text()")


def test_all_rule_selectors_compile():
    for rules in RULE_SETS.values():
        for r in rules:
            if r.kind == "xpath":
                compile_path(r.rule)


def test_unsupported_selector_raises():
    with pytest.raises(ValueError):
        compile_path("//a/ancestor::b")
