"""The scanner of pages: attributes as HTML reads them, nothing left out beyond the contract, cost in proportion."""

import time

import pytest

from leadloom.llm import html_extraction


def texts(page):
    return [t for _, t, _ in html_extraction.parse(page).runs]


def test_quotes_open_only_after_an_equals_sign():
    assert texts("<p>See <a href=/bob's>the link</a> here. It's fine and goes on.</p>") == ["See the link here. It's fine and goes on."]
    assert texts("<p>See <a href=/bob's>the link here.") == ["See the link here."]
    assert texts("<p title = \"a>b\" x='c>d' y=e'f>one</p><p it's>two</p>") == ["one", "two"]
    assert texts('<p title="never closed>one</p><p>two</p>') == ["one", "two"]
    assert texts("a < b <c and <3") == ["a < b <c and <3"]


def test_nothing_else_is_left_out():
    page = "<article><p>a <math><mi>x</mi></math> b <svg><text>s</text></svg> <object>o</object> <canvas>c</canvas></p><noscript><p>n</p></noscript><dialog>d</dialog><button>u</button> <label>l</label> wo<wbr>rd<xmp><i>&amp;</i></xmp></article>"
    assert " ".join(texts(page)) == "a x b s o c n du l word<i>&amp;</i>"
    gone = "<head><title>t</title><style>s</style></head><script>x<p></script><form><p>f</p><label>l</label></form><template><p>t</p></template><iframe>i</iframe><select><option>o</select><textarea>a</textarea><!-- c --><p>kept"
    assert texts(gone) == ["kept"]


def test_end_tags_end_what_they_name():
    assert texts("<b><p>one</b> two</p>three") == ["one two", "three"]
    assert texts("<div><table><tr><td>a</div>b</td></tr></table>c</div>") == ["ab", "c"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul>") == ["a", "b", "c", "d"]
    assert texts("<p>a<b>b<p>c</b>d") == ["ab", "cd"]


@pytest.mark.parametrize("page", ["<a " * 200_000, '<a title="' * 100_000, '<a title="' * 100_000 + ">", '<a x=">" y=">" ' * 50_000, "<div></span>" * 50_000, "<a>" * 50_000 + "<div>" * 50_000 + "</a>" * 50_000, "<b>" * 50_000 + "<div></div>" * 50_000, "<ul><li>" * 30_000 + "<li>" * 30_000, "<!--" * 100_000, "<a " + "=" * 200_000])
def test_cost_in_proportion(page):
    model = html_extraction._trained(html_extraction.TRAINING_PAGES, html_extraction.SEED)
    began = time.perf_counter()
    html_extraction.extract([page], model)
    assert time.perf_counter() - began < 8  # the quadratic scanner took minutes
