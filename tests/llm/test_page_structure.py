"""Page structure: names inside articles, headers, comments, and time on long broken pages."""

from __future__ import annotations

import random
import time

import pytest

from dockflow.llm import page_text


def kept(page):
    return [t for t, _, aside in page_text.lines_of(page) if not aside]


@pytest.mark.parametrize("page, want", [
    ("<article><div class='market-share-table'>12 %</div><p class='alert'>Mind.</p><section id='related-work'>Others</section></article>", ["12 %", "Mind.", "Others"]),
    ("<article><p>a</p><div class='share'>tweet</div><div class='ad big'>buy</div></article>", ["a"]),
    ("<div class='site-footer'>f</div><div id='ad-banner'>b</div><div class='shareholder'>s</div>", ["s"]),
    ("<main><header>Site menu header</header><p>x</main>", ["x"]),
    ("<article><header><p>kicker</p><h1>Title</h1></header><p>x</article>", ["kicker", "Title", "x"]),
    ("<article><p>x</p><div id=respond>say</div><ol class=commentlist><li>first</ol><div id='disqus_thread'>d</div></article>", ["x"]),
    ("<article>x<article class='comment'>c</article></article>", ["x"]),
    ("<p><i>a<b>b</i>c</b>d", ["abcd"]), ("<div><span class='ad'>x</span>y</div>", ["xy"]), ("<b><div>a</b>b</div>c", ["ab", "c"]),
    ("<div>a</p>b</div></div>c", ["a", "b", "c"]), ("<p>a<div>b<p>c</div>d", ["a", "b", "c", "d"]), ("<p title=\"a>b>c'\">q<a href=\"x>'\">r</a>", ["qr"]),
    ("<p title='never closed>text", ["text"]), ("x<p title='never closed>text <b>more", ["xtext more"]),  # such a tag is no tag
])
def test_structure(page, want):
    assert kept(page) == want


@pytest.mark.parametrize("make", [
    lambda n: "<div>" * n + "</p>" * n + "x", lambda n: "<div>" * n + "</b>" * n + "x", lambda n: "<b>" + "<i>" * n + "</b></u>" * n, lambda n: "<b>" + "<div>" * n + "</b><p>" * n,
    lambda n: "<p a='" * n, lambda n: "<p a='\">" * n, lambda n: "<!-- " * n, lambda n: "<script>" * n, lambda n: "<" * n, lambda n: "<a b=" * n, lambda n: "</div" * n, lambda n: "&amp;&#x41;&" * n,
    lambda n: "<p>a\n\t" * n, lambda n: "<header><h1>" * n, lambda n: "<article><span class='x y z'>" * n,
])
def test_broken_markup_costs_linear_time(make):
    n = 2_000_000 // max(1, len(make(100)) // 100)
    begun = time.process_time()
    page_text.lines_of(make(n))
    assert time.process_time() - begun < 20  # a second or two each


def test_random_tag_soup_equals_the_plain_stack():
    """Against the same rules on one stack that is searched from the top each time."""
    rng = random.Random(1)
    tags = ["div", "p", "b", "i", "article", "main", "ul", "li", "nav", "span"]
    for _ in range(400):
        parts = []
        for k in range(rng.randrange(1, 40)):
            t = rng.choice(tags)
            parts.append(rng.choice([f"<{t}>", f"<{t}>", f"</{t}>", f"t{k} "]))
        page = "".join(parts)
        stack, out, held = [], [], []

        def flush():
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                out.append((text, max((2 if t == "article" else 1 if t == "main" else 0 for t in stack), default=0), "nav" in stack))

        for part in parts:
            if part[0] != "<":
                held.append(part)
                continue
            t = part.strip("</>")
            inline = t in page_text.INLINE
            if not inline:
                flush()
            if part.startswith("</"):
                at = max((k for k, x in enumerate(stack) if x == t), default=None)
                if at is not None and not (inline and any(x not in page_text.INLINE for x in stack[at + 1:])):
                    del stack[at:]
                continue
            if not inline:
                k = len(stack)
                while k and stack[k - 1] in page_text.INLINE:
                    k -= 1
                if k and stack[k - 1] == "p":
                    del stack[k - 1:]
            stack.append(t)
        flush()
        assert page_text.lines_of(page) == out, page
