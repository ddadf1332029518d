"""Main text: alignment against a full table, markup cases, and differencing on hosts made for it."""

from __future__ import annotations

import html as references
import random
import re

import numpy as np
import pytest

from reviewflow.llm import html_extraction as extraction
from reviewflow.llm.common import read


def plain_length(one, other):
    table = [[0] * (len(other) + 1) for _ in range(len(one) + 1)]
    for i, x in enumerate(one):
        for j, y in enumerate(other):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1 << 26, 8])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(extraction, "ALIGNED_BITS", bits)
    rng = random.Random(4)
    for _ in range(300):
        one, other = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in "ab")
        pairs = extraction.common_subsequence(one, other)
        assert len(pairs) == plain_length(one, other)
        assert all(one[i] == other[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:], strict=False))


def test_long_pages_are_aligned(monkeypatch):
    one, other = list(range(20_000)), [x for x in range(20_000) if x % 7] + [1, 2, 3]
    assert len(extraction.common_subsequence([-1, *one, -2], [-3, *other, -4])) == len(other) - 3


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        (None, ""),
        ("plain text &amp; more", "plain text & more"),
        ("<p>a<b>b</b>c<p>d <br> e", "abc d e"),
        ("<nav><ul><li>menu<li>more</ul></nav><article><h1>T&eacute;</h1><p>One\n two</p></article><footer>&copy; x</footer>", "Té One two"),
        ("<head><title>t</title></head><body><header><h1>Site</h1></header><main><header>Kept</header>x</main><aside>side</aside>", "Kept x"),
        ("<article>a<div class='ad'>buy<div>inner</div></div>b<section id=comments><article class='comment'>hi</article></section></article>c", "a b"),
        ("<article>a<p class=cookie-notice>we use<p>b<span class=share>s<span>t</span>u</span>c</article>", "a b c"),
        ("<div class='page has-sidebar'><article>x</article></div>", "x"),
        ("<article>x<script>var t='</p><p>no';</script><style>p{}</style><!-- <p>no --> y<form>f<input>g</form></article>", "x y"),
        ("<article>x<textarea>no <b>", "x"),
        ("<article>cut &am", "cut &am"),
        ("<article title='a>b'>x</article>", "x"),
        ("<nav>unclosed<ul><li>m</nav><article>x</p></div></article>", "x"),
        ("a < b <- c", "a < b <- c"),
        ("<article><div hidden>no</div><div style='display: none'>no</div>&nbsp;yes&#33;</article>", "yes!"),
    ],
)
def test_markup(html, text):
    lines = extraction.lines_of(html or "")
    zone = extraction.INSIDE if any(z == extraction.INSIDE for z, _ in lines) else extraction.OPEN
    assert " ".join(text for z, text in lines if z == zone) == text


def table(spark, rows):
    rows = [(*row, "x", 1) for row in rows]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, text STRING, n_chars INT")


def result(spark, rows):
    found = extraction.extract(table(spark, rows).repartition(3))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    return sorted([tuple(row) for row in found.collect()], key=str)


def page(host, n, body, menu="Home|News|About us", foot="All rights reserved"):
    top = "".join(f"<div>{line}</div>" for line in menu.split("|"))
    return n, f"http://{host}/{n:04}", f"<body>{top}<div>{body}</div><div>{foot}</div>"


def body(n):
    return "</div><div>".join(f"Sentence {i} of page {n} says {n * i * 7919 % 1000}." for i in range(1, 6))


def kept(n):
    return " ".join(f"Sentence {i} of page {n} says {n * i * 7919 % 1000}." for i in range(1, 6))


@pytest.mark.parametrize("block", [256, 4])
def test_lines_shared_with_the_nearest_pages_go(spark, monkeypatch, block):
    monkeypatch.setattr(extraction, "BLOCK_PAGES", block)
    rows = [page("a.org", n, body(n)) for n in range(30)] + [page("b.org", n, body(n), "Start|Help", "Imprint") for n in range(30, 33)]
    rows.append(page("lonely.org", 99, body(99)))
    found = {row[0]: row[2] for row in result(spark, rows)}
    assert all(found[n] == kept(n) for n in range(33))
    # No page to compare with: nothing is known of its lines.
    assert found[99] == "Home News About us " + kept(99) + " All rights reserved"


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(9)
    lines = [f"Line {i} of the pool." for i in range(12)]
    rows = []
    for n in range(60):
        text = "".join(f"<p>{line}</p>" for line in rng.choices(lines, k=rng.randint(0, 9)))
        tag = "article" if rng.random() < 0.3 else "div"
        rows.append((n, f"https://{rng.choice('abc')}.org/{rng.randint(0, 40)}?q={n}", f"<{tag}>{text}</{tag}>"))
    whole = result(spark, rows)
    monkeypatch.setattr(extraction, "BLOCK_PAGES", 5)
    assert result(spark, rows) == whole
    assert any(row[2] != " ".join(t for _, t in extraction.lines_of(html)) for row, (_, _, html) in zip(whole, sorted(rows, key=str), strict=True))


def test_copies_and_quotes_keep_their_article(spark):
    copies = [(n, f"http://c.org/{n:03}", f"<article><p>{kept(1)}</p><p>Same in all.</p></article><div>Foot</div>") for n in range(20)]
    # One sentence that every other article repeats.
    quoting = [(n, f"http://q.org/{n}", f"<article><p>{'Quoted by many.' if n % 2 else 'Own words.'}</p><p>{kept(n)}</p></article>") for n in range(100, 130)]
    found = {row[0]: row[2] for row in result(spark, copies + quoting)}
    assert all(found[n] == kept(1) + " Same in all." for n in range(20))
    assert all(found[n].endswith(kept(n)) and not found[n].startswith("Sentence") for n in range(100, 130))


def test_a_line_that_all_neighbours_have_in_their_articles_goes(spark):
    rows = [(n, f"http://n.org/{n:03}", f"<article><p>{kept(n)}</p><p>Read our other stories.</p></article>") for n in range(20)]
    found = {row[0]: row[2] for row in result(spark, rows)}
    assert all(found[n] == kept(n) for n in range(1, 19))
    # The first and the last page of a host have three pages near them, too few to tell.
    assert all(found[n].endswith("Read our other stories.") for n in (0, 19))


def test_defined_cases(spark):
    rows = [(1, None, "<p>x</p>"), (1, None, "<p>x</p>"), (None, "no scheme", None), (2, "http://h.org/a", ""), (None, "", "<p>y &amp; z")]
    expected = [(1, None, "x", 1)] * 2 + [(None, "no scheme", "", 0), (2, "http://h.org/a", "", 0), (None, "", "y & z", 5)]
    assert result(spark, rows) == sorted(expected, key=str)
    assert result(spark, []) == []


def test_the_tables_pages(spark, tables):
    """The tables' articles stand in `article`, so a plain cut at the markup gives their text."""
    pages = read(spark, tables, "pages")

    def article(html):
        inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
        blocks = re.split(r"<(?:p|/p|h1|/h1|br)>", inner)
        texts = (" ".join(references.unescape(re.sub(r"<[^>]*>", "", block)).split()) for block in blocks)
        return " ".join(text for text in texts if text)

    expected = sorted((row.page_id, row.url, article(row.html), len(article(row.html))) for row in pages.collect())
    assert sorted(map(tuple, extraction.extract(pages).collect())) == expected


def test_votes():
    sizes = np.array([5, 50, 5], "<i4").tobytes()
    one = extraction.Page("h", 1, 1, np.array([1, 2, 3], "<i8").tobytes(), bytes([0, 0, 0]), sizes)
    for n in range(3):
        one.pair(extraction.Page("h", n, n, np.array([1, 90 + n, 3 if n else 4], "<i8").tobytes(), bytes([0, 0, 0]), sizes))
    assert one.deleted().tolist() == [True, False, True]
    # A copy has no vote.
    one.pair(extraction.Page("h", 9, 9, np.array([1, 2, 7], "<i8").tobytes(), bytes([0, 0, 0]), sizes))
    assert len(one.shared) == 3
