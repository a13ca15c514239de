import random

import numpy as np
import pytest

from lexweave.llm import html_text
from tests.llm.helpers import prose

SCHEMA = "page_id long, url string, html string, host string, blocks int"


def texts(page):
    return [t for t, _ in html_text.blocks(page)]


@pytest.mark.parametrize(
    "page,want",
    [
        ("<article><h1>T</h1><p><b>a<br>b<p>c</p> d &amp; &#233;&nbsp;e</article>", ["T", "a b", "c", "d & é e"]),
        ("<nav><ul><li>m</ul></nav><article>x<script>var t='</p>'</script>y</article><footer>f</footer>", ["xy"]),
        ("<body><header>h</header><main><header><h1>T</h1></header>x<aside>s</aside></main><div class='cookie-notice'>c</div>", ["T", "x"]),
        ("<article>a<section id='comments'>no<p>no</section>b<div class=\"ad-slot big\">no</div><form>no</form></article>", ["a", "b"]),
        ("<article>cut off <!-- never closed ", ["cut off"]),
        ("<article>a < b <style>x", ["a < b"]),
        ("<article><p>one<div>two</div>three</article>", ["one", "two", "three"]),
        ("<ARTICLE><TABLE><TR><TD>a<TD>b<TR><TD>c</TABLE></ARTICLE>", ["a", "b", "c"]),
        ("<article><p hidden>no</p><p>yes</p><p aria-hidden=\"true\">no</p></article>", ["yes"]),
        ("", []),
        ("plain  text\n here", ["plain text here"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("run", [1, 2, 3, 5, 8])
def test_suffix_classes(run):
    codes = np.random.default_rng(run).integers(0, 3, 200)
    order, rank = html_text.suffix_classes(codes, run)
    part = [tuple(codes[i : i + run]) for i in range(200)]
    assert [part[i] for i in order] == sorted(part)
    assert all((part[i] == part[j]) == (rank[i] == rank[j]) for i in range(0, 200, 7) for j in range(200))
    assert html_text.suffix_classes(np.zeros(0, np.int64), run)[1].size == 0


def brute(pages, run):
    """Words of open blocks in runs that two different pages of a host hold, found by comparing all runs."""
    held = {}
    for page, (host, blocks) in pages.items():
        for b in blocks:
            w = b.split()
            for i in range(len(w) - run + 1):
                held.setdefault((host, *w[i : i + run]), set()).add(tuple(blocks))
    out = {}
    for page, (host, blocks) in pages.items():
        lines = []
        for b in blocks:
            w = b.split()
            bad = {i + k for i in range(len(w) - run + 1) if len(held[(host, *w[i : i + run])]) > 1 for k in range(run)}
            lines.append(" ".join(x for i, x in enumerate(w) if i not in bad))
        out[page] = "\n".join(x for x in lines if x)
    return out


@pytest.mark.parametrize("chunk", [3, 1000])
def test_repeated_runs_are_removed(spark, chunk):
    draw = random.Random(4)
    shared = [prose(s, 12) for s in range(4)]
    pages = {}
    for p in range(40):
        made = [prose(1000 + p * 10 + k, draw.randint(1, 25)) for k in range(3)]
        made.insert(draw.randint(0, 3), draw.choice(shared))
        made[0] += " " + " ".join(draw.choice(shared).split()[:7])
        pages[p] = (f"h{p % 3}.example", made)
    pages[40] = pages[39]  # the same page again is no other page
    rows = [(p, f"http://u@H{h[1:]}:80/x/{p}", "".join(f"<div>{b}</div>" for b in blocks), "clash", 1) for p, (h, blocks) in pages.items()]
    made = html_text.main_text(spark.createDataFrame(rows, SCHEMA), chunk_pages=chunk).collect()
    assert {r["page_id"]: r["text"] for r in made} == brute(pages, html_text.RUN)
    assert all(r["n_chars"] == len(r["text"]) for r in made)


def test_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (None, "x", "<article>é\U0001f600</article>", "", 0), (4, "u", "<p>" + "w " * 50_000, "", 0), (4, "u", "<p>" + "w " * 50_000, "", 0)]
    made = html_text.main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in made) == [(0, 2), (1, 0), (2, 0), (4, 99_999), (4, 99_999)]
    assert html_text.main_text(spark.createDataFrame([], SCHEMA)).count() == 0
