"""Reader, decoding against all choices, and texts of given and made pages."""

import html
import itertools
import random
import re
import time

import numpy as np
import pytest

from feescope.llm import html_dom as D
from feescope.llm import html_extract as E
from feescope.llm.common import table
from feescope.llm.html_layouts import Layout

from llm_fixtures import SF01


@pytest.fixture(scope="module")
def trees(spark):
    return E.train(table(spark, SF01, "pages"))


def article(page):
    """The blocks of a given page's article element, by its own markup."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ")
    parts = re.split(r"</?(?:p|h1)>", inner)
    return "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in parts) if x)


def test_given_pages(spark, trees):
    pages = table(spark, SF01, "pages").collect()
    got = {r.page_id: r for r in E.extract_main_text(table(spark, SF01, "pages"), trees).collect()}
    assert len(got) == len(pages)
    exact = [got[p.page_id].text == article(p.html) for p in pages]
    assert np.mean(exact) >= 0.98
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_made_pages_in_other_designs(spark, trees):
    rng = random.Random("held out")
    blocks = [t for r in table(spark, SF01, "pages").limit(100).collect() for t in D.parse(r.html).text if t]
    scores = []
    for _ in range(150):
        main = [rng.choice(blocks) for _ in range(rng.randint(2, 12))] + [max(rng.sample(blocks, 6), key=len)]
        page = Layout(rng).page(main, blocks)
        dom = D.parse(page)
        want = set(D.main_text(dom, E.node_labels(dom)).split("\n"))
        got = set(E.extract(page, trees).split("\n"))
        scores.append(2 * len(want & got) / (len(want) + len(got)))
    assert np.mean(scores) >= 0.97


def runs(page):
    return [t for t in D.parse(page).text if t]


@pytest.mark.parametrize("page,want", [
    ("", []), ("<p>", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a<p>b", ["a", "b"]), ("<div>a<p>b</p>c</div>", ["a", "b", "c"]),
    ("<p>a <b>b</b>\n c&nbsp;&eacute;<br>d</p>", ["a b c é d"]), ("<ul><li>a<li>b</ul>", ["a", "b"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("<script>if (a<b) x('</p>')</script>t", ["t"]),
    ("<SCRIPT>x</ScRiPt >t<style>p{}</style>", ["t"]), ("<!-- <p>no</p> -->yes<!-- open", ["yes"]), ("<a title='a>b' href=\"x\">l</a>", ["l"]),
    ("<p title=\"open>text</p>", ["text"]), ("a < b", ["a < b"]), ("<b><p>x</b>y</p>z", ["xy", "z"]), ("</p></div>x", ["x"]), ("<title>t</title>x", ["x"]),
    ("<p>&#233;&#x1F600;&bogus;</p>", ["é😀&bogus;"]), ("<textarea><p>in</p></textarea>out", ["out"])])
def test_reader(page, want):
    assert runs(page) == want


@pytest.mark.parametrize("page,want", [
    ("<p data-x=\"" + "x" * 5000 + " a > leaked words\">article</p>", ["article"]),
    ("<p data-x='<b>" + "y>" * 9000 + "' class=\"a>b\">article</p>", ["article"]),
    ("<p data-x = \"" + "x>" * 5000 + "\" data-y='>'>a</p><p title=\"open>b</p>", ["a", "b"]),
    ("<p don't>it's</p>", ["it's"]), ("<p a=\"b\"", ["<p a=\"b\""])])
def test_long_and_open_attribute_values(page, want):
    assert runs(page) == want


@pytest.mark.parametrize("page,want", [
    ("\u0130<SCRIPT>x</SCRIPT><p>a</p><Style>p{}</STYLE><p>b</p>", ["\u0130", "a", "b"]),
    ("\u0130<TITLE>t</TITLE><p>a</p>", ["\u0130", "a"]), ("<script>'</scripts>'</script>a", ["a"]), ("<style>a", []),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", ["so x=2 holds"]), ("<p>a<xmp><b>c</b> &amp;</XMP>d", ["a", "<b>c</b> &amp;", "d"]),
    ("<p>see <object data=x>the file</object></p>", ["see the file"]), ("<p>a <noscript>b</noscript></p>", ["a b"])])
def test_raw_elements(page, want):
    assert runs(page) == want


@pytest.mark.parametrize("page", ["<p a=\">\" " * 60000, "<p a=\"" * 60000 + ">", "<p a='\" b=\"'" * 60000, "<a " * 60000])
def test_open_tags_take_linear_time(page):
    start = time.process_time()
    D.parse(page)
    assert time.process_time() - start < 5


@pytest.mark.parametrize("page", ["<div>" * 20000 + "</p>" * 20000, "<b>" * 20000 + "</i>" * 20000 + "<p>x", "<span>" * 20000 + "<li>x" * 20000])
def test_stray_end_tags_take_linear_time(page):
    start = time.process_time()
    D.parse(page)
    assert time.process_time() - start < 5


def test_decoding_of_a_wide_tree_takes_linear_time():
    dom = D.Dom()
    dom.add(-1, "body")
    for _ in range(10000):
        dom.text[dom.add(dom.add(0, "div"), "#run")] = "x"
    p = np.array([0.9] + [0.99, 0.4] * 10000)  # each element is kept for one unlikely run
    start = time.process_time()
    assert D.decode(dom, p).all()
    assert time.process_time() - start < 5


def test_training_pages_do_not_depend_on_files(spark):
    pages = table(spark, SF01, "pages")
    kinds = [E.train(p, train_pages=40, trees=3, depth=3) for p in (pages, pages.repartition(5, "url").sortWithinPartitions("html"))]
    dom = D.parse(pages.first().html)
    x = D.features([dom])
    assert kinds[0].probability(x).tolist() == kinds[1].probability(x).tolist()


def random_dom(rng, n):
    dom = D.Dom()
    dom.add(-1, "body")
    for _ in range(n):
        inner = [i for i, t in enumerate(dom.tag) if t != "#run"]
        i = dom.add(rng.choice(inner), rng.choice(["div", "#run", "#run"]))
        dom.text[i] = "x" if dom.tag[i] == "#run" else ""
    return dom


@pytest.mark.parametrize("seed", range(30))
def test_decoding_is_the_best_consistent_choice(seed):
    rng = random.Random(seed)
    dom = random_dom(rng, rng.randrange(1, 9))
    p = np.array([rng.uniform(0.02, 0.98) for _ in dom.tag])
    n = len(p)

    def consistent(keep):
        for i in range(n):
            if keep[i] and i and not keep[dom.parent[i]]:
                return False
            if keep[i] and not dom.text[i] and not any(keep[c] for c in range(n) if dom.parent[c] == i):
                return False
        return True

    best = max((k for k in itertools.product((False, True), repeat=n) if consistent(k)),
               key=lambda k: sum(np.log(p[i] if k[i] else 1 - p[i]) for i in range(n)))
    assert D.decode(dom, p).tolist() == list(best)


def test_features_do_not_depend_on_the_batch(spark):
    doms = [D.parse(r.html) for r in table(spark, SF01, "pages").limit(12).collect()] + [D.parse("")]
    together = D.features(doms)
    alone = np.concatenate([D.features([d]) for d in doms])
    assert together.shape[1] == len(D.FEATURES) and np.array_equal(together, alone)


def test_edges(spark, trees):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<html><body></body></html>"), (4, "u", "<nav><a href=x>m</a></nav>"), (None, "u", "<p>" * 3000),
            (6, "u", "<div class=\"" * 500), (7, "u", "<p>" + "word " * 200000 + "</p>"), (7, "u", "<p>" + "word " * 200000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = E.extract_main_text(df, trees).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2, 3)] == [""] * 3
    assert E.extract_main_text(df.limit(0), trees).count() == 0


def test_training_on_an_empty_table(spark):
    empty = table(spark, SF01, "pages").limit(0)
    assert E.extract_main_text(empty, E.train(empty, train_pages=20)).count() == 0
