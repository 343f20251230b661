import html
import random
import re

from corpus_fixtures import SMALL, prepared  # noqa: F401
import pytest

from quadrille.llm.html_text import main_texts
from quadrille.llm.queries import QUERIES
from quadrille.llm.wrappers import KIDS, LABEL, OPTIONAL, REPEATED, TEXT, aligned, dumps, extract, loads, merge, read, wrapper


def learnt(*pages):
    found = wrapper(read(pages[0]))
    for page in pages[1:]:
        found = merge(found, wrapper(read(page)))
    return found


def shape(node):
    mark = ("?" if node[OPTIONAL] else "") + ("+" if node[REPEATED] else "")
    if node[LABEL] == "#":
        return ("slot" if node[TEXT] is None else "text") + mark
    return f"{node[LABEL]}[{' '.join(map(shape, node[KIDS]))}]" + mark


def test_mismatches_become_slots_options_and_repeats():
    found = learnt("<ul><li>a</li><li>b</li></ul><p>same</p>", "<ul><li>a</li></ul><div>x</div><p>same</p>")
    assert shape(found) == "[ul[li[slot]+] div[text]? p[text]]"
    found = learnt("<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>e<dd>f</dl>")
    assert shape(found) == "[dl[([dt[slot] dd[slot]]+]]"
    assert shape(learnt("<p>a", "<p>a", "<p>a")) == "[p[text]]"


def test_order_of_pages_does_not_change_what_is_extracted():
    pages = ["<div>Shop</div><div>one</div><div>end</div>", "<div>Shop</div><div>two</div><p>more</p><div>end</div>", "<div>Shop</div><div>three</div><div>end</div>"]
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        found = learnt(*[pages[k] for k in order])
        assert extract(read(pages[0]), found).split()[0] in ("one", "Shop")


ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>no</article>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><div class="cookie-notice"><p>We use cookies</p></div>
<div class="ad">Buy</div><main><article><h1>Ti&shy;tle &amp; more</h1><p>On<b>e</b>&nbsp;two<br>three
 four<p>five &lt;b&gt;<div class="advert">Buy more</div><aside>See also</aside><form><label>Mail</label><input></form>
<ul><li>six<li>seven</ul><table><tr><td>8<td>9</table></article><section id="comments"><article class="comment"><p>Nice!</p></article></section></main>
<aside class="sidebar">Related</aside><!-- <p>gone</p> --><footer>&copy; me</footer>"""


def test_an_article_without_all_the_rest():
    assert extract(read(ARTICLE), learnt(ARTICLE)) == "Ti\xadtle & more One two three four five <b> six seven 8 9"


@pytest.mark.parametrize("page, want", [
    ("", ""), ("just text", "just text"), ("<p>a<p>b", "a b"), ("<main><p>a</main><p>b", "a"), ("<div class='post-content'>a</div><div>b</div>", "a"),
    ("<div role=main>a</div>b", "a"), ("<nav>a</nav>", ""), ("<article>a < b & c", "a < b & c"), ("<article><p>a</div></article>b", "a"),
    ("<article>x<script>", "x"), ("<article>x<!-- y", "x"), ("<article><p hidden>a</p>b", "b"), ('<article title="a>b">c', "c"), ('<article title="a>b', "b"),
])
def test_small_and_broken_pages(page, want):
    assert extract(read(page), learnt(page)) == want


def test_without_a_marked_main_part_what_every_page_says_is_left_out():
    pages = [f"<div>Welcome to the shop</div><div><p>{t}</p></div><div>All rights reserved</div>" for t in ("one", "two", "three")]
    assert [extract(read(p), learnt(*pages)) for p in pages] == ["one", "two", "three"]


def test_optional_texts_are_kept_without_a_marked_main_part():
    pages = ["<div>Shop</div><div>one</div><div>end</div>", "<div>Shop</div><div>two</div><p>more</p><div>end</div>", "<div>Shop</div><div>three</div><div>end</div>"]
    assert "more" in extract(read(pages[1]), learnt(*pages)).split()
    pages = [f"<h2>Shop</h2><div>{t}</div>{extra}<h3>end</h3>" for t, extra in (("one", ""), ("two", "<section><p>sold out</p></section>"), ("three", "<section><p>sold out</p></section>"))]
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        assert [extract(read(p), learnt(*[pages[k] for k in order])) for p in pages] == ["one", "two sold out", "three sold out"]


def test_one_page_says_nothing_of_what_is_fixed():
    page = "<body><h1>T</h1><div>long main text</div><ul><li>a<li>b</ul></body>"
    for pages in ([page], [page, page], [page, "", page], ["", page]):
        assert extract(read(page), learnt(*pages)) == "T long main text a b"


def test_the_wrapper_decides_within_an_article_too():
    pages = [f"<nav>Menu</nav><article><h1>{t}</h1><div class='x1'>Thanks for reading</div>{''.join(f'<p>{t} {k}' for k in range(n))}<div>Our shop is open</div></article>"
             for t, n in (("one", 1), ("two", 2), ("three", 3), ("four", 1))]
    want = ["one one 0", "two two 0 two 1", "three three 0 three 1 three 2", "four four 0"]
    for order in ((0, 1, 2, 3), (3, 2, 1, 0), (1, 0, 3, 2)):
        assert [extract(read(p), learnt(*[pages[k] for k in order])) for p in pages] == want


def test_texts_of_an_article_that_may_be_its_own_are_kept():
    same = "<article><p>all alike</article>"  # nothing of the article differs: it is kept whole
    pages = [f"<div>{k}</div>{same}" for k in range(4)]
    assert {extract(read(p), learnt(*pages)) for p in pages} == {"all alike"}
    pages = [f"<article><h1>{k}</h1><table><tr><td>yes<td>{k}<tr><td>yes<td>{k}</table>{'<div>sold out</div>' * (k > 1)}</article>" for k in range(4)]
    assert extract(read(pages[2]), learnt(*pages)) == "2 yes 2 yes 2 sold out"
    assert extract(read(pages[0]), learnt(*pages[:2])) == "0 yes 0 yes 0"


def test_rows_of_all_kinds(spark):
    rows = [(1, "http://A.example/x", "<article><p>a</article>", "u"), (1, "http://a.example/y", "<article><p>b<p>c</article>", "u"), (None, None, "<p>d", "u"),
            (4, "nonsense", None, "u"), (5, "http://a.example/z", "", "u"), (6, "http://b.example", "<article>" + "<p>w" * 50_000, "u")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = sorted(((r.page_id, r.url, r.text[:7], r.n_chars) for r in main_texts(pages).collect()), key=repr)
    assert found == sorted([(1, rows[0][1], "a", 1), (1, rows[1][1], "b c", 3), (None, None, "d", 1), (4, "nonsense", "", 0), (5, rows[4][1], "", 0), (6, rows[5][1], "w w w w", 99_999)], key=repr)
    assert main_texts(pages.limit(0)).count() == 0


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    found = QUERIES["op9_html_extraction"](spark, SMALL).collect()
    assert len(found) == len(pages)
    for r in found:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        want = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br)>", " ", body))).split())
        assert (r.text, r.n_chars) == (want, len(want))


def test_deep_pages(spark):
    for tag in ("div", "blockquote", "ul><li", "center", "article"):
        page = f"<{tag}>" * 100_000 + "deep" if tag == "div" else f"<{tag}>" * 3000 + "deep"
        found = learnt(page, page.replace("deep", "other"), page)
        assert extract(read(page), loads(dumps(found))) == "deep"
    page = "<div>" * 1000 + "text" + "</div>" * 1000 + "</p>" * 1000
    pages = spark.createDataFrame([(k, "http://a.example/", page.replace("text", f"text{k}")) for k in range(4)], "page_id long, url string, html string")
    assert sorted(r.text for r in main_texts(pages).collect()) == ["text0", "text1", "text2", "text3"]


def test_many_siblings():
    one = "".join(f"<x-{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}{chr(97 + k // 17576)}>{k}</x>" for k in range(50_000))
    two = "<b-x>first</b-x>" + one.replace("<x-a", "<y-a")
    found = learnt(one, two)
    assert extract(read(one), found).split() == [str(k) for k in range(50_000)]


def lengths(a, b):
    """Lengths of longest common subsequences of all rests, by the table of them."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    return best


def test_alignment_is_a_longest_one():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.choice("abcde"[:rng.randint(1, 5)]) for _ in range(rng.randint(0, 25))] for _ in range(2))
        pairs = aligned([[x, False, False, [], None, 1] for x in a], [[x, False, False, [], None, 1] for x in b])
        assert [i for i, _ in pairs if i is not None] == list(range(len(a))) and [j for _, j in pairs if j is not None] == list(range(len(b)))
        met = [(i, j) for i, j in pairs if i is not None and j is not None]
        assert all(a[i] == b[j] for i, j in met) and len(met) == lengths(a, b)[0][0]


@pytest.mark.parametrize("mark", ["share-price", "related-work", "comments-on-method", "social-history", "ad-hoc", "notice-of-intent", "banner-years", "story-login"])
def test_compound_names_have_a_sense_of_their_own(mark):
    for page in (f"<article><p>a</p><div class='{mark}'>b</div></article>", f"<article><p>a</p><div id='{mark}'>b</div></article>", f"<p>a</p><div class='{mark}'>b</div>"):
        assert extract(read(page), learnt(page)) == "a b"


@pytest.mark.parametrize("mark", ["advert", "cookie-notice", "site-footer", "main-nav", "has-sidebar left-sidebar", "share-buttons", "comments_list", "related"])
def test_names_of_what_is_no_article(mark):
    page = f"<p>a</p><div class='{mark}'>b</div>"
    assert extract(read(page), learnt(page)) == "a"


def test_formulas_stay_and_the_greater_part_wins():
    page = "<article><p>x is <math><mi>x</mi><mo>=</mo><mn>1</mn></math></article>"
    assert extract(read(page), learnt(page)) == "x is x = 1"
    page = "<article class='teaser'><p>Read on</article><main><p>a long main text that is no teaser</main>"
    assert extract(read(page), learnt(page)) == "a long main text that is no teaser"
    page = "<main><article><p>a long article with many words</article><p>next</main>"
    assert extract(read(page), learnt(page)) == "a long article with many words"


def test_equal_texts_of_an_article_stay():
    pages = [f"<article><h1>Daily weather</h1><p>No rain is expected.</p><div>a{k}</div></article>" for k in range(4)]
    assert [extract(read(p), learnt(*pages)) for p in pages] == [f"Daily weather No rain is expected. a{k}" for k in range(4)]


def test_the_wrapper_changes_the_result_of_pages_without_an_article(spark):
    def page(k):
        return (f"<div class='a1'>Shop of Wörth</div><div class='x'><h2>Item {k}</h2>" + "".join(f"<p>text {k} {j}" for j in range(1 + k % 3))
                + ("<section>only some have it</section>" if k % 4 == 0 else "") + "</div><div class='z'>Call us at any time</div>")

    pages = spark.createDataFrame([(k, f"https://s.example/{k}", page(k)) for k in range(40)], "page_id long, url string, html string").repartition(7)
    found = {r.page_id: r.text for r in main_texts(pages).collect()}
    for k in range(40):
        assert found[k] == " ".join([f"Item {k}", *[f"text {k} {j}" for j in range(1 + k % 3)], *["only some have it"] * (k % 4 == 0)])
        assert extract(read(page(k)), wrapper(["", []])) == f"Shop of Wörth {found[k]} Call us at any time"
