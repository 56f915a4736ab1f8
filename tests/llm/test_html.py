import pytest

from corpuslab.llm import op9_html as h

ARTICLE = "<article><h1>Head &amp; title</h1><p><b>One two.<br><p>Three   four&nbsp;five.</p><ul><li>x<li>y</ul></article>"
TEXT = "Head & title One two. Three four five. x y"


def page(body):
    return ("<!DOCTYPE html><html lang='en'><head><title>no</title><style>p{}</style><script>var t='</p>';</script></head><body>"
            f"<nav><ul><li><a href='/a'>menu</a></li></ul></nav><!-- ad --><div class=\"ad\">buy</div>{body}<footer>&copy; foot</footer></body></html>")


@pytest.mark.parametrize("body", [
    ARTICLE,
    f"<div id='content-12' class='post-7 main'>{ARTICLE}</div>",
    ARTICLE.replace("article>", "div>").replace("<div>", "<div class='entry'>"),
    ARTICLE + "<section class='comments'><p>A reader wrote a very long comment about all this and more of it, and so on, at length.</p></section>",
    "<header><p>site</p></header><aside><p>side</p></aside>" + ARTICLE + "<form><p>mail</p><input name=x></form><div role='dialog'><p>cookies</p></div>",
    ARTICLE.replace("<ul>", "<div class='cookie-notice'><p>cookies</p></div><script>if (a<b) x('<p>no</p>')</script><ul>"),
])
def test_article_only(body):
    assert h.extract(*h.blocks(page(body)), None) == TEXT


def test_host_votes_decide(spark):
    odd = "<div class='promo-text1'><p>short</p></div><article><p>tiny</p></article><section><p>" + "a longer passage beside the article " * 3 + "</p></section>"
    rows = [(i, f"http://host.example.com/{i}", page(ARTICLE.replace("One", f"One {i}"))) for i in range(30)]
    rows += [(100, "http://host.example.com/odd", page(odd)), (101, "http://other.net/", page(ARTICLE)), (None, None, None), (102, "http://x.org/", ""),
             (102, "http://x.org/", ""), (103, None, "just text"), (104, "http://x.org/1", "<p>unclosed <i>tags &lt;b&gt; " + "word " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'c' AS host", "'c' AS salt", "'c' AS paths", "'c' AS text", "'c' AS n")
    got = {}
    for r in h.main_text(pages).collect():
        got.setdefault(r.page_id, []).append(r.text)
    assert len(got) == len({r[0] for r in rows}) and sum(map(len, got.values())) == len(rows)
    assert got[3] == [TEXT.replace("One", "One 3")] and got[101] == [TEXT]
    assert got[100] == ["tiny"]  # the host's path, though another container is longer
    assert got[102] == ["", ""] and got[None] == [""] and got[103] == ["just text"]
    assert got[104] == [("unclosed tags <b> " + "word " * 50_000).strip()]
    assert h.main_text(pages.limit(0)).count() == 0


def test_white_space_and_references():
    assert h.extract(*h.blocks("<body><p> a\n\t b&#x2014;c </p><p>  </p><p>d<span>e</span> f</p></body>"), None) == "a b—c de f"
    assert h.extract(*h.blocks("a < b and c > d"), None) == "a < b and c > d"


@pytest.mark.parametrize("wrapper", ["class='layout has-sidebar'", "class='with-sidebar'", "id='comments-open'", "class='social-enabled'",
                                     "class='sidebar-layout'", "class='header-fixed page'", "role='banner'"])
def test_article_in_a_wrapper_named_like_a_part_beside_it(wrapper):
    comments = "<section class='comments'><p>A reader wrote.</p><article class='comment'><p>And one more, longer than all of it.</p></article></section>"
    assert h.extract(*h.blocks(page(f"<div {wrapper}>{ARTICLE}{comments}<div class='sidebar'>side</div></div>")), None) == TEXT
    assert h.extract(*h.blocks(page(f"<div {wrapper}><div>{ARTICLE[9:-10]}</div>{comments}</div>")), None) == TEXT


@pytest.mark.parametrize("top", ["<html><head><title>t</title><body>", "<head><meta charset=x><link rel=y><script>a</script>", "<html><head><style>p{}</style><div>",
                                 "<head><title>t</title></head><body>", "<html><head><noscript><p>no</p></noscript><BODY class='x'>"])
def test_head_without_an_end_tag(top):
    assert h.extract(*h.blocks(top + ARTICLE), None) == TEXT
    assert h.extract(*h.blocks("<head><title>t</title>\n plain text"), None) == "plain text"


def test_inline_parts_beside_the_article_are_left_out():
    body = "<article><p>Before<span class='share-buttons'>Share <b>this</b></span>after <i class='has-comments'>and</i> on.</p></article>"
    assert h.extract(*h.blocks(page(body)), None) == "Before after and on."


@pytest.mark.parametrize("part", ["<p class='share-price'>Kept here.</p>", "<p class='related-work'>Kept here.</p>", "<table><tr><td class='widget-name'>Kept here.</table>",
                                  "<div class='article-header'><h2>Kept here.</h2></div>", "<p class=x' >Kept here.</p>", "<p title=\"a>b\">Kept here.</p>",
                                  "<p data-x='class=ad'>Kept here.</p>", "<p class=\"lead\" title='it=\"s'>Kept here.</p>"])
def test_article_text_is_kept(part):
    body = ARTICLE.replace("<ul>", f"{part}<ul>")
    assert h.extract(*h.blocks(page(body)), None) == TEXT.replace("x y", "Kept here. x y")


@pytest.mark.parametrize("part", ["class='site-header'", "class='ad-slot'", "id='cookie-banner'", "class='box ad300x250'", "class='top-nav'", "id=sidebar-left"])
def test_parts_named_by_a_whole_class_are_left_out(part):
    body = ARTICLE.replace("<ul>", f"<div {part}><p>Not here.</p></div><ul>")
    assert h.extract(*h.blocks(page(body)), None) == TEXT


@pytest.mark.parametrize("tag", ["<div>", "<div class='ad{}'>", "<li>", "<b>", "<span class='share'>", "<p><ul><li>"])
def test_deep_pages_take_time_in_proportion(tag):
    import time

    deep = "".join(tag.replace("{}", str(i)) + "w " for i in range(20_000))
    start = time.time()
    text = h.extract(*h.blocks("<article><p>Start.</p>" + deep + "</i></section>" * 2000), None)
    assert text.startswith("Start.") and time.time() - start < 5


def test_votes_equal_a_recount(spark):
    bodies = ["<div class='main'>" + ARTICLE + "</div>", "<div class='post'><p>" + "words and more words " * 9 + "</p></div>", ARTICLE]
    rows = [(i, f"http://{'abc'[i % 3]}.org/{i}", page(bodies[(i * i) % 3])) for i in range(90)]
    votes: dict = {}
    for _, url, html in rows:
        path, score = h.best_path(*h.blocks(html))
        if score > 0:
            of = votes.setdefault(url.split("/")[2], {})
            of[path] = of.get(path, 0) + 1
    want = {host: sorted(p - (1 << 63) for p, n in of.items() if n >= 0.1 * sum(of.values())) for host, of in votes.items()}
    got = h.consensus(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.host: sorted(r.paths) for r in got} == want
