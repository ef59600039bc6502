import random

from muster.llm import wrappers
from muster.llm.wrappers import Trees, blocks, extract_pages, induce, keys_of, main_text, outline

ARTICLE = "<article><h1>T&eacute; &lt;1&gt;</h1><p>One<br>two&nbsp; \n three<p>4 < 5 &amp; 6<ul><li>a<li>b <b>c</b></ul></article>"
TEXT = "Té <1>\nOne two three\n4 < 5 & 6\na\nb c"


def page(body, title="x"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='</p>';</script></head><body>{body}</body></html>"


def test_article_without_the_rest():
    body = (
        '<header><h1>Site</h1></header><nav><ul><li><a href="/">menu</a></ul></nav><!-- ad --><div class="ad">buy</div>'
        f'<div class="cookie-notice">we use</div><aside>side</aside>{ARTICLE}<section id="comments"><p>me too</p></section>'
        '<form><p>mail</p><input></form><footer>&copy; x</footer>'
    )
    assert main_text(page(body)) == TEXT
    assert main_text(page(ARTICLE)) == main_text(ARTICLE) == TEXT
    assert main_text(page("<main><p>a</p><div class='comment-list'><p>no</p></div><p>b</p></main>")) == "a\nb"


def test_unusual_markup():
    assert main_text("") == ""
    assert main_text("just text") == "just text"
    assert main_text("<p>a</p></div></p>b<p hidden>c</p><p style='display: none'>d</p>") == "a\nb"
    assert main_text("<p title='a > b'>x</p><!-- <p>y</p> --><p>z") == "x\nz"
    assert main_text("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n2\n3"
    assert main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("<p>open <b>bold<p>next <script>never closed") == "open bold\nnext"


def tree(trees, page):
    found = blocks(page)[0]
    return trees.build(*outline(found, keys_of(found)))


def plain_size(x, y):
    """Simple tree matching as plain recursion over first children."""
    if x.name != y.name:
        return 0

    def best(i, j):
        if i == len(x.children) or j == len(y.children):
            return 0
        both = plain_size(x.children[i], y.children[j])
        return max(best(i + 1, j), best(i, j + 1), both + best(i + 1, j + 1) if both else 0)

    return 1 + best(0, 0)


def random_page(draw, depth=0):
    tags = ["div", "ul", "section", "p", "div class=a"]
    out = []
    for _ in range(draw.randint(1, 3)):
        tag = draw.choice(tags)
        inner = random_page(draw, depth + 1) if depth < 2 and tag != "p" and draw.random() < 0.7 else draw.choice("xyz")
        out.append(f"<{tag}>{inner}</{tag.split()[0]}>")
    return "".join(out)


def test_tree_matching_is_plain_recursion(monkeypatch):
    draw = random.Random(3)
    for cells in (1 << 20, 2):
        monkeypatch.setattr(wrappers, "CELLS", cells)
        for _ in range(150):
            trees = Trees()
            one, other = tree(trees, random_page(draw)), tree(trees, random_page(draw))
            pairs = list(trees.pairs(one, other))
            assert trees.size(one, other) == len(pairs) == plain_size(one, other)
            assert all(x.name == y.name for x, y in pairs)
            assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)


def test_long_pages_are_aligned():
    draw = random.Random(4)
    trees = Trees()
    one, other = (tree(trees, "".join(f"<{t}>x</{t}>" for t in draw.choices(["p", "h2", "div"], k=3000))) for _ in range(2))
    pairs = list(trees.pairs(one, other))
    assert trees.size(one, other) == len(pairs) > 4000


def test_names_that_contain_a_word_do_not_empty_a_page():
    text = "<h1>Title</h1><p>All the text of it.</p>"
    want = "Title\nAll the text of it."
    for body in (
        f"<article class='post has-sidebar'>{text}</article>", f"<div id=page class='no-sidebar'><article>{text}</article></div>",
        f"<form action=/><article>{text}</article></form>", f"<form action=/>{text}</form>", f"<main><section class='related-work'>{text}</section></main>",
        f"<main><section id='social-history'>{text}</section></main>", f"<div class='sticky-footer'>{text}</div>",
        "<article><div class='post-header'><h1>Title</h1></div><p>All the text of it.</p></article>",
    ):
        assert main_text(page(f"<nav><p>menu</p></nav>{body}<div class='related-posts'>more of it, and more of that as well, and still more</div>")) == want, body
    for gone in ("related-posts", "comment-list", "share-buttons", "ad", "widget", "newsletter-signup"):
        assert main_text(f"<article>{text}<div class='{gone}'>{'something else ' * 9}</div></article>") == want, gone


def template_of(pages):
    return frozenset(induce(pages))


def test_constant_blocks_are_template():
    pages = [page(f"<div class='top'>My site</div><div class='body'><div>text {i}</div><div>Read more</div></div>") for i in range(5)]
    template = template_of(pages)
    assert len(template) == 2
    assert [main_text(p) for p in pages] == [f"My site\ntext {i}\nRead more" for i in range(5)]
    assert [main_text(p, template) for p in pages] == [f"text {i}" for i in range(5)]
    assert induce(pages[:2]) == [] and induce([pages[0]] * 9) == []
    prose = [page(f"<article><p>Same licence.</p><div>Print</div><p>{i}</p></article>") for i in range(5)]
    assert main_text(prose[0], template_of(prose)) == "Same licence.\n0"


def test_layouts_notices_and_headings_of_a_host():
    lists = [page(f"<div class=top>My site</div><table><tr><td>{i}</td><td>cells of {i}</td></tr></table><div>Next</div>") for i in range(6)]
    posts = [page(f"<div class=top>My site</div>{'<div class=box>Closed on Monday</div>' if i % 2 else ''}<div class='post-header'><h1>Title {i}</h1></div>"
                  f"<section><p>Text number {i} of the page {i}.</p><p>It has {i} more.</p></section><div>Next</div>") for i in range(40)]
    template = template_of(lists + posts)
    assert [main_text(p, template) for p in lists] == [f"{i}\ncells of {i}" for i in range(6)]
    assert [main_text(p, template) for p in posts] == [f"Title {i}\nText number {i} of the page {i}.\nIt has {i} more." for i in range(40)]


def test_text_outside_a_short_article():
    pages = [page(f"<article><h2>Teaser {i}</h2></article><div>Top</div><div><p>{f'The long text {i} of the page. ' * 5}</p></div>") for i in range(5)]
    assert main_text(pages[1], template_of(pages)) == "Teaser 1\n" + ("The long text 1 of the page. " * 5).strip()


def test_rings_of_a_large_host(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "RING_PAGES", 16)
    body = "<div class='top'>My site</div><div class='body'><div>text {}</div><div>Read more</div></div>"
    pages = [(i, f"http://h.example/{i}", page(body.format(i % 200))) for i in range(300)]
    pages += [(1000 + i, "http://two.example/", page(body.format(i))) for i in range(2)]
    for parts in (1, 7):
        rows = extract_pages(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts)).collect()
        text = {r.page_id: r.text for r in rows}
        assert len(rows) == 302 and all(text[i] == f"text {i % 200}" for i in range(300))
        assert text[1000] == "My site\ntext 0\nRead more"


def test_pages(spark):
    pages = [(i, f"http://h.example/{i}", page(f"<div class='top'>My site</div><div>text {i}</div>"), "x") for i in range(12)]
    pages += [(20, "http://other.example", page(ARTICLE), "x"), (21, None, ARTICLE, "x"), (22, "http://h.example/n", None, "x"), (23, "u", "", "x"), pages[0], (None, "http://h.example/z", pages[3][2], "x"),
              (24, "http://h.example/long", page("<div>" + "word " * 100000 + "</div>"), "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, template string").repartition(3)
    rows = extract_pages(frame).collect()
    assert len(rows) == len(pages)
    text = {r.page_id: r.text for r in rows}
    assert all(text[i] == f"text {i}" for i in range(12)) and text[None] == "text 3"
    assert text[20] == text[21] == TEXT and text[22] == text[23] == ""
    assert all(r.n_chars == len(r.text) for r in rows)
    assert extract_pages(frame.limit(0)).collect() == []
