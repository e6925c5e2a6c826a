"""Main text of web pages."""

import random

import pytest

from tillflow.llm import wrappers

RNG = random.Random(9)


def words(n):
    return " ".join("".join(RNG.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))


def texts_of(sources):
    pages = [wrappers.parse(s) for s in sources]
    if len(pages) > 1:
        wrappers.induce(pages)
    return [wrappers.main_text(p) for p in pages]


@pytest.mark.parametrize("n_pages", [1, 12])
def test_names_in_the_article(n_pages):
    kept = ["<h2 id='search-algorithms'>{}</h2>", "<section id='related-work'><p>{}</p></section>", "<section id='social-history'>{}</section>",
            "<p class='notice-period'>{}</p>", "<div id='legal-basis'>{}</div>", "<h3 id='comments'>{}</h3>"]
    gone = ["<div class='ad'>{}</div>", "<div class='related-posts'>{}</div>", "<ul role='navigation'><li>{}</ul>", "<div id='comments'>{}</div>"]
    sources, want = [], []
    for _ in range(n_pages):
        texts = [words(5) for _ in kept]
        blocks = [k.format(t) for k, t in zip(kept, texts, strict=True)] + [g.format(words(5)) for g in gone]
        sources.append("<body><article><h1>Title</h1>" + "".join(blocks) + "</article></body>")
        want.append("\n".join(texts))
    assert [t.removeprefix("Title\n") for t in texts_of(sources)] == want


def test_deep_pages():
    """Unlike pages of thousands of nested elements are aligned, not refused."""
    sources, want = [], []
    for i in range(4):
        depth, inner = 5000 + i, words(6)
        sources.append("<body><article>" + "<div>" * depth + f"<p>{inner}</p>" + "<b>x</b>" * (i % 2) + "</div>" * depth + "</article></body>")
        want.append(inner + "\nx" * (i % 2))
    assert texts_of(sources) == want


def tree_matching(a, b):
    """Brute force: the largest matching of two trees, by the recursion that defines it."""
    if a.tag != b.tag:
        return 0
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + tree_matching(x, y))
    return 1 + best[-1][-1]


def test_tree_matching_against_brute_force():
    rng = random.Random(5)

    def tree(depth):
        inner = "".join(tree(depth - 1) for _ in range(rng.randrange(4))) if depth else ""
        tag = rng.choice(["div", "span", "ul"])
        return f"<{tag}>{inner}{'x' * rng.randrange(2)}</{tag}>"

    for _ in range(60):
        one, two = (wrappers.parse(tree(4)) for _ in range(2))
        shapes = wrappers.Shapes()
        assert shapes.match(shapes.number(one), shapes.number(two)) == tree_matching(one, two)


@pytest.mark.parametrize("copies", [1, 3])
def test_edge_pages(spark, copies):
    """Null, empty and repeated pages, no URL, columns of clashing names; and an empty table."""
    rows = [(1, "http://h.org/1", None), (2, "http://h.org/2", ""), (3, None, "<p>three</p>"), (None, None, None)] * copies
    schema = "page_id long, url string, html string"
    got = wrappers.extract(spark.createDataFrame([(*r, "x", "y", 1) for r in rows], f"{schema}, host string, text string, part int"))
    assert got.columns == ["page_id", "url", "text"]
    want = [(1, "http://h.org/1", ""), (2, "http://h.org/2", ""), (3, None, "three"), (None, None, "")] * copies
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert wrappers.extract(spark.createDataFrame([], schema)).count() == 0


def test_formulas_are_kept():
    formula = "<math><semantics><mrow><mi>a</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding='application/x-tex'>a=2</annotation></semantics></math>"
    assert texts_of([f"<article><p>Let {formula} hold.</p></article>"]) == ["Let a=2 hold."]


def page(blocks, top="Our unnamed banner here", end="Made with care by us"):
    return f"<body><div>{top}</div><article>{''.join(f'<p>{b}</p>' for b in blocks)}</article><div>{end}</div></body>"


def test_near_copies_of_an_article_are_no_template():
    article = [words(20) for _ in range(6)]
    sources, want = [], []
    for i in range(30):
        blocks = [words(20) for _ in range(6)] if i % 15 == 14 else [*article[:5], words(5)]
        sources.append(page([*blocks, "Share this story"]))
        want.append("\n".join([*blocks, "Share this story"]))
    assert texts_of(sources) == want


def test_what_different_articles_share_is_template():
    blocks = [[words(20) for _ in range(4)] for _ in range(12)]
    copies = [[*b[:3], words(4)] for b in blocks for _ in range(3)]
    assert texts_of([page([*b, "Share this story"]) for b in blocks + copies]) == ["\n".join(b) for b in blocks + copies]


def test_layouts_do_not_disturb_each_other():
    usual = [f"<body><div>Unnamed banner</div><div><p>{words(9)}</p><p>{words(9)}</p></div><div>Made by us</div></body>" for _ in range(20)]
    rare = [f"<body><table><tr><td>Old banner<td>{words(9)}<tr><td>Old end</table></body>" for _ in range(5)]
    lone = ["<body><center><h1>One of a kind</h1></center></body>"]
    for sources in (rare + usual + lone, usual + lone + rare, lone + rare + usual):
        for source, text in zip(sources, texts_of(sources), strict=True):
            assert "anner" not in text and "Made by" not in text and "Old end" not in text
            assert all(len(w) == 6 for w in text.split()) and text if source not in lone else text == "One of a kind"


def test_the_order_of_rows_does_not_matter(spark):
    RNG.seed(10)
    sources = [page([words(9)] * RNG.randint(1, 3)) if i % 3 else f"<body><table><tr><td>Old banner<td>{words(9)}</table></body>" for i in range(40)]
    rows = [(i, "http://a.example/x", s) for i, s in enumerate(sources)]
    found = []
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[0] * 7 % 40)):
        df = spark.createDataFrame(order, "page_id long, url string, html string").coalesce(1)
        found.append({r.page_id: r.text for r in wrappers.extract(df).collect()})
    assert found[0] == found[1] == found[2] and not any("banner" in t for t in found[0].values())
