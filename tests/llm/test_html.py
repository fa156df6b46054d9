"""Main text of malformed, enclosed and plain pages."""

import math
import random
import time

import pytest

from postbud.llm import html

BODY = "<h1>Title</h1>" + "".join(f"<p>Sentence number {i} of the article, which is long enough to count.</p>" for i in range(12))
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Menu {i}</a></li>' for i in range(20)) + "</ul>"
ARTICLE = "Title\n" + "\n".join(f"Sentence number {i} of the article, which is long enough to count." for i in range(12))
FRAGMENTS = (
    "<![foo[x]]>", "<b ", "<!--", "-->", "<![CDATA[", '<a href="', "'", '"', "</", "<?x", "<!", "<script>", "</script", "<title>",
    "<p", "&#x;", "&amp", "<form>", "<nav>", "<header>", "</header>", "<td>", "<li>", "</li>", "<table>", "\x00", "<", ">",
)


def test_no_page_raises(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    rng = random.Random(1)
    for page in pages * 4:
        page = (page or "")[:3000]
        for _ in range(6):
            at = rng.randrange(len(page) + 1)
            page = page[:at] + rng.choice(FRAGMENTS) + page[at:]
        assert isinstance(html.extract(page), str)
    for _ in range(2000):
        html.extract("".join(rng.choice((*FRAGMENTS, "x", " ", "=", "/")) for _ in range(12)))


@pytest.mark.parametrize("junk", ["<b ", "<div><p>x", "<a href=\"x", "<a b='", "<", "</", "<!--", "<!", "<article>x", "<li><ul>", "<p><td>", "<title>", "<header>a<p>", "<form>", "&#"])
def test_time_grows_with_the_length_of_junk(junk):
    def seconds(size):
        page = junk * (size // len(junk))
        start = time.process_time()
        html.extract(page)
        return time.process_time() - start

    assert seconds(1_000_000) < 16 * seconds(125_000) + 2


@pytest.mark.parametrize("page", [
    f"<body><form>{MENU}<div>{BODY}</div></form></body>",
    f"<body><header><h2>Site</h2>{MENU}<article>{BODY}</article></body>",
    f"<body><nav>{MENU}<main>{BODY}</main></body>",
    f"<body><form><header>{MENU}<div>{BODY}</div></body>",
    f"<body><article>{BODY}</article>" + "<article><h3><a href=x>Other story</a></h3><p>Teaser. <a href=x>Read more</a></p></article>" * 4,
    f"<body><header>Site name</header><nav>{MENU}</nav><article>{BODY}</article><form>Name <input></form></body>",
    f"<![foo[x]]><body><nav>{MENU}</nav><article>{BODY}</article>",
    f"<body><article>{BODY}</article><a href=\"x",
    f"<body><title>never closed<article>{BODY}</article>",
])
def test_the_article_comes_through(page):
    found = html.extract(page)
    assert ARTICLE in found and "Menu" not in found and "Teaser" not in found and "Name" not in found


def test_further_articles_that_are_as_dense_stay():
    other = BODY.replace("Sentence", "Statement")
    found = html.extract(f"<body><div><article>{BODY}</article><article>{other}</article></div></body>")
    assert found == ARTICLE + "\n" + ARTICLE.replace("Sentence", "Statement")


def test_references_white_space_comments_and_empty_pages():
    assert html.extract("<p>a &amp; b&nbsp;c &lt;x&gt; &zzz; 1 < 2</p><!-- no --><!-->d<p>e\n\t f<br>g") == "a & b c <x> &zzz; 1 < 2\nd\ne f g"
    assert [html.extract(x) for x in ("", " ", "<", "<p>", "<!doctype html>", "<script>var a = '<p>b</p>';")] == ["", "", "<", "", "", ""]


def test_empty_table_and_odd_rows(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    assert html.main_text(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, None, None, 1, "x"), (None, "u", "", 1, "x"), (1, "u", f"<p>{'word ' * 200_000}</p>", 1, None)] * 2
    found = [tuple(r) for r in html.main_text(spark.createDataFrame(rows, schema)).collect()]
    long = ("word " * 200_000).strip()
    assert sorted(found, key=str) == sorted([(1, None, "", 0), (None, "u", "", 0), (1, "u", long, len(long))] * 2, key=str)


# ---- pages without article and main elements, against a plain reading of the method


def random_page(rng, depth=0):
    """(tag, children) with strings; blocks only, so that every string is one block's."""
    if depth == 4 or rng.random() < 0.25:
        text = " ".join(rng.choice(("alpha", "beta", "gamma")) for _ in range(rng.randint(1, 60)))
        return ("p", [("a", [text])] if rng.random() < 0.3 else [text])
    return ("div", [random_page(rng, depth + 1) for _ in range(rng.randint(1, 5))])


def written(node):
    return node if isinstance(node, str) else f"<{node[0]}>{''.join(map(written, node[1]))}</{node[0]}>"


def counts(node):
    """Characters, tags, characters and tags of links below an element."""
    total = [0, 0, 0, 0]
    for child in node[1]:
        if isinstance(child, str):
            total[0] += len(child.strip())
            continue
        own = counts(child)
        link = child[0] == "a"
        for i, n in enumerate((own[0], own[1] + 1, own[0] if link else own[2], own[3] + link)):
            total[i] += n
    return total


def plain_text(page):
    whole = counts(page)
    ratio = whole[2] / max(whole[0], 1)

    def density(node):
        c, t, lc, lt = counts(node)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
        inner = max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1.0)
        # A page without links has no base to speak of.
        return c / max(t, 1) * (math.log(inner + 1) if base <= 1 else math.log(inner) / math.log(max(base, 1 + 1e-9)))

    def elements(node, above=()):
        yield node, above
        for child in node[1]:
            if not isinstance(child, str):
                yield from elements(child, (*above, node))

    def density_sum(node):
        return sum(density(c) for c in node[1] if not isinstance(c, str))

    core, above = max(elements(page), key=lambda e: density_sum(e[0]))
    path = [*above, core]
    threshold = min(density(n) for n in path[1:])
    kept = [core] + [c for n in path[:-1] for c in n[1] if not any(c is x for x in path) and density(c) >= threshold]

    def strings(node, inside):
        inside = inside or any(node is k for k in kept)
        for child in node[1]:
            if isinstance(child, str):
                yield from [child] * inside
            else:
                yield from strings(child, inside)

    return "\n".join(strings(page, False))


def test_density_decides_where_there_is_no_article():
    rng = random.Random(11)
    checked = 0
    for _ in range(300):
        page = ("#root", [("body", [random_page(rng) for _ in range(rng.randint(2, 6))])])
        if not any(c != "" for c in page[1]):
            continue
        assert html.extract(written(page[1][0])) == plain_text(page)
        checked += 1
    assert checked == 300
