import html
import re

import pytest

from tracklane.llm.html_text import extract, main_text, style_nodes

CASES = [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b</p>c", "a\nb\nc"),
    ("<p> a \n <b>b</b>c&nbsp; d </p>", "a bc d"), ("a<br>b", "a\nb"),
    ("<body><nav>x</nav><article><h1>T</h1><p>1<p>2</article><footer>f", "T\n1\n2"),
    ("<div>out</div><main>in<aside>side</aside><div class='ad'>ad</div></main>", "in"),
    ("<article>a<script>if (1<2) x('</p>')</script><style>p{}</style>b</article>", "ab"),
    ("<article>a<!-- <p>no</p> -->b</article><!-- open", "ab"),
    ("<article>a<article class='comment'>no</article></article>", "a"),
    ("<article><header><h1>T</h1></header>x</article><header>no</header>", "T\nx"),
    ("<div id='Cookie-Notice'>no</div><div class='read'>yes</div>", "yes"),
    ("<article>1 < 2 &lt; 3 &#8211; &#x41; &eacute; &unknown;</article>", "1 < 2 < 3 – A é &unknown;"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
    ("<p><b>x<p>y</b>z</p></div></p>w", "x\nyz\nw"), ("<article title='a>b'>c</article>", "c"),
    ("<body class='has-sidebar'><p>a</body>", "a"), ("<title>t</title><textarea>u</textarea>v", "v"),
    ("<form><p>f</form><article></article>", ""), ("<script>x", ""), ("<p", "<p"),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_main_text(page, text):
    assert main_text(page) == text


def site(k, host="a.example.com"):
    return (
        k, f"https://{host}/p/{k}",
        f"<html><body><div class='top{k}'>Our site</div><div>Follow us <span>today</span></div>"
        f"<article><h1>Title {k}</h1><p>Text {k} &amp; {k * k}<div>Always the same line</div>"
        f"<p>Same in all.</article><div>Imprint<p>Town</div></body></html>",
        "x",
    )


def test_branches_of_the_site_are_cut(spark):
    rows = [site(k) for k in range(12)] + [site(k, "b.example.com") for k in range(100, 103)]
    rows += [site(3), (500, None, None, "x"), (501, "no url", "", "x")]
    # copies of one page are no template
    rows += [(600 + k, "http://c.example.com/", "<article><div>copy</div></article>", "x") for k in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {}
    for r in extract(df).collect():
        assert r.n_chars == len(r.text)
        got.setdefault(r.page_id, []).append(r.text)
    assert got[3] == ["Title 3\nText 3 & 9\nSame in all."] * 2
    assert got[101] == ["Title 101\nText 101 & 10201\nAlways the same line\nSame in all."]
    assert got[500] == got[501] == [""] and got[607] == ["copy"]
    assert extract(df.where("false")).count() == 0


def test_pages_of_the_table(table):
    pages = table("pages")
    got = {r.page_id: r for r in extract(pages).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", article)
        blocks = [" ".join(html.unescape(re.sub("<.*?>", "", b)).split()) for b in blocks]
        assert got[r.page_id].text == "\n".join(b for b in blocks if b)
        assert got[r.page_id].url == r.url


def test_style_nodes_count_containers_once():
    nodes = style_nodes("<body><div>a</div><div>b</div><p>c</body>")
    assert set(nodes) == {"", "/body", "/body/div", "/body/div[2]"}
    assert nodes["/body"][2] == 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article>a<svg class='i'/>b<p>c</article>", "ab\nc"),
        ("<article>a<math/>b<p>c<math><mi>no</mi></math>d</article>", "ab\ncd"),
        ("<article>a<svg viewBox='0 0 1 1'>b<p>c</article>", "ab\nc"),
        ("<article>a<SVG><text>no</text></SVG>b</article>", "ab"),
    ],
)
def test_foreign_elements_that_are_empty_or_left_open(page, text):
    assert main_text(page) == text


def texts_of(spark, pages):
    rows = [(k, "https://a.example.com/", page) for k, page in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    return [r.text for r in extract(df).orderBy("page_id").collect()]


def words(k, n=30):
    return " ".join(f"w{k}x{i}" for i in range(n))


def test_blocks_of_copies_stay(spark):
    block = "<ul><li>Flour and 2 eggs<li>Milk</ul><blockquote>Stir well</blockquote>"
    varied = [f"<article><h1>T{k}</h1><p>{words(k)}</article>" for k in range(20)]
    copies = [f"<article><h1>Cake</h1><p>{words('c')}{block}</article>"] * 12
    near = [f"<article><h1>Pie {k}</h1><p>{words('p')}{block}</article>" for k in range(10)]
    got = texts_of(spark, varied + copies + near)
    for text in got[20:]:
        assert text.endswith("Flour and 2 eggs\nMilk\nStir well")


def test_real_blocks_stay_where_most_pages_have_the_same(spark):
    def page(k):
        block = f"Erratum {words(f'e{k}', 9)}" if k % 20 == 0 else "Nothing was corrected"
        return f"<article><p>{words(k)}</p><section>{block}</section></article>"

    for k, text in enumerate(texts_of(spark, [page(k) for k in range(200)])):
        blocks = text.split("\n")
        assert blocks[1:] == ([f"Erratum {words(f'e{k}', 9)}"] if k % 20 == 0 else [])


def test_menus_with_some_varying_words_are_cut(spark):
    pages = [
        f"<body><div>Home News <b>user{k}</b> Contact Shop Archive</div><p>{words(k)}</p>"
        f"<div><p>Imprint and privacy<p>Made in Town at 12:{k}</div></body>"
        for k in range(20)
    ]
    assert texts_of(spark, pages) == [words(k) for k in range(20)]


def test_every_sibling_is_a_node_of_its_own(spark):
    same = "".join(f"<div>Site line {i}</div>" for i in range(12))
    pages = [f"<body>{same}<div>{words(k)}</div></body>" for k in range(20)]
    assert texts_of(spark, pages) == [words(k) for k in range(20)]
