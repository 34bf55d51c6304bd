import random

import pytest

from tarmac.llm import html_text as ht


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("bits", [1, 20, 1 << 28])
def test_alignment_is_a_longest_common_subsequence(bits, monkeypatch):
    monkeypatch.setattr(ht, "TABLE_BITS", bits)
    rng = random.Random(bits)
    for _ in range(600):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 14))] for _ in range(2))
        found = ht.shared_lines(a, b)
        assert len(found) == len(set(found)) == lcs(a, b)
        rest = iter(b)
        assert all(a[i] in rest for i in found)


@pytest.mark.parametrize("html,article", [
    ("<article><h1>T</h1><p>One <b>bold<br>two<p>Three&nbsp;&amp; four</article><p>out", ["T", "One bold two", "Three & four"]),
    ("<main><nav>m</nav><p>a</p><aside>s</aside>b<form>f</form><footer>x</footer></main>", ["a", "b"]),
    ("<article><header><h1>Title</h1><p>by line</p></header><p>text</article>", ["Title", "text"]),
    ("<article>a<div class='cookie-notice'>c<div>d</div></div>b<section id=comments><p>no</p></section></article>", ["a", "b"]),
    ("<article><div class='side-bar'>s</div><p title='a>b'>x</p><div hidden>h</div><p style='display: none'>n</p></article>", ["x"]),
    ("<article>a<ol class=commentlist><li>c</ol><div class='cookiebar'>k</div><p class=commentary>b</p><ul class=topnav><li>n</ul></article>", ["a", "b"]),
    ("<main><article class=comment>bad</article><article>good</article></main>", ["good"]),
    ("<article>a<script>if (1<2) '</p>'</script><style>p{}</style><!-- c --><template>t</template>b</article>", ["ab"]),
    ("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>", ["one", "two", "x", "y"]),
    ("<article><p>a <span class=ad>buy</span> b</p></article>", ["a b"]),
    ("<article>  \n\t </article>", []),
])
def test_article_blocks(html, article):
    texts, kinds = ht.blocks(html)
    assert [t for t, k in zip(texts, kinds) if k == ht.ARTICLE] == article


@pytest.mark.parametrize("html,article", [
    ("<article><h2 id='related-work'>Related work</h2><h2 class=search>Search</h2><p>x</p></article>", ["Related work", "Search", "x"]),
    ("<article><p class='notice-period'>One month.</p><p>Take <span class='alert'>care</span> and <em id=ads>look</em>.</p><p class='ad'>buy</p></article>", ["One month.", "Take care and look."]),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be.</p></article>", ["Let x=1 be."]),
    ("<article><section id='related-work'><p>r</p></section><ul><li id=search-1>s</li></ul><table><tr><td class=header>h<td>i</table></article>", ["r", "s", "h", "i"]),
    ("<article>a<section id='comments'><h2>Comments</h2><p>c</p></section><div id=sidebar>s</div><div class='related-posts'><h3>More</h3></div><ul class=share><li>s</ul></article>", ["a"]),
    ("<main><h1 id=notice>Notice</h1><article class=comment>bad</article><p>a</p></main>", ["Notice", "a"]),
    ("<article><h1>T</h1><p>a</p><section id=search><p>own or shared</p></section></article>", ["T", "a"]),
])
def test_words_inside_articles(html, article):
    texts, kinds = ht.blocks(html)
    assert [t for t, k in zip(texts, kinds) if k == ht.ARTICLE] == article


def test_differences_judge_parts_of_articles_that_ids_suspect(spark):
    def html(n, part):
        return f"<body><nav>n</nav><article><h1>T {n}</h1><section id='search'><h2>Search {part}</h2><p>About {part}</p></section><p>end</p></article></body>"

    rows = [(i, f"http://a.example/own/{i}", html(i, i)) for i in range(4)] + [(i, f"http://b.example/all/{i}", html(i, "here")) for i in range(4, 8)]
    found = {r["page_id"]: r["text"] for r in ht.extract(pages(spark, rows)).collect()}
    assert all(found[i] == f"T {i}\nSearch {i}\nAbout {i}\nend" for i in range(4))
    assert all(found[i] == f"T {i}\nSearch here\nAbout here\nend" for i in range(4, 8)), "equal open lines are copies to each other"
    rows.append((8, "http://b.example/all/z", html(8, "here").replace("</section>", "<p>more</p></section>")))
    found = {r["page_id"]: r["text"] for r in ht.extract(pages(spark, rows)).collect()}
    assert found[8] == "T 8\nmore\nend" and found[7] == "T 7\nend"


@pytest.mark.parametrize("html", [None, "", "<", "<p", "</p></div>", "<!--", "<script>", "<a href='", "& &amp &#x110000; &#0;", "<p><b></i></p>" * 50])
def test_broken_pages_do_not_fail(html):
    texts, kinds = ht.blocks(html)
    assert len(texts) == len(kinds)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' as text", "1 as mark", "2 as id", "'h' as host")


def test_shared_lines_outside_articles_go(spark):
    def body(n):
        return f"<body><p>Shared top line</p><p>Own text {n}</p><p>Second own {n}</p><p>Shared bottom</p><div class=menu>menu {n}</div></body>"

    rows = [(1, "http://A.example/x/1", body(1)), (2, "http://a.example/x/2", body(2)), (3, "http://b.example/x/1", body(3))]
    found = {r["page_id"]: r["text"] for r in ht.extract(pages(spark, rows)).collect()}
    assert found[1] == "Own text 1\nSecond own 1" and found[2] == "Own text 2\nSecond own 2"
    assert found[3] == "Shared top line\nOwn text 3\nSecond own 3\nShared bottom"


def test_articles_of_copies_stay(spark):
    html = "<body><nav>n</nav><article><h1>Same</h1><p>article</p></article></body>"
    rows = [(i, f"http://a.example/{i}", html) for i in range(5)] + [(2, "http://a.example/2", html), (None, None, html), (9, "no host", None), (10, "http://a.example/", "")]
    found = ht.extract(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    assert sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in found) == sorted(
        (str(i), "Same\narticle" if h else "", 12 if h else 0) for i, _, h in rows)
    assert max(r["n_shared"] for r in found) == 3


def test_nearest_neighbours_equal_brute_force(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    rows = sorted({("".join(rng.choice("ab") for _ in range(2)), "/" + "".join(rng.choice("xyz/") for _ in range(rng.randint(0, 6)))) for _ in range(120)})
    df = spark.createDataFrame([(h, p, i, 7) for i, (h, p) in enumerate(rows)], "host string, path string, id bigint, mark bigint")
    found = {r["id"]: r["near_id"] for r in ht.neighbours(df.repartition(5)).collect()}
    for i, (host, path) in enumerate(rows):
        others = [(ht._common(path, p), j) for j, (h, p) in enumerate(rows) if h == host and j != i]
        assert (i in found) == bool(others)
        if others:
            h, p = rows[found[i]]
            assert h == host and ht._common(path, p) == max(others)[0]
    assert ht.neighbours(df.where(F.lit(False))).count() == 0


def test_empty_table(spark):
    assert ht.extract(pages(spark, [])).count() == 0


@pytest.mark.parametrize("wrapper", ["div class='no-sidebar'", "div id=navy", "form action='/x'", "form class='y'"])
def test_wrappers_of_an_article_are_no_furniture(wrapper):
    html = f"<body><nav>m</nav><{wrapper}><p>t</p><article><header><h1>T</h1>by</header><p>a</p><div class=ad>d</div></article><div class=related><article>r</article></div></{wrapper.split()[0]}>"
    texts, kinds = ht.blocks(html)
    assert [t for t, k in zip(texts, kinds) if k == ht.ARTICLE] == ["T", "a"]
    kept = ht.blocks("<main><p>m</p></main><div class=related><article>r</article></div>")
    assert [t for t, k in zip(*kept) if k != ht.FURNITURE] == ["m"]


@pytest.mark.parametrize("partitions", ["1", "3", "20"])
def test_copies_without_article_keep_their_text(spark, partitions):
    def body(n):
        return f"<body><p>Shared top line</p><p>Own text {n}</p><p>Shared bottom</p></body>"

    # two groups of copies, their neighbours, a page whose lines another page has, and copies alone on a host
    rows = [(i, f"http://a.example/m/{i:02}?x={i}", body(1)) for i in range(12)] + [(i, f"http://a.example/n/{i:02}", body(2)) for i in range(20, 26)]
    rows += [(40, "http://a.example/o", "<p>Shared top line</p>"), (50, "http://b.example/1", body(3)), (51, "http://b.example/1", body(3))]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = {r["page_id"]: r["text"] for r in ht.extract(pages(spark, rows)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(found[i] == "Own text 1" for i in range(12))
    assert found[20] == "Own text 2" and found[40] == "Shared top line"
    assert found[50] == found[51] == "Shared top line\nOwn text 3\nShared bottom"
    assert all(found[i] in ("Own text 2", "Own text 2\nShared bottom") for i in range(20, 26))


@pytest.mark.parametrize("texts", [[], ["a"], ["one line", "ü " * 900, "𝒳", "one line"]])
def test_blocks_travel_compressed(texts):
    data = ht._packed(texts)
    assert ht._unpacked(data, bytes([ht.OPEN] * len(texts))) == texts and len(data) < 200
    assert not any("\n" in t for t in ht.blocks("<article><pre>a\n\nb\r\nc</pre><p>d&#10;e f\x85g</article>")[0])
