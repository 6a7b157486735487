import pytest

from folioline.llm.extract import extract, main_text

PROSE = "This is a text that was written for the page and it is long enough to be sure of it by the words in it."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain", "plain"),
    ("<nav>Menu</nav><article><h1>T</h1><p>One  &amp;amp;\n two&nbsp;three<br>four</p></article><footer>f</footer>", "T\n\nOne &amp; two three four"),
    ("<header><h1>Site</h1></header><article><header><h1>Title</h1><p>by</p></header><p>x</p></article>", "Title\n\nx"),
    ("<article><p>x</p><div class='comments'><p>nice</p></div><form><p>f</p></form><aside>s</aside></article>", "x"),
    ("<article><p><b>open<p>next<div id=cookie-notice>We use</div><p>last</article>", "open\n\nnext\n\nlast"),
    ("<nav>never closed<article><p>x</p></article>", "x"),
    ("<article><p>a < b</p><script>if (a < b) {'</p>'}</script><style>p{}</style><!-- <p>no</p> --></article>", "a < b"),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", "yes"),
    ('<article><p title="a > b">x</p></article>', "x"),
    (f"<body><h1>T</h1><p>{PROSE}</p><p>Short.</p><ul><li><a href=1>{'link ' * 30}</a></li></ul></body>", f"T\n\n{PROSE}\n\nShort."),
    (f"<body><ul><li><a href=1>{'link ' * 30}</a><li>menu</ul><div>x</div><div>y</div><p>{PROSE}</p></body>", f"x\n\ny\n\n{PROSE}"),
    # articles that are not the page's: comments, teasers, parts of closed menus
    ("<div class=content><p>main text</p></div><section class=comments><article>nice post</article><p>more</p></section>", "main text"),
    (f"<div><p>{PROSE}</p></div><section id=related><article><p>{PROSE} Too.</p></article></section><p>Last.</p>", f"{PROSE}\n\nLast."),
    (f"<div><p>{PROSE}</p></div><ul><li role=menu><article>a</article></li></ul>", PROSE),
    ("<article><p>x</p><div class=comments><article>nice</article><article>so nice</article>more</div><p>y</p></article>", "x\n\ny"),
    ("<article><p>x</p><article class='comment'><p>nice</p></article><p>y</p></article>", "x\n\ny"),
    (f"<div><p>{PROSE}</p></div><article>Read on</article>", f"{PROSE}\n\nRead on"),
    ("<nav><article>teaser</article></nav><article><p>x</p></article><footer><article>t</article></footer>", "x"),
    ("<form><nav>menu</nav><article><p>x</p></article></form>", "x"),
    ("<div class=sidebar><article>t</article></div><main><article class='post comments-open'><p>x</p></article></main>", "x"),
    ("<title>t</title><p>&#233;&eacute;&#x65E5;</p>", "éé日"),
])
def test_page(page, text):
    assert main_text(page) == text


def test_very_long_page():
    page = "<article>" + "<p>word word</p>" * 50_000 + "</article>"
    assert main_text(page) == "\n\n".join(["word word"] * 50_000)


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", "<p>é x</p>", "n"), (1, "u", "<p>é x</p>", "n"), (None, None, None, None), (2, "v", "", None)],
        "page_id long, url string, html string, text string")
    found = extract(pages)
    assert found.dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", "é x", 3), (1, "u", "é x", 3), (None, None, "", 0), (2, "v", "", 0)], key=repr)
    assert extract(pages.limit(0)).count() == 0
