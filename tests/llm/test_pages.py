import html as entities
import os
import re

import pytest

from namesieve.llm import pages


def text(source):
    return pages.Page(source).text()


def test_blocks_and_references():
    assert text("<article><h1>A &amp; B</h1><p>x  y<br>z <b>b</b>o&lt;ld</p><p>&nbsp;</p><p>é&eacute;</p></article>") == "A & B\nx y z bo<ld\néé"
    assert text("<body><p>one<p>two<ul><li>a<li>b</ul>three</body>") == "one\ntwo\na\nb\nthree"


def test_boilerplate_goes():
    page = """<html><head><title>t</title><style>p{}</style><script>var a="</p><p>no";</script></head><body><header>Site</header><nav><a>Menu</a></nav>
    <div class="cookie-notice">We use cookies</div><!-- <p>no</p> --><main><article><h1>Title</h1><p>Body text.</p><div class="ad">Buy</div>
    <form><input value="x"><label>mail</label></form><p title="a > b">More &gt; text.</p><aside>Side</aside></article></main>
    <section id="comments"><article class="comment"><p>First!</p></article></section><div class="sidebar">S</div><footer>&copy; F</footer></body></html>"""
    assert text(page) == "Title\nBody text.\nMore > text."


def test_broken_markup():
    assert text("<article><p><b>one<br><p>two</article><footer>f") == "one\ntwo"
    assert text("") == "" and text("just text < 5 & more") == "just text < 5 & more"
    assert text("<p>a</div></span>b</p>") == "a\nb" or text("<p>a</div></span>b</p>") == "ab"
    assert text("<article>x<script>never closed") == "x"
    assert text("<!-- open comment <p>x</p>") == ""


def test_templates_are_counted_per_host_and_copies_once(spark):
    share = '<div class="x1"><p>Follow us everywhere</p></div>'
    rows = [(i, f"https://a.org/{i}", f"<body>{share}<p>Story {i}</p></body>") for i in range(8)]
    rows += [(20 + i, f"https://b.org/{i}", f"<body>{share}<p>Tale</p></body>") for i in range(8)]  # one page, eight copies
    rows += [(40, "https://c.org/", f"<body>{share}<p>Lone</p></body>")]
    found = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(found[i] == f"Story {i}" for i in range(8))
    assert all(found[20 + i] == "Follow us everywhere\nTale" for i in range(8))
    assert found[40] == "Follow us everywhere\nLone"


def test_shared_passages_of_articles_stay(spark):
    rows = [(i, "http://a.org/x", f"<article><h1>T{i}</h1><p>Licensed to all.</p><div class='box'><i>Related stuff</i></div></article>") for i in range(10)]
    found = pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r["text"] == f"T{r['page_id']}\nLicensed to all." for r in found)


def extracted(spark, sources, **more):
    table = spark.createDataFrame([(i, "http://a.org/x", x) for i, x in enumerate(sources)], "page_id bigint, url string, html string")
    return [r["text"] for r in pages.extract(table, **more).orderBy("page_id").collect()]


def test_blocks_that_recur_inside_articles_go(spark):
    notice, links = "<p>Support us today.</p>", "<ul><li>One link<li>Two links</ul>"
    sources = [f"<article><h1>T{i}</h1>{notice}<p>Story {i}</p>{f'<p>More {i}</p>' * (i % 3)}{links}</article>" for i in range(40)]
    assert extracted(spark, sources) == [f"T{i}\nStory {i}" + f"\nMore {i}" * (i % 3) for i in range(40)]
    # One article on many pages is no template, nor is a passage that moves about.
    sources = [f"<article><p>The one story.</p></article><div>Page {i}</div>" for i in range(40)]
    sources += [f"<article>{'<p>x%d</p>' % i * (1 + i)}<p>A passage.</p>{'<p>y%d</p>' % i * (1 + i)}</article>" for i in range(40)]
    got = extracted(spark, sources)
    assert all("The one story." in x for x in got[:40]) and all("A passage." in x for x in got[40:])


def test_teasers_are_not_the_main_text(spark):
    source = f"<body><div><p>{'The main text is here. ' * 5}</p></div><article><p>Teaser</p></article></body>"
    assert text(source) == ("The main text is here. " * 5).strip() + "\nTeaser"
    assert text("<body><div>Aside</div><article><p>The story itself</p></article></body>") == "The story itself"


def test_sections_of_large_hosts_have_templates(spark):
    box = "<div class='x1'><p>Follow this section</p></div>"
    sources = [f"<body>{box if i < 20 else ''}<p>Story {i}</p></body>" for i in range(1000)]
    assert extracted(spark, sources) == extracted(spark, sources, held=0) == [f"Story {i}" for i in range(1000)]


def test_frequent_passages_of_articles_stay(spark):
    """A passage on a seventh of a large host's pages, always as the last block, is no template; a section's notice is one."""
    passage, notice = "<p>A passage that many share.</p>", "<p>Notice of this section.</p>"
    rows = [(i, f"http://a.org/{'news' if i < 60 else 'other'}/{i}", f"<article><h1>T{i}</h1><p>Story {i}</p>{notice if i < 60 else ''}{passage if i % 7 == 0 else ''}</article>") for i in range(600)]
    found = pages.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert all(r["text"] == f"T{r['page_id']}\nStory {r['page_id']}" + "\nA passage that many share." * (r["page_id"] % 7 == 0) for r in found)


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_equals_the_articles(spark, folder):
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = pages.op2_template_removal(spark, folder).collect()
    assert len(rows) == len(html)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", html[r["page_id"]], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_odd_rows_and_empty_table(spark):
    long_page = "<p>" + "word " * 200_000 + "</p>"
    rows = [(1, None, None, "x"), (None, "u", "<p>a", "x"), (2, "http://h/", "", "x"), (2, "http://h/", "", "x"), (3, "not a url", long_page, "x"), (4, "http://h/", "<" * 5000 + "p" * 5000, "x")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = pages.extract(table).collect()
    assert len(found) == 6 and {r["text"] for r in found if r["page_id"] in (1, 2)} == {""}
    assert [r["n_chars"] for r in found if r["page_id"] == 3] == [999_999]
    assert pages.extract(table.limit(0)).count() == 0


def test_deep_markup_takes_linear_time(spark):
    n = 100_000
    sources = ["<b>x" * n, "<div>x</i>" * n, "<article>" + "<p>x<td>" * n, "<ul>" * n + "<li>x" * n + "</ul>" * n]
    found = extracted(spark, sources)
    assert found[0] == "x" * n
    assert found[1] == found[2] == found[3] == "\n".join("x" * n)
