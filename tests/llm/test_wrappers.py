"""Main text of pages against a plain reading of the test pages' own markup."""

import html
import re

from tripstrata.llm import queries, wrappers


def plain(page):
    found = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    inner = re.sub(r"<[^>]*\Z", "", found[1]) if found else ""
    parts = re.split(r"</?(?:p|h1)>", inner)
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts)
    return "\n".join(x for x in texts if x)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/pages.parquet").collect()
    expected = sorted((r.page_id, r.url, plain(r.html), len(plain(r.html))) for r in rows)
    assert sorted(map(tuple, queries.op2_html_extraction(spark, sf).collect())) == expected


PAGE = """<!doctype html><html><head><title>T</title><script>if (a<b) x="</p>";</script></head>
<body><header>Site</header><div id=cookie-notice>We use cookies</div><nav><a href=/>Home</a></nav>
<main><h1>Head &amp; {n}</h1><p class="Lead">One<b> two<br>three</p><div class="share bar">Tweet</div>
<p>A &lt;tag&gt; 1 < 2<p>Next {n}<aside>Side {n}</aside><form><p>Name</form><ul><li>x{n}<li>y</ul>
<p>Fixed words</p><section class="user-comments"><p>Nice {n}!</section></main><footer>&copy; {n}</footer>"""


def test_template_and_roles(spark):
    pages = [(i, "http://a.org/x", PAGE.replace("{n}", f"n{i}")) for i in range(12)]
    pages += [(20, "http://b.org/", PAGE.replace("{n}", "q")), (21, None, None), (22, "", "plain &eacute; text"), (None, "http://c/", "<p>a</p" )]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in wrappers.extract_main_text(docs).collect()}
    body = "Head & {n}\nOne two three\nA <tag> 1 < 2\nNext {n}\nx{n}"
    assert got[20] == body.replace("{n}", "q") + "\ny\nFixed words"
    # "One two three" and "Fixed words" share a repeated slot with varying paragraphs.
    for i in range(12):
        assert got[i].startswith(f"Head & n{i}\n") and "Side" not in got[i] and "Nice" not in got[i]
    assert (got[21], got[22], got[None]) == ("", "plain é text", "a")
    assert wrappers.extract_main_text(docs.limit(0)).count() == 0


def test_matching_pairs_the_most_nodes():
    a = ["b", None, [["x", None, []], ["p", None, [["q", None, []]]], ["y", None, []]]]
    b = ["b", None, [["p", None, [["q", None, []]]], ["z", None, []], ["y", None, []]]]
    assert wrappers.matching(a, b) == (4, [(1, 0), (2, 2)])
    assert [c[0] for c in wrappers.merge(a, b)[2]] == ["x", "p", "z", "y"]


def _texts(spark, pages):
    docs = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in wrappers.extract_main_text(docs).collect()}


def test_blocks_of_one_page_are_content_and_of_nearly_all_template(spark):
    page = "<body><p>Top text</p><article><h1>Head {i}</h1>{own}<p>Body {i}</article>"
    own = {3: "<h2>Only here</h2><blockquote>Said once</blockquote><table><tr><td>Cell</table>"}
    pages = [(i, "http://a.org/", page.format(i=i, own=own.get(i, ""))) for i in range(11)]
    pages = [(i, u, h.replace("<p>Body", "<div>Common</div><p>Body") if i != 5 else h) for i, u, h in pages]
    pages += [(20 + i, "http://a.org/", pages[4][2]) for i in range(200)]
    got = _texts(spark, pages)
    assert got[3] == "Head 3\nOnly here\nSaid once\nCell\nBody 3"
    assert got[0] == "Head 0\nBody 0" and got[4] == got[25] == "Head 4\nBody 4"


def test_names_are_whole_words_and_not_on_main_parts(spark):
    page = "<body class='has-sidebar single'>{}</body>"
    parts = [
        "<article class='post comments-open'><p>Text {i}</p><div class='long-form'><p>More {i}</div></article>",
        "<main id='content-with-sidebar'><p>Text {i}</p><figure><figcaption>More {i}</figure></main>",
        "<div class='form'><article class='comment'><p>Text {i}</p><p>More {i}</p></article></div>",
        "<div class=banner><p>Text {i}</p><p>More {i}</p></div><div class='user-comments'>Yes {i}</div>",
        "<div class='related posts'><article>Other {i}</article></div><article>Text {i}<p>More {i}</article>",
        "<div id=ad-slot-3>Buy {i}</div><div class=no-comments><p>Text {i}<p>More {i}</div>",
    ]
    pages = [
        (100 * k + i, f"http://h{k}.org/", page.format(x.format(i=i))) for k, x in enumerate(parts) for i in range(11)
    ]
    got = _texts(spark, pages)
    assert got == {100 * k + i: f"Text {i}\nMore {i}" for k in range(len(parts)) for i in range(11)}


def test_constant_runs_do_not_overrule_names(spark):
    menu = "".join(f"<li>Link number {i}" for i in range(30))
    page = f"<body><div class=menu><ul>{menu}</ul></div><div><p>Text {{i}}<p>More {{i}}</div>"
    got = _texts(spark, [(i, f"http://h{i // 10}.org/", page.format(i=i)) for i in range(11)])
    assert got == {i: f"Text {i}\nMore {i}" for i in range(11)}


def test_constant_blocks_of_any_length_and_in_runs_are_template(spark):
    disclaimer = "All that is said here is said without any warranty at all. " * 5
    links = "<ul><li>One fixed link<li>Another fixed link</ul>"
    page = f"<body><div>{disclaimer}</div><h1>Head {{i}}</h1><div>{{text}}<p>{{text}} too<p>See you soon</div>{links}"
    texts = [f"Story {i} " + f"word{i} " * 60 for i in range(12)]
    pages = [(i, f"http://{'a' if i < 2 else 'b'}.org/", page.format(i=i, text=texts[i])) for i in range(12)]
    near = "<p>" + "same words again and again " * 9 + "<p>"
    pages += [(20 + i, "http://c.org/", f"{near}Number {i}") for i in range(2)]
    got = _texts(spark, pages)
    for i in range(12):
        assert got[i] == f"Head {i}\n{texts[i].strip()}\n{texts[i]}too"
    # Two pages that are nearly copies are no evidence of a template.
    assert got[20].startswith("same words") and got[21].endswith("Number 1")


def test_deep_pages_keep_their_text(spark):
    """Far more levels than Python's stack has; a menu's inner levels stay in the menu."""
    for levels in (149, 150, 151, 500, 50_000):
        deep = "<div>" * levels + "<p>Deep story.</p>" + "</div>" * levels
        menu = "<nav>" + "<div>" * levels + "<p>Menu.</p>" + "</div>" * levels + "</nav>"
        inside = "<div>" * levels + "<nav><div><p>Inner menu.</p></div></nav><p>Inner.</p>" + "</div>" * levels
        page = f"<html><body>{menu}<article>{deep}{inside}<p>End.</p></article></body></html>"
        assert wrappers.main_text(page, None) == "Deep story.\nInner.\nEnd."
    rows = [(1, "http://a.b/1", "<div>" * 3000 + "x"), (2, "http://a.b/2", "<b>" * 3000 + "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in wrappers.extract_main_text(pages).collect()} == {1: "x", 2: "y"}


def test_per_page_classes_do_not_part_what_is_aligned(spark):
    line = "<div class='x-{i}'><p>Printed on every page</div>"
    page = f"<body class='postid-{{i}} {{name}}'>{line}<h2 id=t{{i}}>Head {{i}}</h2><div><p>Text {{i}}<p>More {{i}}</div>"
    names = "ant bee cat dog eel fox gnu hen ibis jay koi lynx".split()
    got = _texts(spark, [(i, "http://a.org/", page.format(i=i, name=names[i])) for i in range(12)])
    assert got == {i: f"Head {i}\nText {i}\nMore {i}" for i in range(12)}


def test_main_parts_are_a_hint(spark):
    title = "<h1>Title {i}</h1><div>Side {i}</div><article><p>Story {i} that goes on</p><p>Shared words</p></article>"
    beside = "<article><p>Teaser {i}</article><div><h1>Head</h1><p>" + "Story {i} goes on and on. " * 5 + "</div>"
    pages = [(k + i, f"http://{h}.org/", x.format(i=i)) for k, h, x in ((0, "a", title), (10, "b", beside)) for i in range(2)]
    got = _texts(spark, pages)
    for i in range(2):
        # Two pages are no evidence against what stands in both of their articles.
        assert got[i] == f"Title {i}\nStory {i} that goes on\nShared words"
        assert got[10 + i].endswith(("Story %d goes on and on. " % i * 5).strip())


def test_long_texts_repeated_rows_and_clashing_names(spark):
    long = "<article><p>" + "many words " * 100_000 + "</article>"
    rows = [(1, "http://a.org/", long, "x", 5)] * 2 + [(2, "http://a.org/", "", "x", 5), (2, "http://a.org/", None, "x", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host long")
    got = sorted((r.page_id, r.text, r.n_chars) for r in wrappers.extract_main_text(pages).collect())
    text = ("many words " * 100_000).strip()
    assert got == [(1, text, len(text))] * 2 + [(2, "", 0)] * 2


def test_unmarked_templates_are_learned(spark):
    """The given articles in templates without a name or element that tells them."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    pages, expected = [], {}
    for r in rows:
        host = re.match(r"\w+://([^/]*)", r.url)[1]
        lines = plain(r.html).split("\n")
        story = "".join(f"<p>{html.escape(x)}</p>" for x in lines)
        page = f"<div><p>Start at {host}</p><p>Contact</p></div><div><p>Before you read</p>{story}</div><div>Owned by {host}</div>"
        pages.append((r.page_id, r.url, f"<body class=p{r.page_id}>{page}</body>"))
        expected[r.page_id] = "\n".join(lines)
    got = _texts(spark, pages)
    hosts = [re.match(r"\w+://([^/]*)", u)[1] for _, u, _ in pages]
    compared = {i for (i, _, _), h in zip(pages, hosts) if hosts.count(h) > 1}
    right = {i for i in compared if got[i] == expected[i]}
    alone = {i for i, _, page in pages if i in compared and wrappers.main_text(page, None) == expected[i]}
    print(len(compared), len(right), len(alone))
    assert len(compared) > 200 and not alone and len(right) >= 0.95 * len(compared)
