"""Main text of pages: supplied pages, made-up layouts, broken markup, odd rows."""

import html
import re


from filingmill.llm import pages, queries

SF = "/root/testdata/sf0.01"
MENU = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("home", "news", "about"))


def expected(page):
    """The supplied pages have one article element."""
    article = re.search("<article>(.*?)(</article>|$)", page, re.DOTALL).group(1)
    found = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
    return "\n".join(b for b in found if b)


def test_supplied_pages(spark):
    found = {r.page_id: r for r in queries.op2_page_text(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(found) == len(rows)
    for row in rows:
        assert found[row.page_id].text == expected(row.html) and found[row.page_id].n_chars == len(found[row.page_id].text)


def plain(i):
    """No element says what it is."""
    text = [f"Headline {i}", f"First paragraph {i} with a good many words in it.", f"Second {i} &amp; more,\n a  second line.", "z" * 60]
    body = f"<h1>{text[0]}</h1><div id=c2><p>{text[1]}<p>{text[2]}<br>x</p><p>{text[3]}</div>"
    page = (
        f"<html><head><title>t {i}</title><style>p{{a:b}}</style></head><body><div id=m><ul>{MENU}</ul></div>"
        f"<div id=c1>{body}</div><div id=r><ul>{MENU}</ul><p>Site of the year</p></div><script>x('</p>')</script></body></html>"
    )
    return page, "\n".join([*text[:2], f"Second {i} & more, a second line. x", text[3]])


def marked(i):
    page = (
        f"<body><header><h1>The Site</h1></header><nav>{MENU}</nav><div class='cookie-notice'>We use cookies.</div><main><article>"
        f"<header><h1>Title {i}</h1></header><p>Body <b>of</b> {i} &lt;p&gt; goes on here.</p><aside>Read this too</aside><div class='ad box'>Buy</div>"
        f"<ul><li>one<li>two {i}</ul><section id='comments'><h2>Comments</h2><p>First!</p></section></article></main>"
        f"<form><label>Name</label><input name=a>Send</form><div class=sidebar><p>Popular</p></div><footer>c 2020</footer></body>"
    )
    return page, f"Title {i}\nBody of {i} <p> goes on here.\none\ntwo {i}"


def test_layouts_and_odd_rows(spark):
    rows, texts = [], {}
    for i in range(40):
        make = plain if i % 2 else marked
        page, texts[i] = make(i)
        rows.append((i, f"http://{make.__name__}.example/{i}", page, "x"))
    odd = {100: None, 101: "", 102: "no markup &amp; all", 103: "<", 104: "<p>a<b <p", 105: "<script>never closed", 106: "<article>" + "<div>" * 3000 + "deep",
           107: "<p>" + "word " * 200_000, 108: "<!-- open", 109: '<a title="x>y">z</a>'}
    rows += [(i, f"http://odd{i}.example/" if i % 2 else None, page, "x") for i, page in odd.items()]
    rows += [(0, "http://marked.example/0", rows[0][2], "x"), (None, None, "<p>a</p>", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = pages.extract(frame).collect()
    assert len(found) == len(rows)
    by = {r.page_id: r.text for r in found}
    for i, text in texts.items():
        assert by[i] == text
    assert [by[i] for i in (100, 101, 102, 103, 105, 106, 108, 109, None)] == ["", "", "no markup & all", "<", "", "deep", "", "z", "a"]
    assert by[107] == ("word " * 200_000).strip()
    assert pages.extract(frame.limit(0)).count() == 0


def test_classes_of_a_host(spark):
    rows = [(i, "h", plain(i)[0]) for i in range(6)]
    found = pages.classes(pages.tokens(spark.createDataFrame(rows, "page long, host string, html string")))
    once = {r.way for r in found.filter("once").collect()}
    assert {"body", "body>div.m", "body>div.c0", "body>div.c0>div.c0", "body>div.c0>h1"} <= once
    assert "body>div.m>ul>li" not in once
    assert [r.main for r in pages.templates(found).collect()] == ["body>div.c0>div.c0"]


def test_broken_markup_takes_linear_time():
    for page in ('<a "' * 100_000, "<" * 300_000, "<p" * 100_000, "<!--" * 100_000, "<script>" * 50_000, "</p>" * 100_000, "<li>" * 20_000, "<x a=" * 50_000):
        pages.blocks_of(page)


def test_marks_around_the_article(spark):
    """A mark on what holds the article does not cost it; one on a box beside it still does."""
    around = {
        "form": "<form id=aspnetForm>%s<div class=comments><p>First!</p></div></form>",
        "layout": "<div class='layout no-sidebar'>%s</div><div class=sidebar><p>Popular</p></div>",
        "sidebar": "<div class=sidebar-layout>%s</div><div class=comments><p>First!</p></div>",
        "post": "<article class='post has-comments'>%s</article><div class=comments><p>First!</p></div>",
        "legal": "<article class='category-legal'>%s</article><aside>Read this</aside>",
        "promo": "<div class=promo><main>%s</main></div><footer>c 2020</footer>",
        "only": "<div class=alert>%s</div>",
    }
    rows, texts = [], {}
    for name, wrap in around.items():
        for i in range(4):
            key = len(rows)
            rows.append((key, f"http://{name}.example/{i}", wrap % f"<h1>Title {i}</h1><p>The text of page {i} has many words in it.</p><section class=related-work><p>Work {i} by others.</p></section>"))
            texts[key] = f"Title {i}\nThe text of page {i} has many words in it.\nWork {i} by others."
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found} == texts


def test_text_of_the_template_within_the_article(spark):
    """The same text on all pages is the template's; copies of one article and their headlines are not."""
    rows, texts = [], {}
    for i in range(12):
        body = f"<div class=x1><h1>Title {i}</h1><p>Text {i} is long enough to be read.</p><div class=x2><p>Tell your friends</p></div></div>"
        rows.append((i, f"http://a.example/{i}", body))
        texts[i] = f"Title {i}\nText {i} is long enough to be read."
    for i in range(12, 24):
        rows.append((i, f"http://b.example/{i}", f"<div class=x1><h1>Title</h1><p>One text.</p><div class=x2>A quotation.</div></div><i>{i}</i>"))
        texts[i] = f"Title\nOne text.\nA quotation.\n{i}"
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in found if r.page_id < 12} == {i: t for i, t in texts.items() if i < 12}
    assert all(r.text.startswith("Title\nOne text.\nA quotation.") for r in found if r.page_id >= 12)


def test_rows_that_repeat_a_key(spark):
    """Pages under one key are pages of their own, and an even number of them has a vector too."""
    frame = spark.createDataFrame([(1, "h", page) for page in ("<p>a<p>b", "<p>a<p>b", "<p>a</p><div>c</div>", "<ul><li>d</ul>")], "page long, host string, html string")
    found = pages.classes(pages.tokens(frame)).collect()
    once = {r.way for r in found if r.once}
    assert once == {"body", "body>div", "body>ul", "body>ul>li"} - {"body>div"}


def test_parts_beside_the_long_text_and_two_layouts(spark):
    """A lead, a subtitle, a closing section and the pages of a rare layout are whole; menus still go."""
    rows, texts = [], {}
    for i in range(40):
        links = f"<ul><li><a href=/{i}>Read page {i}</a><li><a href=/x>Read page {i + 1}</a></ul>"
        menu = f"<div class=m1>{links}</div>"
        long = f"Text {i} goes on for a while. " * 10
        if i % 8:
            story = f"<div class=lead>Lead of {i}.</div><h2>Subtitle {i}</h2><div class=text><p>{long}</p>{links}</div><div class=end>End of {i}.</div>"
            page = f"<body>{menu}<div class=story>{story}</div></body>"
            texts[i] = f"Lead of {i}.\nSubtitle {i}\n{long.strip()}\nRead page {i}\nRead page {i + 1}\nEnd of {i}."
        else:
            page = f"<body>{menu}<div class=story>Brief {i}</div><div class=other><p>Report {i} is here.</p>{links}</div></body>"
            texts[i] = f"Brief {i}\nReport {i} is here."
        rows.append((i, f"http://two.example/{i}", page))
    found = {r.page_id: r.text for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, text in texts.items():
        assert found[i] == text if i % 8 else text in found[i]


def test_marks_count_however_deep_and_however_long_their_names_are():
    article = "<p>" + "Some running text of the article, which is long enough to be one. " * 5 + "</p>"
    for mark in ("<nav>Home and away and more of a menu that is long</nav>", '<div class="' + "a" * 45 + '-comments"><p>' + "A reader says so. " * 3 + "</p></div>"):
        for depth in (1, 47, 60, 300):
            page = "<body>" + "<div>" * depth + article + mark + "</div>" * depth + "</body>"
            found = pages.text_of(page, pages.Template())
            assert found.startswith("Some running text") and "menu" not in found and "reader" not in found, (mark, depth)
    nested = "<body>" + "<nav>" * 3000 + "menu" + "</nav>" * 3000 + article + "</body>"
    assert "menu" not in pages.text_of(nested, pages.Template())
