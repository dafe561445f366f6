import json

from tradewind.llm import wrappers
from tradewind.llm.markup import parse

ARTICLE = "<article><h1>Title &amp; more</h1><p><b>One<br>two</p><p>a<i>b</i>c&nbsp;d<script>no()</script></article>"
PAGE = ('<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>H</header><nav><ul><li>m</ul></nav><div class="cookie-notice">n'
        '</div><!-- c <p>x</p> -->{}<aside>s</aside><form><p>f</p></form><section id="comments"><p>reader</p></section><footer>F')


def text(page, pattern=None):
    return wrappers.text_of(parse(page), pattern)


def test_article_without_its_surroundings():
    assert text(PAGE.replace("{}", ARTICLE)) == "Title & more One two abc d"


def test_malformed_markup():
    assert text("") == "" and text("plain & simple") == "plain & simple"
    assert text("<article><p>a<p>b</p></div>c</article>d") == "a b c"
    assert text("<article>a < b and <b title='x>y'>bold</b> &lt;p&gt; <img alt='z'/>end <foo") == "a < b and bold <p> end"
    assert text("<article>x<script>if (a</b>) {'</p>'}") == "x" and text("<article>x<!-- y") == "x"
    assert text("<div>" * 3000 + "deep") == "deep"
    assert text("<article>a<article>b</article>c</article>") == "a b c"
    assert text("<body><main><h2>m</h2><p>n</p></main><p>o</p>") == "m n"
    assert text('<article><p class="advert">x</p><p class="has-ads">y</p><div hidden>z</div></article>') == "y"
    assert text("<article><table><tr><td>1<td>2<tr><td>3</table></article>") == "1 2 3"


def wrapper(*pages):
    out = None
    for page in pages:
        own = wrappers.of_page(parse(page))
        out = own if out is None else wrappers.merged(out, own)
    return out


def shape(node):
    mark = ("?" if node[wrappers.OPTIONAL] else "") + ("+" if node[wrappers.REPEATED] else "")
    if node[wrappers.KEY] == wrappers.TEXT:
        return ("'fixed'" if node[wrappers.FIXED] else "slot") + mark
    return f"{node[wrappers.KEY]}[{' '.join(map(shape, node[wrappers.CHILDREN]))}]{mark}"


def test_mismatches_become_slots_options_and_repetitions():
    found = wrapper("<div><b>x</b><p>1</p></div>", "<div><b>x</b><i>y</i><p>2</p><p>3</p></div>")
    assert shape(found) == "#root[div[b['fixed'] i['fixed']? p[slot]+]]"
    squares = wrapper("<dl><dt>a</dt><dd>b</dd><dt>c</dt><dd>d</dd></dl>", "<dl><dt>e</dt><dd>f</dd></dl>")
    assert shape(squares) == "#root[dl[#(dt dd)[dt[slot] dd[slot]]+]]"


def test_width_is_bounded():
    page = "<div>" + "".join(f"<x{chr(97 + n % 26)}{chr(97 + n // 26)}>t</x{chr(97 + n % 26)}{chr(97 + n // 26)}>" for n in range(200)) + "</div>"
    found = wrapper(page, page)
    assert [c[wrappers.KEY] for c in found[wrappers.CHILDREN][0][wrappers.CHILDREN]] == ["#any"]


def size(node):
    return 1 + sum(map(size, node[wrappers.CHILDREN]))


def levels(node):
    return 1 + max(map(levels, node[wrappers.CHILDREN]), default=0)


def test_ids_of_single_pages_do_not_grow_a_wrapper():
    name = lambda n: "".join(chr(97 + int(d)) for d in str(n))
    page = lambda n: "<body><p>Menu</p>" + "".join(f"<h2 id='{name(60 * n + k)}'>{name(60 * n + k)}</h2><p>b</p>" for k in range(60)) + "</body>"
    whole, sizes = None, []
    for n in range(2000):
        own = wrappers.of_page(parse(page(n)))
        whole = own if whole is None else wrappers.merged(whole, own)
        if n in (20, 1999):
            sizes.append(size(whole))
    assert max(sizes) < 3 * wrappers.KINDS and levels(whole) == 5 and len(json.dumps(whole)) < 100_000
    halves = wrappers.merged(wrapper(*map(page, range(10))), wrapper(*map(page, range(10, 20))))
    assert levels(halves) == 5 and halves[wrappers.PAGES] == 20
    assert all(name(60 * 1999 + k) in text(page(1999), wrappers.Pattern(whole)) for k in range(60))


def test_template_text_is_left_out_where_there_is_no_article():
    pages = [f"<body><div><span>Site name</span></div><div><p>Text {n}</p></div></body>" for n in "abc"]
    pattern = wrappers.Pattern(json.loads(json.dumps(wrapper(*pages))))
    assert [text(p, pattern) for p in pages] == ["Text a", "Text b", "Text c"]
    alike = wrappers.Pattern(wrapper(pages[0], pages[0]))
    assert text(pages[0], alike) == "Site name Text a"


def test_a_few_other_pages_do_not_end_the_template():
    usual = [f"<body><div><span>Site name</span></div><p>Text {n}</p></body>" for n in range(400)]
    other = ["<body><table><tr><td>x</table></body>", "<body><div><span>Si", "<body><div><span>Sale</span></div><p>Text</p></body>"]
    pattern = wrappers.Pattern(json.loads(json.dumps(wrapper(*other, *usual))))
    assert text(usual[9], pattern) == "Text 9" and text(other[2], pattern) == "Sale Text"
    halves = wrapper(*usual[:150], *other), wrapper(*usual[150:])
    assert text(usual[9], wrappers.Pattern(wrappers.merged(*halves))) == "Text 9"
    assert len(json.dumps(wrapper(*usual))) < 5_000, "texts of single pages aren't kept"
    often = [p.replace("Site name", "Site name" if n % 10 < 8 else "Other") for n, p in enumerate(usual)]
    assert text(often[1], wrappers.Pattern(wrapper(*often))) == "Site name Text 1"


def test_fixed_texts_of_wide_and_repeated_places():
    wide = lambda n: "".join(f"<a class='{chr(97 + k % 26)}{chr(97 + k // 26)}'>item {k}</a>" for k in range(60)) + f"<p>Text {n}</p>"
    pages = [f"<body>{wide(n)}<div>more</div><div>{n}</div></body>" for n in range(30)]
    assert text(pages[3], wrappers.Pattern(wrapper(*pages))) == "Text 3 3"


def test_empty_pages_are_not_of_the_wrapper(spark):
    rows = [("h", None), ("h", ""), ("h", " \n"), ("none", "")] + [("h", f"<p>{n}</p>") for n in range(9)]
    pages = spark.createDataFrame(rows, "host string, html string").selectExpr("host", "coalesce(html, '') AS html").repartition(5)
    found = wrappers.infer(pages).collect()
    assert [(r["host"], json.loads(r["wrapper"])[wrappers.PAGES]) for r in found] == [("h", 9)]


def test_the_wrapper_decides_within_articles():
    pages = [f"<body><article><h1>Title {n}</h1><div>Read this in our app</div><p>Text {n}</p></article></body>" for n in range(30)]
    pattern = wrappers.Pattern(json.loads(json.dumps(wrapper(*pages))))
    assert text(pages[7], pattern) == "Title 7 Text 7" and text(pages[7]) == "Title 7 Read this in our app Text 7"
    few = wrappers.Pattern(wrapper(*pages[:5]))
    assert text(pages[3], few) == text(pages[3]), "too few pages to tell within an article"
    alike = wrappers.Pattern(wrapper(*pages[:1] * 30))
    assert text(pages[0], alike) == text(pages[0]), "an article isn't emptied"


def test_on_spark(spark):
    rows = [(n, f"http://{'hot' if n % 3 else f'h{n}'}.org/{n}", PAGE.replace("{}", f"<article><p>text {n}</article>"), "x", 5) for n in range(60)]
    rows += [(100, None, "<p>a</p>", None, None), (101, "http://hot.org", None, None, None), (102, "no", "", None, 1), (None,) * 5, rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, n_chars int").repartition(7)
    found = wrappers.extract(pages).collect()
    assert len(found) == 65
    by_id = {r["page_id"]: (r["text"], r["n_chars"], r["host"]) for r in found}
    assert all(by_id[n] == (f"text {n}", len(f"text {n}"), "x") for n in range(60))
    assert by_id[100][:2] == ("a", 1) and by_id[101][:2] == by_id[102][:2] == by_id[None][:2] == ("", 0)
    assert wrappers.extract(pages.limit(0)).count() == 0
    inferred = wrappers.infer(spark.createDataFrame([(h, p) for _, _, p, h, _ in rows[:60]], "host string, html string").repartition(9), 4)
    assert inferred.count() == 1 and json.loads(inferred.first()["wrapper"])[wrappers.PAGES] == 60
