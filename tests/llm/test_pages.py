import datetime as dt
import html as hl
import random
import re

from pyspark.sql import functions as F

from tidewater.llm import dom, revisits, wrapper



def blocks(h):
    _, texts, flags = dom.parse(h)
    return [t for t, x in zip(texts, wrapper.without_template([len(t) for t in texts], flags), strict=True) if x]


def test_furniture_goes():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
    <header><h2>Site</h2></header><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
    <aside>Side</aside><div id="sidebar">More</div><form><label>Name</label><input></form><div class="ad">Buy</div>
    <article><header><h1>Title &amp; more</h1><p>By X</p></header><p>First <b>bold</b>
      text&nbsp;here<br>and on<p>Second &lt;tag&gt; <span class="ad">advert</span> end</p><ul><li>one<li>two</ul>
      <pre>a
      b</pre><table><tr><td>x<td>y</table><section class="comments"><p>Nice!</p></section><footer>Tags</footer></article>
    <div class="related">Other</div><footer>&copy; 2024</footer><noscript>enable</noscript></body></html>"""
    assert blocks(page) == ["Title & more", "First bold text here and on", "Second <tag> end", "one", "two", "a b", "x", "y"]


def test_odd_html():
    assert blocks("") == [] and blocks("just text") == ["just text"]
    assert blocks("<p>a<p>b") == ["a", "b"] and blocks("<div>a<div>b</div>c</div>") == ["a", "b", "c"]
    assert blocks("<p title='x>y'>a</p><p title=\"open>b</p>") == ["a", "b"] or blocks("<p title='x>y'>a</p>") == ["a"]
    assert blocks("a < b and c > d") == ["a < b and c > d"]
    assert blocks("<script>never closed <p>x") == [] and blocks("x<!-- never closed <p>y") == ["x"]
    assert blocks("<p>&#233;&eacute;&bogus;&#x1F600;</p>") == ["éé&bogus;😀"]
    assert blocks("</p></div>a</b>") == ["a"]
    assert blocks("<P CLASS='Nav-Bar'>x</P><P>y</P>") == ["y"]
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert blocks(deep) == ["x"] and blocks("<div>" * 5000 + "x") == ["x"] and blocks("<div>a" * 400) == ["a"] * 400
    # A teaser doesn't make an article of the page; comments aren't articles.
    story = "long story " * 20
    assert blocks(f"<div>{story}</div><article>teaser</article>") == [story.strip(), "teaser"]
    assert blocks(f"<div>{story}</div><article class='comment'>Nice {story}</article>") == [story.strip()]
    assert blocks("<article class='post comments-open'>x</article><div>y</div>") == ["x"]
    assert blocks("<p>a <a href='/'>b <span class=ad>c</span></a> d<select><option>e</select> f</p>") == ["a b d f"]


def test_matching_is_a_largest_match():
    rng = random.Random(2)

    def grow(depth):
        kids = tuple(grow(depth - 1) for _ in range(rng.randint(0, 3))) if depth else ()
        return wrapper.made(rng.randint(1, 2), -1, -1, kids)

    def plain(a, b):
        if a[0] != b[0]:
            return 0
        m = [[0] * (len(b[5]) + 1) for _ in range(len(a[5]) + 1)]
        for i, x in enumerate(a[5], 1):
            for j, y in enumerate(b[5], 1):
                m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + plain(x, y))
        return 1 + m[-1][-1]

    for _ in range(300):
        a, b = grow(3), grow(3)
        assert wrapper.weight(a, b) == plain(a, b)


def spoken(rng, k):
    return " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(k))


def pages_of_a_host(n):
    rng = random.Random(4)
    out = []
    for i in range(n):
        body = "".join(f"<p>{spoken(rng, 12)}.</p>" for _ in range(rng.randint(2, 6)))
        out.append((i, f"https://h.example/{i}", f"<html><body><div><p>Read our great offers every day</p></div><div><h1>{spoken(rng, 4)}</h1>{body}</div><div><p>Imprint and contact</p></div></body></html>"))
    return out


PAGE = "page_id long, url string, html string"


def test_constant_slots_are_template(spark):
    rows = pages_of_a_host(8)
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, PAGE), salts=2).collect()}
    for i, _, h in rows:
        assert got[i] == "\n\n".join(re.findall(r"<(?:h1|p)>([^<]*)<", h)[1:-1])
    # Too few pages, and copies of one page, have no template.
    few = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows[:3], PAGE)).collect()}
    assert few[0].startswith("Read our") and few[0].endswith("contact")
    copies = spark.createDataFrame([(i, u, rows[0][2]) for i, u, _ in rows], PAGE)
    assert all(r.text.startswith("Read our") for r in wrapper.extract(copies).collect())


def test_slots_choose_the_content(spark):
    """Varying menus, adverts and side columns without a telling name; constants, and lists of links, within the story."""
    rng, rows, want = random.Random(9), [], {}
    for i in range(40):
        story = [spoken(rng, rng.randint(15, 40)) + "." for _ in range(rng.randint(1, 5))]
        title, links = spoken(rng, 5), "".join(f"<li><a href='/{k}'>{spoken(rng, 2)}</a></li>" for k in range(rng.randint(2, 6)))
        side = f"<div class=x2><p>{spoken(rng, 6)}</p></div>"
        body = "".join(f"<p>{p}</p>" for p in story)
        h = f"<body><div class=x1><ul>{links}</ul></div>{side}<div class=x3><h1>{title}</h1><section><p>By our own desk</p>{body}<ul>{links}</ul></section></div><div class=x4>{spoken(rng, 4)}</div></body>"
        host = "a" if i < 28 else "b"
        rows.append((i, f"http://{host}.example/{i}", h if host == "a" else h.replace("x3", "y3")))
        want[i] = "\n\n".join([title, *story])
    for salts in (1, 7):
        got = wrapper.extract(spark.createDataFrame(rows, PAGE).repartition(3), salts=salts).collect()
        assert {r.page_id: r.text for r in got} == want and all(r.by_template for r in got)
    plain = wrapper.extract(spark.createDataFrame(rows, PAGE), least=10**9).collect()
    assert not any(r.text == want[r.page_id] or r.by_template for r in plain)


def test_templates_equal_plain_induction(spark):
    """Pages of one shape: texts at a path that all pages share are constant, and the element with most of the rest is the content."""
    rng = random.Random(21)
    for _ in range(4):
        kids, n = rng.randint(2, 4), rng.randint(5, 9)
        shape = [[rng.random() < 0.4 for _ in range(rng.randint(1, 4))] for _ in range(kids)]  # whether a paragraph is constant
        main = rng.randrange(kids)
        fixed = [[spoken(rng, 3) for _ in own] for own in shape]
        pages, texts = [], []
        for i in range(n):
            said = [[fixed[k][j] if c else spoken(rng, 60 if k == main else 3) for j, c in enumerate(own)] for k, own in enumerate(shape)]
            said[main].append(spoken(rng, 60))
            texts.append(said)
            pages.append((i, f"http://h.example/{i}", "<body>" + "".join(f"<div class=c{chr(97 + k)}>" + "".join(f"<p>{t}</p>" for t in own) + "</div>" for k, own in enumerate(said)) + "</body>"))
        want = {i: "\n\n".join(t for j, t in enumerate(said[main]) if any(other[main][j] != t for other in texts)) for i, said in enumerate(texts)}
        assert {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(pages, PAGE)).collect()} == want


def test_wide_and_deep_pages(spark):
    rng = random.Random(3)
    mixed = lambda n: "".join(f"<{t}>{spoken(rng, 1)}</{t}>" for t in (rng.choice(["p", "h2", "pre"]) for _ in range(n)))
    rows = [(i, f"http://w.example/{i}", f"<body><div>{mixed(5000)}</div></body>") for i in range(5)]
    rows += [(10 + i, f"http://d.example/{i}", "<div>" * 5000 + f"<p>{spoken(rng, 9)}</p><p>{spoken(rng, 9)}</p>") for i in range(6)]
    rows.append((20, "http://w.example/20", f"<body><div>{'<p>x</p><h3>y</h3>' * 25_000}</div></body>"))
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert len(got) == 12 and len(got[20]) == 50_000 + 2 * 49_999
    assert all(got[i].count("\n\n") > 4000 for i in range(5)) and all(got[10 + i].count("\n\n") == 1 for i in range(6))


def test_matching_in_order_pairs_equal_labels():
    rng = random.Random(8)
    for _ in range(100):
        a, b = (tuple(wrapper.made(rng.randint(1, 4), -1, -1, ()) for _ in range(rng.randint(0, 30))) for _ in range(2))
        pairs = wrapper.in_order(a, b)
        at = [(next(i for i, k in enumerate(a) if k is x), next(j for j, k in enumerate(b) if k is y)) for x, y in pairs]
        assert all(x[0] == y[0] for x, y in pairs) and at == sorted(at) and len({i for i, _ in at}) == len({j for _, j in at}) == len(at)
        assert len(wrapper.in_order(a, a)) == len(a)


def test_templates_of_the_page_table(spark):
    """Without any marks, the slots of templates alone give the articles; without templates nothing does."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = wrapper.extract(pages, marks=False).collect()
    assert sum(r.by_template for r in got) > 100
    assert all((r.text == want[r.page_id]) == r.by_template for r in got)
    assert not any(r.text == want[r.page_id] for r in wrapper.extract(pages, least=10**9, marks=False).collect())


def test_odd_pages(spark):
    rows = [(1, "http://a.example/x", None, "c"), (1, "http://a.example/x", None, "c"), (2, None, "<p>x</p>", "c"), (None, "nonsense", "", "c"), (3, "http://a.example/y", "<p>" + "long words " * 50_000 + "</p>", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string").withColumn("key", F.lit(1)).withColumn("tree", F.lit(1))
    got = sorted(((r.page_id or 0, r.url or "", r.text[:5], r.n_chars) for r in wrapper.extract(df).collect()))
    assert got == [(0, "nonsense", "", 0), (1, "http://a.example/x", "", 0), (1, "http://a.example/x", "", 0), (2, "", "x", 1), (3, "http://a.example/y", "long ", 549_999)]
    assert wrapper.extract(df.filter("false")).count() == 0


def article(html):
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", html, re.S)[1]
    parts = [" ".join(hl.unescape(re.sub(r"<[^>]*>", " ", x.replace("<b>", "").replace("</b>", ""))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(p for p in parts if p)


def test_articles_of_the_page_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = {r.page_id: r.html for r in pages.collect()}
    got = wrapper.extract(pages).collect()
    assert len(got) == len(rows) and all(r.text == article(rows[r.page_id]) and r.n_chars == len(r.text) for r in got)


# op6


def at(s):
    return dt.datetime(2024, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=s)


def test_canonical_urls(spark):
    pairs = [("HTTP://www.Example.com:80/a/index.html?utm_source=x&b=1#top", "example.com/a?b=1"), ("https://example.com:443/", "example.com"), ("http://e.com/p?ref=1", "e.com/p"), ("http://e.com/p/?b=1&ref=2&c=3", "e.com/p?b=1&c=3"), ("//e.com", "//e.com"), (None, None), ("", "")]
    df = spark.createDataFrame(pairs, "url string, want string").select(revisits.canonical_url(F.col("url")).alias("got"), "want")
    assert all(r.got == r.want for r in df.collect())


def test_revisits(spark):
    full = {"etag": '"1"', "last-modified": "d1", "content-length": "9", "x": "old"}
    rows = [
        (1, "response", "http://e.com/", at(0), full),
        (2, "response", "https://www.e.com", at(50), {**full, "etag": '"2"'}),
        (3, "revisit", "http://e.com/#f", at(50), {"etag": '"1"', "content-length": "0", "x": "new"}),  # the response at that instant isn't earlier
        (4, "revisit", "http://e.com", at(90_000), {"etag": 'W/"2"', "set-cookie": "s"}),
        (5, "revisit", "http://e.com", at(90_001), {"etag": '"1"'}),
        (6, "revisit", "http://e.com", at(90_002), {"last-modified": "d1"}),
        (7, "revisit", "http://e.com", at(90_003), {}),
        (8, "revisit", "http://e.com", at(-5), {"etag": '"1"'}),
        (9, "revisit", None, at(99), {"etag": '"1"'}),
        (10, "response", None, at(0), full),
        (11, "revisit", "http://e.com", None, None),
        (12, "response", "http://null.com", at(0), None),
        (13, "revisit", "http://null.com", at(1), None),
        (14, "response", "http://tie.com", at(0), {"etag": "a"}),
        (15, "response", "http://tie.com", at(0), {"etag": "b"}),
        (16, "revisit", "http://tie.com", at(7200), {"etag": "b"}),
        (16, "revisit", "http://tie.com", at(7200), {"etag": "b"}),
    ]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "record_id long, kind string, url string, ts timestamp, headers map<string,string>, key string").withColumn("bucket", F.lit(1)).withColumn("full", F.lit(1))
    out = revisits.resolve(df).collect()
    got = {r.record_id: (r.refers_to, r.outcome) for r in out}
    assert len(out) == 11
    assert got == {3: (1, "resolved"), 4: (2, "resolved"), 5: (None, "validator mismatch"), 6: (2, "resolved"), 7: (None, "no validator"), 8: (None, "no earlier response"), 9: (None, "no earlier response"), 11: (None, "no earlier response"), 13: (None, "no validator"), 16: (15, "resolved")}
    headers = {r.record_id: r.headers for r in out}
    assert headers[3] == {"etag": '"1"', "last-modified": "d1", "content-length": "9", "x": "new"}
    assert headers[4]["etag"] == 'W/"2"' and "set-cookie" not in headers[4]
    assert revisits.resolve(df.filter("false")).count() == 0
