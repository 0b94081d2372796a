"""Links, images, references and URLs of generated pages, against the standard library's parsers."""

import html as std
import random
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

from pyspark.sql import functions as F

from siftwell.functions import html, urls
from siftwell.operators import site


class Plain(HTMLParser):
    def __init__(self, text):
        super().__init__()
        self.links, self.images, self.base = [], [], None
        self.feed(text)
        self.close()

    def handle_starttag(self, tag, attrs):
        own = {}
        for name, value in attrs:
            if value is not None:
                own.setdefault(name, value)
        if tag == "a" and "href" in own:
            self.links.append(own["href"])
        if tag == "img" and "src" in own:
            self.images.append(own["src"])
        if tag == "base" and "href" in own and self.base is None:
            self.base = own["href"]


HREFS = ["/a", "b/c.html", "../up", "./here", "../../../top/x", "https://other.example/p?q=1&amp;r=2#f", "//cdn.example/x",
         "?page=2", "#top", "a/./b/../c/", "mailto:x@y.example", "/caf&eacute;", "/n&#233;e", "/x&#x41;", "..", "."]


def generated(seed):
    """A page whose attributes are quoted in every way, with tags that look like others."""
    rng = random.Random(seed)
    out = ["<html><head>"]
    if seed % 3 == 0:
        out.append(rng.choice(['<base href="/docs/">', "<BASE HREF='https://base.example/x/y'>", "<base target=_top href=sub/>"]))
    out.append("<title>t</title></head>")
    for k in range(rng.randint(0, 12)):
        value = rng.choice(HREFS)
        quoted = rng.choice([f'"{value}"', f"'{value}'", value if " " not in value else f'"{value}"'])
        attr = rng.choice(["href=", "HREF=", "href = "]) + quoted
        more = rng.choice(["", ' title="a > b"', " title='x href=no'", " data-href=/no", " download", ' class="c d"'])
        tag = rng.choice(["a", "A", "area", "abbr", "img"])
        attr = attr.replace("href", "src").replace("HREF", "SRC") if tag == "img" else attr
        both = [attr, more] if rng.random() < 0.5 else [more, attr]
        out.append(f"<{tag} {both[0]} {both[1]} >link {k}</{tag}>" if tag != "img" else f"<img {both[0]} {both[1]} >")
        if rng.random() < 0.2:
            out.append('<!-- <a href="/hidden">x</a> --><script>var s = "<a href=/script>";</script>')
    return "".join(out)


def test_generated_pages(spark):
    pages = [(i, f"https://www.example.org/dir{i % 4}/page{i}.html", generated(i)) for i in range(300)]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string").select(
        "page_id", html.html_links(F.col("html")).alias("links"), html.html_images(F.col("html")).alias("images"),
        html.html_base(F.col("html")).alias("base"),
    ).collect()
    for r in rows:
        want = Plain(pages[r.page_id][2])
        assert (r.links, r.images, r.base) == (want.links, want.images, want.base), pages[r.page_id]


def test_links_lead_where_they_should(spark):
    pages = [(i, f"https://www.example.org/dir{i % 4}/page{i}.html", generated(i)) for i in range(120)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {}
    for r in site.page_links(df).collect():
        got.setdefault(r.page_id, []).append((r.link_pos, r.dst_url))
    for i, url, text in pages:
        plain = Plain(text)
        base = urljoin(url, plain.base) if plain.base else url
        want = [(k, urldefrag(urljoin(base, href))[0]) for k, href in enumerate(plain.links)]
        assert sorted(got.get(i, [])) == [w for w in want if w[1].startswith("http")], (url, text)


def test_urls_are_joined_as_the_standard_says(spark):
    hrefs = ["g", "./g", "g/", "/g", "?y", "g?y", "", "..", "../", "../g", "../..", "../../", "../../g", "../../../g", "/./g",
             "/../g", "g.", ".g", "g..", "..g", "./../g", "./g/.", "g/./h", "g/../h", " g ", "//h.example/a/../b", "g?y/../x"]
    base = "http://a.example/b/c/d?q"
    rows = spark.createDataFrame([(h,) for h in hrefs], "href string").select(
        "href", urls.resolve(F.lit(base), F.col("href")).alias("out")
    ).collect()
    want = {h: urldefrag(urljoin(base, h.strip()))[0] for h in hrefs}
    # RFC 3986, 5.2.2 removes dot segments there as well; the library does not.
    want["//h.example/a/../b"] = "http://h.example/b"
    assert {r.href: r.out for r in rows} == want


def test_references(spark):
    texts = ["a &amp; b", "&lt;b&gt;", "&amp;lt;", "&#233;&#xE9;&#Xe9;", "&eacute;&Eacute;&alpha;", "&unknown; &copy", "&#128512; &#x1F600;",
             "&#38;lt;", "&quot;&#39;", "no reference", "", "&#0;", "&#xD800;", "&#99999999999999999999;", "&middot;&euro;&#8364;"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", html.decode_references(F.col("t")).alias("out")).collect()
    want = {t: std.unescape(t) for t in texts}
    # References without a semicolon and names beyond HTML 4 stay as they are.
    want["&unknown; &copy"] = "&unknown; &copy"
    assert {r.t: r.out for r in rows} == want
