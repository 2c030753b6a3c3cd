import pytest
from pyspark.sql import functions as F

from ranktrail.llm import extraction, revisits, urlfilter
from ranktrail.llm.common import pages
from tests.conftest import SMALL
from tests.llm.brute import article

PAGE = "page_id long, url string, html string"


def test_articles_come_out_whole(spark):
    docs = pages(spark, SMALL)
    for r in extraction.extract_main_text(docs).collect():
        assert r.text == article(r.html) and r.n_chars == len(r.text)


PLAIN = """<html><head><title>t</title></head><body><div class="top-menu"><a href=/a>Home</a></div>
<div><a href="/1">One link</a> <a href="/2">Another link</a></div>
<div id=main><p>{0} first &lt;b&gt; paragraph&nbsp;here.<p>{0}<script>var x = "<p>no</p>";</script> second.
<div class='ad-box banner'>buy <div>now</div> please</div><p>{0} third</div>
<div class="comments"><p>{0} says a reader</div><footer>{0}</footer>"""


def test_pages_without_an_article_are_cut_by_density():
    words = "some real words of the text that go on for a while and make a line"
    text = extraction.main_text(PLAIN.format(words))
    assert text.split("\n") == [
        f"{words} first <b> paragraph here.", f"{words} second.", f"{words} third",
    ]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("just text", "just text"),
        ("<p>a<br>b  c</p>\n<p>d &amp e &#233;</p>", "a b c\nd & e é"),
        ("<nav>menu</nav>", ""),
        ("<article><h1>T</h1><aside>x</aside><p>body", "T\nbody"),
        ("<nav><ul><li>x<article><p>body</p></article>", "body"),
        ("<article><p>a<form><p>f</form><p>b</article><p>out", "a\nb"),
        ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
        ("<article><p>a<!-- <p>hidden --><p title='>'>b</p>", "a\nb"),
        ("<article><p class=header-note>x</p><p>b</p><p hidden>c</p></article>", "b"),
    ],
)
def test_small_pages(page, text):
    assert extraction.main_text(page) == text


def test_long_page_and_clashing_columns(spark):
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    docs = spark.createDataFrame([(1, "u", long), (1, "u", long), (2, None, None)], PAGE)
    docs = docs.withColumns({"text": F.lit("old"), "n_chars": F.lit(3)})
    rows = extraction.extract_main_text(docs).collect()
    assert sorted(r.n_chars for r in rows) == [0, 99_999, 99_999]
    assert extraction.extract_main_text(docs.limit(0)).count() == 0


def test_rules_fit_hosts_and_paths(spark):
    urls = [
        "http://a.net/x", "http://net/", "http://net", "http://xnet/", "HTTPS://A.Example.NET/en/1?q",
        "http://example.net/de/", "http://example.com/de/#f", "http://a.example.com/de", "x://b.org/fr/",
        "no scheme", None, "://", "http://b.org?x=/fr/", "http://notexample.com/de/",
    ]
    docs = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGE)
    docs = docs.withColumns({"rule": F.lit(1), "walk": F.lit(2), "h_": F.lit(3)})
    rows = sorted(urlfilter.judge_urls(docs).collect(), key=lambda r: r.page_id)
    assert [(r.host, r.path, r.rule) for r in rows] == [
        ("a.net", "/x", "net/"), ("net", "/", "net/"), ("net", "", None), ("xnet", "/", None),
        ("a.example.net", "/en/1", "example.net/en/"), ("example.net", "/de/", "net/"),
        ("example.com", "/de/", "example.com/de/"), ("a.example.com", "/de", None),
        ("b.org", "/fr/", "org/fr/"), ("", "", None), ("", "", None), ("", "", None),
        ("b.org", "", None), ("notexample.com", "/de/", None),
    ]
    verdicts = dict(urlfilter.RULES)
    assert all(r.verdict == verdicts[r.rule] for r in rows if r.rule)
    assert urlfilter.judge_urls(docs.limit(0)).count() == 0


def test_trust_and_distrust_spread_over_links(spark):
    def page(i, host, *links):
        tags = "".join(f"<A class=x HREF='https://{x.upper()}/p'>l</A>" for x in links)
        return (i, f"http://{host}/en/{i}", f"{tags}<a href='/local'>x</a>")

    rows = [
        page(0, "bad.net"), page(1, "www.example.net", "friend.com", "friend.com"),
        page(2, "fan.com", "bad.net"), page(3, "friend.com", "deep.com"), page(4, "deep.com"),
        page(5, "fan2.com", "fan.com"), page(6, "both.com", "bad.net", "friend.com"), page(7, "alone.com"),
    ]
    got = {r.host: r for r in urlfilter.judge_urls(spark.createDataFrame(rows, PAGE)).collect()}
    d = 0.85
    assert got["friend.com"].trust == pytest.approx(d * (1 - d))
    assert got["deep.com"].trust == pytest.approx(d * d * (1 - d))
    assert got["fan.com"].distrust == pytest.approx(d * (1 - d) / 2 + 0 * d, rel=0.6)
    blocked = {h for h, r in got.items() if r.verdict == "block"}
    assert blocked == {"bad.net", "fan.com", "fan2.com", "both.com"}


CAPTURE = (
    "record_id long, ts long, url string, kind string, etag string, last_modified string, "
    "headers map<string,string>"
)


def _plain_resolution(rows):
    answers = {}
    for r in rows:
        if r[3] != "revisit":
            continue
        earlier = [
            x for x in rows
            if x[3] == "response" and None not in (x[0], x[2], x[1], r[1], r[2]) and x[1] < r[1]
            and _name(x[2]) == _name(r[2])
        ]
        best = max(earlier, key=lambda x: (x[1], x[0]), default=None)
        if best is None:
            answers[r[0]] = (None, "unknown", r[6] or {})
            continue
        tags = [t and t.removeprefix("W/") for t in (r[4], best[4])]
        same = tags[0] == tags[1] if None not in tags else None not in (r[5], best[5]) and r[5] == best[5]
        merged = (best[6] or {}) | {k: v for k, v in (r[6] or {}).items() if k in revisits.PERMITTED}
        answers[r[0]] = (best[0], "resolved" if same else "changed", merged if same else r[6] or {})
    return answers


def _name(url):
    return url.split("://")[1].removeprefix("www.").rstrip("/").split("?utm_x=")[0].lower()


@pytest.mark.parametrize("slices", [1, 16])
def test_revisits_against_a_plain_search(spark, slices):
    import random

    draw = random.Random(6)
    urls = ["http://a.org/x", "https://www.A.org/x/", "http://a.org/x?utm_x=1", "http://b.org", "http://c.org/y"]
    rows = []
    for i in range(400):
        kind = draw.choice(["response", "revisit", "revisit"])
        tag, date = draw.choice([None, "1", "W/1", "2"]), draw.choice([None, "mon", "tue"])
        headers = draw.choice([None, {"etag": "9", "content-length": "0", "date": "d"}, {"x": "y"}])
        url = draw.choices(urls, [9, 9, 9, 2, 1])[0]
        rows.append((i, draw.randrange(150), url, kind, tag, date, headers))
    rows += [(900, None, urls[0], "revisit", "1", None, None), (901, 99, None, "revisit", "1", None, None)]
    rows += [(None, 0, urls[0], "response", "1", None, None), (902, 5, urls[0], "request", None, None, None)]
    df = spark.createDataFrame(rows, CAPTURE).withColumns({"slice": F.lit(1), "p": F.lit(2)})
    got = revisits.resolve_revisits(df, slices).collect()
    assert {r.record_id: (r.response_id, r.outcome, r.headers) for r in got} == _plain_resolution(rows)
    assert len(got) == sum(r[3] == "revisit" for r in rows)
    twice = revisits.resolve_revisits(df.unionByName(df.filter("kind = 'revisit'")), slices)
    assert twice.count() == 2 * len(got)
    assert revisits.resolve_revisits(df.limit(0)).count() == 0


def test_canonical_urls(spark):
    urls = {
        "HTTP://WWW.A.org:80/x/?b=2&utm_source=f&a=1#top": "a.org/x?a=1&b=2",
        "https://a.org": "a.org",
        "a.org/p?ref=x": "a.org/p",
        "https://a.org:443/X//": "a.org/X",
        "": "",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = df.select("u", revisits.canonical_url(F.col("u")).alias("c")).collect()
    assert {r.u: r.c for r in got} == urls
