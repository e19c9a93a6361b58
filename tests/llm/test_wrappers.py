import html
import json
import re

from racelens.llm import wrappers as W


def brute(page):
    """Main text of the test pages by their known layout: the article's heading and paragraphs."""
    m = re.search(r"<article>(.*?)</article>", page or "", re.S)
    if not m:
        return ""
    blocks = re.split(r"</?(?:h1|p)>", m[1])
    out = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
    return "\n\n".join(b for b in out if b)


def test_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = W.op2_main_text(spark, "/root/testdata/sf0.01").collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, brute(pages[r.page_id].html), len(r.text)), r.page_id


def test_layouts_without_article(spark):
    def page(n, extra=""):
        return (f"<html><head><title>T{n}</title></head><body><div class='site-header'>Logo</div><div id=top><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></div>"
                f"<div class='post'><h2>Title {n}</h2><p>First {n} &amp; more&nbsp;text<p>Second <em>{n}</em><br>line</div>{extra}<div class='comments'><p>Reader {n}</div><div>Made with love</div></body></html>")
    rows = [(n, f"http://h.example/{n}", page(n, "<div><p>Extra " + str(n) + "</div>" if n % 2 else "<aside>See also</aside>"), 1, "w") for n in range(8)]
    rows += [(100, None, None, 1, "w"), (101, "http://x.example", "", 1, "w"), (102, "//y.example/", "plain < text &lt;p&gt;", 1, "w"), (103, "http://y.example:80", "<p>cut <b", 1, "w"), (104, "http://z", "<article><p>a" + "<p>b" * 30_000, 1, "w")]
    d = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, part int, wrapper string")
    wrappers = W.infer_wrappers(spark, d)
    got = {r.page_id: r.text for r in W.main_text(spark, d, wrappers).collect()}
    for n in range(8):
        want = [f"Title {n}", f"First {n} & more text", f"Second {n} line"] + [f"Extra {n}"] * (n % 2)
        assert got[n] == "\n\n".join(want)
    assert (got[100], got[101], got[102], got[103]) == ("", "", "plain < text <p>", "cut")
    assert got[104] == "\n\n".join(["a"] + ["b"] * 30_000)
    text = W.expression(json.loads(wrappers.where("host = 'h.example'").first().wrapper))
    assert ")?" in text and ")+" in text and "#text" in text and "|" not in text
    assert W.main_text(spark, d.limit(0), W.infer_wrappers(spark, d.limit(0))).count() == 0


def test_alignment_finds_optional_and_repeated_groups():
    a, b, c = (W.fold(W.stream(x)) for x in ("<ul><li>x<li>y</ul><p>one", "<ul><li>z</ul><div>note</div><p>two", "<ul><li>z</ul><p>two"))
    w = W.align(W.align(a, b), c)
    assert W.expression(w) == "<ul> (<li> #text)+ </ul> ( <div> " + f"'{b[5][2]}'" + " </div> )? <p> #text"


def test_no_article_is_lost_by_its_host_or_its_frame(spark):
    body = "<p>First part of the one article<p>Second part of it"
    mixed = [(f"http://mixed.example/{n}", f"<article><p>Bounded {n}</article>" if n % 2 else f"<div class=post><p>Free {n}</div><div>Made with love</div>") for n in range(12)]
    mixed += [("http://mixed.example/x", "<div class=story><h3>Alone</h3><p>of its layout</div>")]
    copies = [(f"http://copies.example/{n}", f"<div>{body}</div>") for n in range(9)]
    same = [(f"http://same.example/{n}", f"<!-- {n} --><nav>Menu {n}</nav><div>{body}</div>") for n in range(9)]
    frames = [("http://frames.example/1", f"<body class='no-sidebar'><div class='has-sidebar'><main class='with-menu'>{body}<div class=comments>Reader</div></main><div class=sidebar>Side</div></div>"),
              ("http://frames.example/2", f"<body class='no-sidebar'><div>{body}</div><div class=sidebar>Side</div>"),
              ("http://frames.example/3", f"<div class='post'>{body}</div><div class='comments'><article class='comment'>Reader</article></div><aside><article>Side</article></aside>")]
    rows = mixed + copies + same + frames
    d = spark.createDataFrame([(n, u, h) for n, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    article = "First part of the one article\n\nSecond part of it"
    want = [f"Bounded {n}" if n % 2 else f"Free {n}" for n in range(12)] + ["Alone\n\nof its layout"] + [article] * 21
    for parts in (1, 6):
        e = d.repartition(parts, "page_id")
        got = {r.page_id: r.text for r in W.main_text(spark, e, W.infer_wrappers(spark, e)).collect()}
        assert [got[n] for n in range(len(rows))] == want
