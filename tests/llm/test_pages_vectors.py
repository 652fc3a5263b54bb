"""Page extraction and nearest neighbours."""

import numpy as np
import pytest

from riskspark.llm import htmltext, vectors

PAGE = ("<!DOCTYPE html><html><head><title>T</title><script>if (a<b) document.write('</p><p>no');</script>"
        "<style>p{{}}</style></head><body><div class='site-header'><a href='/'>Home</a></div>"
        "<nav><ul><li><a>one</a><li><a>two</a></ul></nav><div id=cookie-notice>We use cookies</div>{left}"
        "<article><header><h1>Head &amp; tail</h1></header><p>First <b>bold</b>word&nbsp;here<br>next\n line"
        "<p>Own {own}<ul><li>item a<li>item b</ul><div class=\"ad-box\">Buy</div><form><input>Send</form>"
        "<p>Shared paragraph of all pages.</p></article>"
        "<section class='comments'><p>reader says</p></section><aside>more</aside><footer>&copy; x</footer></body></html>")
TEXT = "Head & tail First boldword here next line Own {own} item a item b Shared paragraph of all pages."


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string")


def test_article_without_the_rest(spark):
    rows = [(i, f"https://u@a.example.com:80/{i}", PAGE.format(left="", own=f"words {i}"), "x", "y") for i in range(30)]
    rows += [(100, None, None, None, None), (None, "nohost", "<p>only", None, None), (101, "http://b.org", "", None, None),
             (102, "http://b.org", "plain &lt;text&gt; <p>a<p>b" + " c" * 50_000, None, None)]
    got = {r["page_id"]: r for r in htmltext.extract(pages(spark, rows)).collect()}
    for i in range(30):
        assert got[i]["text"] == TEXT.format(own=f"words {i}")
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[100]["text"] == got[101]["text"] == "" and got[None]["text"] == "only"
    assert got[102]["text"] == "plain <text> a b" + " c" * 50_000
    assert htmltext.extract(pages(spark, [])).count() == 0


@pytest.mark.parametrize("keys", [htmltext.BROADCAST_KEYS, 0])
def test_recurring_subtrees_go_by_host(spark, keys):
    """No names, no article: only recurrence tells template from text; both ways of bringing keys agree."""
    def page(host, i):
        return (f"<html><body><div><p>Welcome to {host}</p></div><div><p>Text {host} {i}</p></div>"
                f"<div><p>Terms of use</p></div></body></html>")
    rows = [(1000 * h + i, f"http://{host}/{i}", page(host, i), "", "") for h, host in enumerate(["a.com", "b.com"])
            for i in range(20)]
    rows += [(5000 + i, f"http://small.com/{i}", page("small", i), "", "") for i in range(3)]
    got = {r["page_id"]: r["text"] for r in htmltext.extract(pages(spark, rows), keys).collect()}
    assert got[0] == "Text a.com 0" and got[1007] == "Text b.com 7"
    assert got[5001] == "Welcome to small Text small 1 Terms of use"  # too few pages to tell


def brute_nearest(data, step, k):
    ids = np.array([i for i, _ in data])
    x = np.array([v for _, v in data])
    out = {}
    for q in ids[ids % step == 0].tolist():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        d[ids == q] = np.inf
        out[q] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d))[:k] if np.isfinite(d[j])]
    return out


def vectors_of(rng, n, d=16, centres=12):
    c = rng.normal(0, 1, (centres, d))
    return [(i, (c[i % centres] + rng.normal(0, 0.4, d)).astype(np.float32).astype(float).tolist()) for i in range(n)]


def frame(spark, data):
    rows = [(i, v, 1, "x") for i, v in data]
    rows += [(100_000, None, 0, ""), (100_100, [0.0] * 16, 0, ""), (100_200, [float("nan")] * 16, 0, ""),
             (100_300, [None] + [1.0] * 15, 0, ""), (100_400, [1.0, 2.0], 0, ""), (None, [1.0] * 16, 0, "")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string")


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_exact_scores(spark):
    data = vectors_of(np.random.default_rng(1), 4000)
    got, want = found(vectors.nearest(frame(spark, data), step=50)), brute_nearest(data, 50, 10)
    assert set(got) == set(want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    x = {i: np.array(v) for i, v in data}
    for q, near in got.items():
        for v, s in near:
            assert abs(s - np.linalg.norm(x[q] - x[v])) < 1e-9


def test_one_vector_repeated_and_few_candidates(spark):
    rng = np.random.default_rng(2)
    data = vectors_of(rng, 1500)
    data = [(i, data[1][1] if i % 3 == 0 else v) for i, v in data]
    got, want = found(vectors.nearest(frame(spark, data), step=100, probes=1)), brute_nearest(data, 100, 10)
    assert all(got[q] == [(v, s) for v, s in want[q]] for q in want if q % 3 == 0)
    few = vectors_of(rng, 6)
    got, want = found(vectors.nearest(frame(spark, few), step=2)), brute_nearest(few, 2, 10)
    assert {q: [v for v, _ in n] for q, n in got.items()} == {q: [v for v, _ in n] for q, n in want.items()}
    assert vectors.nearest(frame(spark, []).where("false")).count() == 0


def test_blocks_do_not_change_results(spark):
    data = vectors_of(np.random.default_rng(3), 300)
    df = vectors.usable(frame(spark, data)).selectExpr("vec_id", "v", "0 as part")
    q = df.where("vec_id % 10 = 0")
    one = found(vectors.search(q, df, 5))
    assert found(vectors.search(q, df, 5, block=40, query_block=7)) == one == {
        k: [(v, s) for v, s in n] for k, n in found(vectors.search(q, df, 5, block=1000)).items()}


def test_parts_are_balanced_and_follow_the_graph():
    x = np.array([v for _, v in vectors_of(np.random.default_rng(4), 1200)])
    graph = vectors.neighbour_graph(x, 10)
    label = vectors.balanced_parts(x, graph, 8)
    sizes = np.bincount(label, minlength=8)
    assert sizes.min() >= 120 and sizes.max() <= 180
    assert (label[graph] == label[:, None]).mean() > 3 / 8


@pytest.mark.parametrize("source, text", [
    ("<article>one</article><div>no</div><article>two</article>", "one two"),
    ("<div class=content>a</div><nav>x</nav><div class='content'>b</div>", "a b"),
    ("<main>m<article>in</article></main>", "in"),
    ("<p title='a hidden gem'>Keep", "Keep"), ("<p title=don't>Hello", "Hello"), ("<p title=\"x>y\">z", "z"),
    ("<div hidden>no</div><div aria-hidden=true>no</div><div style='display : none'>no</div>yes", "yes"),
    ("<article><p class=alert>Careful</p><p class='notice search'>Look</p></article>", "Careful Look"),
    ("<article>a<div class=ad>no</div><section id=comments>no</section><form>no</form>b</article>", "a b"),
    ("<a href=/foo/>t</a> u", "t u"), ("a < b and c > d <3", "a < b and c > d <3"), ("<br/>q<span/>w", "qw"),
    ("<p a='b' =c \"d>e</p>", "e"), ("<p " + "a=b " * 20_000 + ">x", "x"), ("<p " + "'" * 50_000, ""), ("", "")])
def test_markup_is_read_as_browsers_do(source, text):
    root = htmltext.parse(source)
    htmltext.prune(root, set(), {})
    got = htmltext.main_text(root)
    assert got == text or (text == "" and source.startswith("<p '") and "<p" in got)


def test_extraction_equals_an_event_parser(spark):
    """All given pages against a brute-force extraction by the standard library's event parser."""
    from html.parser import HTMLParser

    from conftest import SF01
    gone = {"nav", "aside", "footer", "form", "script", "style", "head", "title", "button"}

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.stack, self.out = [], []

        def handle_starttag(self, tag, attrs):
            names = dict(attrs).get("class") or ""
            if tag not in htmltext.VOID:
                self.stack.append((tag, tag in gone or "ad" in names.split() or "comments" in names.split()))
            if tag in htmltext.BLOCK or tag == "br":
                self.out.append(" ")

        def handle_endtag(self, tag):
            open_ = [t for t, _ in self.stack]
            if tag in open_:
                del self.stack[len(open_) - 1 - open_[::-1].index(tag):]
            if tag in htmltext.BLOCK:
                self.out.append(" ")

        def handle_data(self, data):
            tags = [t for t, _ in self.stack]
            if "article" in tags and not any(g for _, g in self.stack):
                self.out.append(data)

    pages_ = spark.read.parquet(f"{SF01}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in htmltext.extract(pages_).collect()}
    assert len(got) == pages_.count()
    for r in pages_.collect():
        reader = Reader()
        reader.feed(r["html"])
        assert got[r["page_id"]] == " ".join("".join(reader.out).split()), r["page_id"]


def test_templates_clean_pages_that_name_nothing(spark):
    """Menus, notices and footers without a telling tag or name, each page with its own text: only
    recurrence tells, whatever the size of the host, and without templates the pages are not clean."""
    def page(host, i):
        menu = "".join(f"<div><a href='/{i}/{j}'>Part {j} of {host}</a></div>" for j in range(5))
        return (f"<html><body><div class=x1><div>{menu}</div></div><div class=x2><p>Own {host} text {i}</p><p>More {i * 7}</p></div>"
                f"<div class=x3><p>We sell things at {host}</p></div><div class=x4>Footer of {host}</div></body></html>")
    rows = [(1000 * h + i, f"http://{host}/{i}", page(host, i), "", "") for h, (host, n) in
            enumerate([("a.com", 400), ("b.com", 12)]) for i in range(n)]
    # a notice on few of a large host's pages is template all the same
    rows = [(p, u, s.replace("<div class=x4>", "<div>Now open late</div><div class=x4>") if p in range(11) else s, a, b)
            for p, u, s, a, b in rows]
    got = {r["page_id"]: r["text"] for r in htmltext.extract(pages(spark, rows)).collect()}
    for p, u, *_ in rows:
        host, i = ("a.com", p) if p < 1000 else ("b.com", p - 1000)
        assert got[p] == f"Own {host} text {i} More {i * 7}"
    root = htmltext.parse(rows[0][2])
    htmltext.prune(root, set(), {})
    assert htmltext.main_text(root) != got[0]
