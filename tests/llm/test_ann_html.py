"""Neighbours: recall against brute force.  HTML: planted pages, and the site's statistics."""

import numpy as np

from forecourt.llm import ann, html_text, queries

SF = "/root/testdata/sf0.1"


def brute(rows, asked, k=10):
    good = [(i, v) for i, v in rows if i is not None and ann.usable(v)]
    out = {}
    for q, x in good:
        if asked(q):
            d = sorted((float(np.sqrt(((np.array(v, float) - np.array(x, float)) ** 2).sum())), i)
                       for i, v in good if i != q and len(v) == len(x))
            out[q] = d[:k]
    return out


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, lambda q: q % 100 == 0)
    got = {}
    for r in queries.op3_neighbours(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(got) == set(want)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.97 * sum(map(len, want.values()))
    vec = dict(rows)
    for q, found in got.items():
        assert found == sorted(found) and len(found) == 10
        for s, i in found:
            assert abs(s - np.linalg.norm(np.array(vec[q], float) - np.array(vec[i], float))) < 1e-9


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, []), (None, [1.0, 0.0]), (8, [3.0, 4.0]), (8, [1.0, 1.0]), (9, [1.0, 0.0, 0.0]), (100, [0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.nearest(table, table.where("vec_id % 100 = 0"), k=3)
           .orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 8, 1.0)]
    assert ann.nearest(table.limit(0), table).count() == 0 and ann.nearest(table, table.limit(0)).count() == 0
    few = ann.nearest(table, table.where("vec_id % 100 = 0"), k=10, query_numbers=1)
    assert few.count() == 3


def test_repeated_id_leaves_the_ranks_to_others(spark):
    r = np.random.default_rng(3)
    at = lambda radius: (radius * (x := r.normal(size=8)) / np.linalg.norm(x) + 3.0).tolist()
    rows = [(0, [3.0] * 8)] + [(7, at(0.5 + i / 1e5)) for i in range(300)] + [(100 + i, at(0.51 + i / 1e3)) for i in range(60)]
    rows += [(200 + i, at(1.5)) for i in range(300)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = [(x.score, x.vec_id) for x in ann.nearest(table, table.where("vec_id = 0")).orderBy("rank").collect()]
    nearest = {}
    for d, i in brute(rows, lambda q: q == 0, k=len(rows))[0]:
        nearest.setdefault(i, d)
    want = sorted((d, i) for i, d in nearest.items())[:10]
    assert [i for _, i in got] == [i for _, i in want] and np.allclose([d for d, _ in got], [d for d, _ in want])


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=x>Menu</a></ul></nav><div class="cookie-notice">We use cookies</div>
<!-- c --><article><h1>A &amp; B</h1><p><b>First&nbsp;line<br><p>Sec<i>ond</i>
 &eacute;&#233; &lt;x&gt;</p><div class="ad">Buy</div><ul><li>one<li>two</ul><form>Your name <input></form>
<section id="comments"><p>Nice!</p></section></article><aside>Side</aside><footer>&copy; F</footer></body></html>"""


def test_article_without_the_rest():
    assert html_text.main_text(html_text.parse(PAGE), frozenset()) == "A & B First line Second éé <x> one two"
    assert html_text.main_text(html_text.parse(None), frozenset()) == ""
    assert html_text.main_text(html_text.parse("<p>a < b <unclosed"), frozenset()) == "a < b <unclosed"
    deep = html_text.parse("<div>" * 100_000 + "x" + "</div>" * 100_000)
    assert html_text.main_text(deep, frozenset()) == "x" and len(html_text.places(deep)[1]) == 100_000
    own = ("<article><h1>Courts</h1><section class='search results'><p>On search</p></section><div class='legal-analysis'>Law</div>"
           "<p class=comment>A remark</p><div class='ad box'>Buy</div><div id=comments>Nice</div><div class=comment>Me too</div></article>")
    assert html_text.main_text(html_text.parse(own), frozenset()) == "Courts On search Law A remark"


def test_site_template_goes(spark):
    pages = [(i, "http://h.example/%d" % i, f"<html><body><div><p>All pages say this</p></div><div class=b><p>Own {i} text</p></div></body></html>")
             for i in range(40)]
    pages += [(100, None, "<p>All pages say this</p>"), (101, "http://h.example/x", None), (101, "http://other.example/", pages[0][2]),
              (None, "junk", "")]
    out = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {(r.page_id, r.url): r.text for r in out.collect()}
    assert got[(3, "http://h.example/3")] == "Own 3 text" and got[(100, None)] == "All pages say this"
    assert got[(101, "http://h.example/x")] == "" and got[(101, "http://other.example/")] == "All pages say this Own 0 text"
    assert len(got) == len(pages) and html_text.extract(out.limit(0)).count() == 0


def test_template_inside_articles_goes_and_copied_articles_stay(spark):
    page = "<html><body><%s><h1>T%s</h1><p>Own %s text</p><div class=box><p>Read <b>our</b> paper</p></div></%s></body></html>"
    pages = [(i, f"http://h.example/{i}", page % ("article", i, i, "article")) for i in range(20)]
    pages += [(100 + i, f"http://m.example/{i}", page % ("main", i, i, "main")) for i in range(20)]
    pages += [(200 + i, f"http://c.example/{i}", page % ("article", 0, 0, "article")) for i in range(20)]
    pages += [(300 + i, f"http://b.example/{i}", f"<main><div class=x>Beside {i}</div><div class=y>Same</div><article><p>In {i}</p></article></main>")
              for i in range(20)]
    out = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string"))
    got = {r.page_id: r.text for r in out.collect()}
    for i in range(20):
        assert got[i] == got[100 + i] == f"T{i} Own {i} text"
        assert got[200 + i] == "T0 Own 0 text Read our paper"
        assert got[300 + i] == f"Beside {i} In {i}"


def test_pages_of_the_table(spark):
    out = queries.op5_html_text(spark, "/root/testdata/sf0.01")
    rows = out.collect()
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages) and all(r.n_chars == len(r.text) for r in rows)
    for r in rows:
        body = pages[r.page_id].split("<article>")[-1].split("</article>")[0] if "<article>" in pages[r.page_id] else None
        if body is not None:
            import html
            import re
            assert r.text == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())
