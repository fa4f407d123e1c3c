import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import html_extract as H
from tidemark.llm import licenses, url_filter

WEIGHTS = H.learned()

PAGES = [
    ("<p>Just a fragment", "Just a fragment"),
    ("plain text &amp; no tags", "plain text & no tags"),
    ("<body><div class='content'><h2>A b</h2><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></div><div class='related-posts'><a>other</a></div>", "A b one two x y"),
    ("<nav>menu</nav><article><h1>T\u00a0 x</h1><p>wor<b>ld</b>s&#33;<br>next</p><div class='ad'>buy it</div><script>var a='</p>'</script><p>end.</p></article><footer>foot</footer>", "T x worlds! next end."),
    ("<article><p>text here</p></article><section id='comments'><article class='comment'><p>great post thanks a lot for all of it</p></article></section>", "text here"),
    ("<div class=\"cookie-notice\"><p>we use cookies</p></div><main><p>a &lt;b&gt; c</p><form><label>name</label></form><style>p{}</style><p hidden>no</p></main><aside><p>side</p></aside>", "a <b> c"),
    ("<article><header><h1>Title</h1></header><p>body</p></article>", "Title body"),
    ("<!-- x > y --><article><p title='a > b'>one</p><p class=\"x\">two &am three &amp four</article>", "one two &am three & four"),
    ("<article><p>x</p></article><script>never closed <p>more</p>", "x"),
    ("<script>only</script>", ""),
]


@pytest.mark.parametrize("page,want", PAGES)
def test_pages(page, want):
    assert H.extract(page, WEIGHTS) == want


@pytest.mark.parametrize("tag", ["<svg viewBox='0 0 1 1'/>", "<math/>", "<canvas />", "<object>", "<video>", "<audio>", "<select>", "<canvas>", "<title>", "<textarea>", "<noscript>", "<svg/><svg><text>label</text></svg>", "<select><select><option>a</select>"])
def test_no_page_is_cut_at_an_element(tag):
    page = f"<article><p>one two three</p>{tag}<p>four five six</p></article>"
    assert H.extract(page, WEIGHTS) == "one two three four five six"


def test_words_of_formulas_and_objects_count():
    assert H.extract("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><object><p>shown instead</p></object></article>", WEIGHTS) == "so x = 2 holds shown instead"
    assert H.extract("<article><p>one two</p><svg><text>label</text></svg><select><option>choice</select><p>three</p></article>", WEIGHTS) == "one two three"


def test_best_run_equals_brute_force():
    import random

    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-3, -1, 0, 1, 2]) for _ in range(rng.randint(0, 12))]
        a, b = H.best_run(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert sum(scores[a:b]) == max([0, *sums])


@given(st.text(alphabet="<>/pab =\"'!-&;#x3articledv ", max_size=200))
@settings(max_examples=200, deadline=None)
def test_any_text_is_a_page(page):
    text = H.extract(page, WEIGHTS)
    assert text == " ".join(text.split())


def test_extracted(spark):
    pages = spark.createDataFrame([(k, f"u{k}", h) for k, (h, _) in enumerate(PAGES)] + [(97, None, None), (98, "", ""), (0, "u0", PAGES[0][0])], "page_id long, url string, html string")
    out = H.extracted(pages.withColumn("TEXT", F.lit("mine")))
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"]
    rows = out.collect()
    assert [r.text for r in rows] == [w for _, w in PAGES] + ["", "", PAGES[0][1]] and all(r.n_chars == len(r.text) for r in rows)
    assert H.extracted(pages.limit(0)).count() == 0


URLS = [
    ("https://Sub.Example.NET/en/1?q#f", "sub.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://anet/x", "anet", "/x", None, None),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://example.net", "example.net", "", None, None),
    ("http://example.com/de/a", "example.com", "/de/a", "example.com/de/", "block"),
    ("http://myexample.com/de/a", "myexample.com", "/de/a", None, None),
    ("ftp://x.org/fr/?a=/b", "x.org", "/fr/", "org/fr/", "allow"),
    ("x://h?://y/z", "h", "", None, None),
    ("http://u:p@É.org:80/P/q\nr#x", "u:p@É.org:80", "/P/q\nr", None, None),
    ("no scheme/en", "", "", None, None),
    ("://", "", "", None, None),
    (None, "", "", None, None),
    ("", "", "", None, None),
]


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(k, u[0]) for k, u in enumerate(URLS)], "page_id long, url string").withColumn("Host", F.lit(1))
    rows = sorted(url_filter.judged(pages).collect())
    for r, (_, host, path, rule, verdict) in zip(rows, URLS):
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.probability >= 0.5 else "allow"))
    assert url_filter.judged(pages.limit(0)).count() == 0


def test_url_model():
    rows = url_filter.labelled_urls()
    model = url_filter.trained([r for k, r in enumerate(rows) if k % 5])
    right = [(url_filter.probability(h.encode(), p.encode(), model) >= 0.5) == y for k, (h, p, y) in enumerate(rows) if not k % 5]
    assert sum(right) / len(right) > 0.93
    judge = lambda h, p: url_filter.probability(h.encode(), p.encode(), model)
    assert judge("www.poker-zone.com", "/en/1") > 0.5 > judge("www.thernd.org", "/en/1")


def test_licences(spark):
    notices = ["Licensed under the Apache License, Version 2.0.", "released under the MIT license", "All rights reserved.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0."]
    plain = ["He has a driving license and all his rights.", "Version 2.0 of the story was released.", "The general public is welcome here."]
    docs = [(k, f"Ünvented words here.\n{t}\nmore words") for k, t in enumerate(notices + plain)] + [(90, None), (91, ""), (92, "MIT"), (0, "x\n" + notices[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("notices", F.lit(0))
    rows = licenses.scanned(df, licenses.learned(df)).collect()
    families = [[n.family for n in r.notices] for r in rows]
    assert families == [["Apache"], ["MIT"], ["proprietary"], ["GPL"], ["CC-BY-NC"], [], [], [], [], [], [], ["Apache"]]
    first = rows[0]
    assert first.text[first.notices[0].start : first.notices[0].end] == notices[0].rstrip(".") and first.n_paragraphs == 3
    assert licenses.scanned(df.limit(0), licenses.learned(df.limit(0))).count() == 0


def test_template_of_another_family_does_not_confirm():
    model = licenses.trained([])
    import numpy as np

    text = "Licensed under the weather of the city and the river all day long"
    assert licenses.scan(np.frombuffer(text.encode(), np.uint8), model)[1] == []
    assert re.match("unknown", licenses.FAMILIES[0])
