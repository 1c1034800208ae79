"""Page text, embeddings, licences and the pipeline."""

import random

import numpy as np
import pytest
from corpus_cases import EDGE, docs_df, random_docs
from pyspark.sql import functions as F

import corpus_pipeline
from lexisift.llm import decontaminate, embeddings, html_text, licenses, quality, simhash, toxicity
from lexisift.llm import queries as Q

SF = "/root/testdata/sf0.01"


# ------------------------------------------------------------------ op4 --
W = {"word p": 5.0, "word h1": 5.0, "o p": -0.1, "c p": -0.1, "o div": -4.0, "c div": -4.0, "word": 0.5, "tag": -1.0}
CASES = [
    (None, ""), ("", ""), ("just words", "just words"), ("<p>a &amp; b&lt;c&#33; &amp</p>", "a & b<c! &"),
    ("<nav><p>menu words here</p></nav><p>one\n  two<br>three</p><p>four</p><footer><p>foot</p></footer>", "one two three\n\nfour"),
    ("<p>keep</p><div class='comments'><p>reader one</p><p>reader two</p></div><p>this</p>", "keep\n\nthis"),
    ("<p>keep <b>bold</b>ly</p><script>var t='</p>';</script><style>p{}</style><!-- <p>no</p> --><p>this</p>", "keep boldly\n\nthis"),
    ("<p>open <b>bold<br><p>next</p><ul><li>x</li><li>y</li></ul><p>" + "last " * 9, "open bold\n\nnext\n\nx\n\ny\n\n" + "last " * 8 + "last"),
    ("<div class='ad'>buy now<p>real text of the page</p>", "real text of the page"),
    ("<form><p>name</p><input value='>'></form><p title=\"a>b\">q</p>", "q"),
    ("<p>text</p><!-- never closed <p>x</p>", "text"), ("<p>text</p><script>never closed", "text"), ("<p>a < b and 3<4</p><p clas", "a < b and 3<4"),
    ("<article><header><h1>Title</h1></header><p>body</p></article>", "Title\n\nbody"),
    ("<header><h1>Site</h1></header><article><p>body</p></article>", "body"),
    ("<form><article><p>body</p></article><p>out</p></form>", "body\n\nout"),
    ("<div class='page with-sidebar'><p>body text</p><div class='Sidebar'><p>side</p></div></div>", "body text"),
    ("<article><p>body</p></article><section class='comments'><article><p>me too</p></article></section>", "body"),
    ("<div class='site-header'><p>brand</p></div><div class='post-header'><h1>The long title</h1></div><p>body text here</p>", "The long title\n\nbody text here"),
    ("<p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"), ("<p></p><br><hr>", ""), ("</p></div>x", "x"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_main_text_of_small_pages(page, want):
    assert html_text.main_text(page, W) == want


NAV = "<!DOCTYPE html><html><head><title>t</title></head><body><nav><ul><li><a href=x>menu</a></li></ul></nav>"
LONG = "<p>" + "word " * 29 + "word</p>"
BODY = "word " * 29 + "word"
LEARNED_CASES = [
    # boxes of unlisted classes, short and long, beside the article
    ("<div class=x7><p>Win a free car today now</p></div><article><h1>T</h1>" + LONG + "</article><footer>f</footer>", ["T", BODY]),
    ("<div class=x7><p>" + "win " * 200 + "</p></div><article><h1>T</h1>" + LONG * 30 + "</article><div class=y8>" + "buy " * 50 + "</div>", ["T"] + [BODY] * 30),
    # kinds that no labelled page shows, at both ends of an article
    ("<article><h1>T</h1>" + LONG + "<table><tr><td>a</td><td>b</td></tr></table></article>", ["T", BODY, "a", "b"]),
    ("<article><h1>T</h1>" + LONG + "<ul><li>x</li><li><a href=u>y</a></li></ul></article>", ["T", BODY, "x", "y"]),
    ("<article><figure><img src=x><figcaption>Cap here</figcaption></figure>" + LONG + "</article>", ["Cap here", BODY]),
    ("<article><h1>T</h1>" + LONG + "<pre>code x</pre><dl><dt>a</dt><dd>b</dd></dl><p>end</p></article>", ["T", BODY, "code x", "a", "b", "end"]),
    ("<article><div><div><h1>T</h1></div></div><div class=body><p>a b c</p></div><section><p>tail</p></section></article>", ["T", "a b c", "tail"]),
    # class names that only look like those of boxes, and real ones
    ("<article><h1>T</h1>" + LONG + "<section class=social-impact><p>Impact</p></section><div class=related-work><p>rel</p></div></article>", ["T", BODY, "Impact", "rel"]),
    ("<article><h1>T</h1>" + LONG + "<div class=ad-box>buy</div><div class='share-buttons'>s</div><div id=commentList>c</div>" + LONG + "</article>", ["T", BODY, BODY]),
    # pages without article
    ("<div class=x7><p>Win a free car today now</p></div><div id=content><h1>Ti</h1>" + LONG * 3 + "<table><tr><td>a</td></tr></table></div>"
     "<div class=comments><p>c</p></div><footer>f</footer>", ["Ti"] + [BODY] * 3 + ["a"]),
    ("<h1>Title</h1>" + LONG + "<ul><li>a</li></ul><footer>f</footer>", ["Title", BODY, "a"]),
    ("<ul><li><a>Home</a></li><li><a>About</a></li></ul><h1>Title</h1>" + LONG, ["Title", BODY]),
    # a teaser that is an article does not make the rest of the page a box
    ("<article><p>one teaser</p></article><h1>Title</h1>" + LONG * 3, ["Title"] + [BODY] * 3),
]


@pytest.fixture(scope="module")
def learned(spark):
    return html_text.learn(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.mark.parametrize("page,want", LEARNED_CASES)
def test_learned_weights_lose_no_block_and_let_no_box_in(learned, page, want):
    assert html_text.main_text(NAV + page, learned).split("\n\n") == want


def test_classes_are_learned_over_all_elements(spark):
    """A class seen only beside articles is noise also inside one; one seen inside is not, listed or not."""
    page = "<div class=zq>z</div><div id=wrap><article><h1>T</h1>" + LONG + "<div class=promo>p</div></article></div>"
    w = html_text.learn(spark.createDataFrame([(page,)] * 200, "html string"))
    assert w["class zq"] < -4 < 4 < w["class promo"] and "class wrap" not in w
    got = html_text.main_text("<article>" + LONG + "<div class=zq>no</div><div class=promo>yes</div></article>", w)
    assert got == BODY + "\n\nyes"


def test_best_run_equals_brute_force():
    r = random.Random(0)
    for _ in range(300):
        s = np.array([r.choice([-3, -2, -1, 1, 2, 3]) for _ in range(r.randrange(9))], float)
        lo, hi = html_text.best_run(s)
        best = max([0.0] + [s[i:j].sum() for i in range(len(s)) for j in range(i + 1, len(s) + 1)])
        assert s[lo:hi].sum() == best and (best > 0 or lo == hi == 0)


def test_scanner_is_linear_on_unclosed_markup():
    import time
    for page in ("<!-- " * 200_000, "<p" * 300_000, "<a title='" * 100_000, "<div class=ad>" * 100_000, "<p><b>" * 100_000,
                 "</p>" * 200_000, "<script>" * 100_000, "<p>x" * 100_000, "&" * 500_000):
        t = time.thread_time()
        html_text.main_text(page, W)
        assert time.thread_time() - t < 20


def test_pages_equal_the_article_elements(spark):
    """On the test pages the article is marked; the extractor is not told."""
    import html
    import re
    for r in html_text.extract(spark.read.parquet(f"{SF}/pages.parquet")).join(
            spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_page_edge_rows(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (2, "u", "", "x"), (None, "u", "<p>words</p>", None), (5, "u", "<p>" + "long " * 200_000, "x")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html_text.extract(d)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.n_chars) for r in got.collect()) == [(0, 5), (1, 0), (2, 0), (2, 0), (5, 999_999)]
    assert html_text.extract(d.limit(0)).count() == 0


# ------------------------------------------------------------------ op7 --
def brute_vectors(rows, cosine=0.98):
    ok = [i for i, (_, v, lab) in enumerate(rows) if lab is not None and v is not None and len(v)
          and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in ok}
    top, links = list(range(len(rows))), [0] * len(rows)
    def root(i):
        while top[i] != i:
            i = top[i]
        return i
    for a in ok:
        for b in ok:
            if a != b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                x, y = sorted((root(a), root(b)))
                top[y] = x
    low = {}
    for i, (k, _, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return sorted((repr(rows[i][0]), links[i], repr(low.get(root(i)))) for i in range(len(rows)))


@pytest.mark.parametrize("cell_rows,block", [(4096, 2048), (20, 16), (60, 8)])
def test_embeddings_equal_brute_force(spark, cell_rows, block):
    rng = np.random.default_rng(0)
    rows = []
    for g in range(40):
        c = rng.normal(size=8)
        for _ in range(int(rng.integers(1, 9))):
            rows.append((len(rows), (c + rng.normal(scale=0.09, size=8)).astype(np.float32).tolist(), int(g % 2)))
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(70)] + [(2000, [2 * x for x in rows[3][1]], rows[3][2])]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 8, 0), (3003, [float("nan")] + [1.0] * 7, 0), (3004, [None] + [1.0] * 7, 0),
             (3005, [float("inf")] + [1.0] * 7, 0), (3006, rows[0][1], None), (3007, rows[0][1][:4], 0), (None, rows[0][1], 0),
             (None, None, 1), (5, rows[5][1], rows[5][2])]
    d = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node int, n int")
    got = embeddings.near_duplicates(d, cell_rows=cell_rows, block=block).collect()
    assert sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in got) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert embeddings.near_duplicates(d.limit(0)).count() == 0


# ----------------------------------------------------------------- op10 --
def test_licences_of_texts_and_directories(spark):
    files = [
        ("a/LICENSE", "Licensed under the Apache License, Version 2.0"), ("a/b/x.py", "code only"), ("a/b/y.py", "code and more code\n" * 20 + "Released under the MIT License."),
        ("a/b/c/COPYING.txt", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007"), ("a/b/c/d/z.py", "more code"), ("other/q.py", "none here"),
        ("other/notes.md", "licence plates are licensed by the road office and the copyright of maps is a matter of debate for many people"),
        ("x//y.txt", "long text. " * 50 + "This work is licensed under the GNU General Public License, version 3."), ("nul", None), (None, "code"), ("", ""),
        ("k/bigger.txt", "word " * 5000 + "Licensed under CC BY-NC 4.0. " + "word " * 5000), ("t/license", "Released under the MIT License."),
        ("t/copying", "Released under the MIT License."), ("t/u/v", "x"), ("a", "top")]
    rows = [(i, t, p, 1, "x") for i, (p, t) in enumerate(files)]
    d = spark.createDataFrame(rows, "doc_id long, text string, file string, score int, license string")
    got = {r.path: (r.license, r.origin, r.license_dir) for r in licenses.scan(d, F.col("file")).collect()}
    assert got["a/LICENSE"] == ("Apache-2.0", "own", None) and got["a/b/x.py"] == ("Apache-2.0", "inherited", "a")
    assert got["a/b/y.py"] == ("MIT", "own", None)
    assert got["a/b/c/d/z.py"] == ("GPL-3.0", "inherited", "a/b/c")
    assert got["other/q.py"][1] == got["other/notes.md"][1] == got["nul"][1] == got[None][1] == got["a"][1] == "none"
    assert got["x/y.txt"][:2] == ("GPL-3.0", "own") and got["k/bigger.txt"][:2] == ("CC-BY-NC-4.0", "own")
    assert got["t/u/v"] == ("MIT", "inherited", "t") and len(got) == len(files)
    assert licenses.scan(d.limit(0), F.col("file")).count() == 0


def test_every_template_is_its_own_best():
    t = licenses.Templates(licenses.TEMPLATES)
    for name, texts in licenses.TEMPLATES.items():
        for x in texts:
            score, best = t.best(licenses.TOKEN.findall(x.lower()))
            assert best == name and score == pytest.approx(1)


def test_licences_of_the_documents_equal_a_plain_search(spark):
    # the last one named wins: a grant outweighs the reservation of rights
    notice = {"All rights reserved": "Proprietary", "GNU General Public License, version 3": "GPL-3.0", "CC BY-NC 4.0": "CC-BY-NC-4.0", "MIT License": "MIT", "Apache License, Version 2.0": "Apache-2.0"}
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    own = {r.doc_id: r.license for r in Q.QUERIES["op10_licenses"](spark, SF).collect() if r.origin == "own"}
    want = {i: v for i, t in text.items() for k, v in notice.items() if k in t}
    assert own.keys() == want.keys() and sum(own[i] == want[i] for i in own) >= 0.99 * len(own)


def test_notices_are_found_whatever_their_words(spark):
    t = licenses.Templates(licenses.TEMPLATES)
    for text, want in (("All rights reserved.", "Proprietary"), ("code\nAll rights reserved.\ncode", "Proprietary"), ("Released under CC0 1.0", "CC0-1.0"),
                       ("This work is CC BY-SA 4.0", "CC-BY-SA-4.0"), ("All human rights matter to the ISC of BSD and MIT.", None),
                       ("All rights reserved.\nReleased under the MIT License.", "MIT")):
        assert licenses.own_licence(text, t)[0] == want, text
    own = {r.doc_id: r.license for r in Q.QUERIES["op10_licenses"](spark, SF).collect() if r.origin == "own"}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        if "All rights reserved" in r.text:
            assert own[r.doc_id] == "Proprietary"


def test_no_passage_without_trigger_reaches_the_threshold():
    t, r = licenses.Templates(licenses.TEMPLATES), random.Random(0)
    rest = sorted(t.idf.keys() - t.triggers)
    for texts in licenses.TEMPLATES.values():
        for x in texts:
            words = [w for w in licenses.TOKEN.findall(x.lower()) if w not in t.triggers]
            for _ in range(20):
                assert t.best(words)[0] < licenses.THRESHOLD
                words = r.sample(rest, r.randrange(1, 6)) + [w for w in words if r.random() < 0.8]


def test_wrapped_notices_and_headings():
    t = licenses.Templates(licenses.TEMPLATES)
    for text, want in (("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991", "GPL-2.0"), ("Licensed under the GNU General Public License,\nversion 2", "GPL-2.0"),
                       ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1", "LGPL-2.1"), ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999", "LGPL-2.1"),
                       ("GNU LESSER GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007", "LGPL-3.0"), ("GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007", "AGPL-3.0"),
                       ("GNU GENERAL PUBLIC LICENSE\n\nVersion 3, 29 June 2007", "GPL-3.0"), ("Copyright 2023 Acme Corp. All rights reserved.", "Proprietary"),
                       ("# Licensed\n# under the\n# GNU Lesser\n# General\n# Public License\n# version 2.1", "LGPL-2.1")):
        for around in ("", "word " * 100):
            assert licenses.own_licence(around + text + " " + around, t)[0] == want, text
        assert licenses.own_licence(text, t)[2] >= licenses.FILE_SHARE
    assert licenses.own_licence("Copyright 2023 Acme Corp. All rights reserved.", t)[1] > 0.9


# ------------------------------------------------------------- pipeline --
def test_pipeline_equals_its_stages(spark):
    """Every stage against the operator's own decision on the stage's input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("labels", "benchmark"))
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    for (name, stage), want in zip(corpus_pipeline.STAGES[:4], (
            lambda d: toxicity.score(d, labels).filter("predicted = 0"), lambda d: quality.classify(d, labels).filter("predicted = 1"),
            lambda d: simhash.near_duplicates(d).filter("doc_id = component_id"), lambda d: decontaminate.decontaminate(d, bench).filter("not contaminated"))):
        out = corpus_pipeline.written(stage(spark, docs, SF), "stage")
        assert out.columns == docs.columns and ids(out) == ids(want(docs)), name
        assert 0 < out.count() < docs.count()
        docs = out
    mixed = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert ids(mixed) == ids(docs)
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).collect())) == sorted(map(repr, mixed.collect()))


def test_stages_on_awkward_rows(spark, tmp_path):
    rows = [(*r, 1, 2, "x") for r in random_docs(40) + EDGE]
    d = docs_df(spark, rows, ", score int, fp_ int, row_ string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "w1 w2 w3"), (2, None)], "item_id long, text string")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for some in (d, d.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, some, str(tmp_path))
            assert out.columns == d.columns, name
            out.collect()
        assert corpus_pipeline.STAGES[4][1](spark, some, str(tmp_path)).count() == some.count()
