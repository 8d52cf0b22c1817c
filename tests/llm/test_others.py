import math
import random
import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

import duckdb
import numpy as np
import pytest

from quernflow.llm import decontam, html, licenses, quality, tokens, warc
from quernflow.scratch import fresh_path


# ---------------------------------------------------------------- quality


def test_statistics_by_hand():
    text = "a b c a b c\nx # y\nx # y\n\n  \nlast one."
    n, chars, symbols, dup, rep, *x = quality.statistics(text.encode())
    words = text.split()
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    assert (n, chars, symbols, dup, rep) == (14, sum(map(len, words)), 2, 1, len(covered))
    assert quality.statistics(None)[:5] == (0, 0, 0, 0, 0) and quality.statistics(b" ## ")[2] == 2


def test_chi2():
    assert abs(quality.chi2_cdf(quality.chi2_quantile(0.975, 5), 5) - 0.975) < 1e-9
    assert abs(quality.chi2_quantile(0.95, 1) - 3.841459) < 1e-4


def test_base_columns_against_sql(make_docs, sf, edge_docs):
    odd = [(50, "a b c a b c\nx # y\nx # y\n\n  \nlast one.", "en", "s"), (51, "a a a a a\n\x0b\na\x85b c\u2028d", "en", "s"), (52, "é É ß\t😀 &<>", None, None)]
    for docs in (make_docs(odd).unionByName(edge_docs), make_docs([]).sparkSession.read.parquet(f"{sf}/documents.parquet")):
        got = [tuple(r) for r in quality.assess(docs).drop("distance", "kept").collect()]
        con = duckdb.connect()
        con.register("documents", docs.select("doc_id", "text").toArrow())
        want = con.sql(quality.BASE_ORACLE).fetchall()
        assert sorted(map(repr, got)) == sorted(map(repr, want))


def vectors(spark, groups, noise=1e-4):
    """Rows (grp, x0.., noise) for fit_groups."""
    import pandas as pd

    rows = [(g, *np.round(v * quality.GRID).astype(int).tolist(), [noise] * len(v)) for g, x in groups.items() for v in x]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["grp", *(f"x{i}" for i in range(len(quality.DIMS))), "noise"]))


def fits(spark, groups):
    p = len(quality.DIMS)
    return {r["grp"]: (np.array(r["centre"]), np.array(r["scatter"]).reshape(p, p)) for r in quality.fit_groups(vectors(spark, groups)).collect()}


def away(x, centre, scatter, noise=1e-4):
    return quality.distances(np.atleast_2d(x), np.full(np.atleast_2d(x).shape, noise), centre, scatter)


def brute_determinant(x, share=quality.SHARE):
    """The least determinant that 300 random starts and steps to the end reach, with whole rows."""
    rng, h, best = np.random.default_rng(9), math.ceil(share * len(x)), np.inf
    for _ in range(300):
        mine = rng.choice(len(x), x.shape[1] + 1, replace=False)
        for _ in range(30):
            m, c = x[mine].mean(axis=0), np.cov(x[mine].T, bias=True) + quality.GUARD
            mine = np.argsort(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m), kind="stable")[:h]
        best = min(best, np.linalg.slogdet(np.cov(x[mine].T, bias=True) + quality.GUARD)[1])
    return best


def mixed_group(rng, n, centre):
    """Correlated rows, a fifth of them a dense cluster far away."""
    p = len(quality.DIMS)
    root = np.eye(p) * 0.1
    root[4, 5], root[5, 5] = 0.1, 0.01  # the fifth and sixth statistic rise together
    good = rng.normal(size=(n - n // 5, p)) @ root + centre
    return np.concatenate([good, rng.normal(size=(n // 5, p)) * 0.01 + centre + 0.8])


def test_estimates_reach_the_least_determinant_and_see_through_a_cluster(spark):
    rng = np.random.default_rng(2)
    groups = {"a": mixed_group(rng, 500, 0.5), "b": mixed_group(rng, 3000, 2.0)}  # the second is larger than its sample
    found = fits(spark, groups)
    for name, x in groups.items():
        centre, scatter = found[name]
        n = len(x)
        good, cluster = x[: n - n // 5], x[n - n // 5 :]
        assert np.allclose(centre, good.mean(axis=0), atol=0.02)
        assert np.allclose(scatter, np.cov(good.T), atol=0.003)
        assert (away(cluster, centre, scatter) > quality.CUT).all() and (away(good, centre, scatter) <= quality.CUT).all()
        assert (away(cluster, x.mean(axis=0), np.cov(x.T)) <= quality.CUT).all()  # a plain estimate is drawn to the cluster
        again = quality.start_fits(__import__("pandas").DataFrame(np.c_[np.round(x * quality.GRID), np.ones(n)], columns=[*(f"x{i}" for i in range(x.shape[1])), "n"]).assign(grp=name))
        raw = (np.array(again["scatter"][0]).reshape(scatter.shape) - quality.GUARD) / quality.consistent(quality.SHARE)
        if n <= 500:
            assert np.linalg.slogdet(raw + quality.GUARD)[1] <= brute_determinant(np.round(x * quality.GRID) / quality.GRID) + 0.02


def test_an_outlier_against_the_correlation_and_one_of_another_group(spark):
    rng = np.random.default_rng(4)
    groups = {"a": mixed_group(rng, 400, 0.5), "b": mixed_group(rng, 400, 1.0)}
    found = fits(spark, groups)
    centre, scatter = found["a"]
    odd = centre.copy()
    odd[4] += 0.15
    odd[5] -= 0.15  # within each statistic's own spread
    assert away(odd, centre, scatter)[0] > quality.CUT > away(odd, centre, np.diag(np.diag(scatter)))[0]
    own, other = away(found["b"][0], *found["b"]), away(found["b"][0], centre, scatter)
    assert own[0] < 1 and other[0] > quality.CUT  # constants for all groups would change the verdict
    assert away(odd, centre, scatter, noise=0.05)[0] < quality.CUT  # a text of few words proves little


def test_steps_over_bins_are_those_over_rows():
    rng = np.random.default_rng(6)
    x = np.round(mixed_group(rng, 300, 0.5) * quality.GRID)
    near = quality._nearest(x / quality.GRID, np.ones(300), x.mean(axis=0) / quality.GRID, np.cov(x.T) / quality.GRID**2)
    assert near.sum() == quality.SHARE * 300
    centre, scatter = quality._moments(x / quality.GRID, near)
    import pandas as pd

    p = x.shape[1]
    sums = {"grp": "a", "start": 0, "bin": np.where(near > 0, 0, 1), "n": 1, **{f"s{i}": x[:, i] for i in range(p)}, **{f"s{i}_{j}": x[:, i] * x[:, j] for i, j in quality._PAIRS}}
    fit = quality.next_fit(pd.DataFrame(sums).groupby(["grp", "start", "bin"], as_index=False).sum())
    assert np.allclose(fit["centre"][0], centre)
    assert np.allclose(np.array(fit["scatter"][0]).reshape(p, p), quality.consistent(quality.SHARE) * scatter + quality.GUARD)


def test_verdicts(make_docs):
    rng = random.Random(1)
    text = lambda odd: " ".join(("#$%" if odd and rng.random() < 0.7 else "") + "w" * rng.randint(2, 8) + ("." if rng.random() < 0.1 else "") + str(rng.randrange(9999)) for _ in range(80))
    rows = [(i, text(i % 17 == 0), "en", "a") for i in range(300)] + [(1000 + i, text(False), "fr", f"s{i}") for i in range(20)]
    rows += [(2000, "too short", "en", "a"), (2001, "again and again " * 50, "en", "a")]
    got = {r["doc_id"]: r for r in quality.assess(make_docs(rows)).collect()}
    assert all(got[i]["kept"] == (i % 17 != 0) == (got[i]["distance"] <= quality.CUT) for i in range(300))
    assert all(got[1000 + i]["kept"] and got[1000 + i]["distance"] is None for i in range(20))
    assert got[2000]["base_failed"] and got[2001]["base_failed"] and not got[2001]["kept"]
    kept = quality.filter_kept(make_docs(rows))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]} and "cell" in kept.columns


def test_quality_edge_cases(edge_docs, empty_docs):
    rows = quality.assess(edge_docs).collect()
    assert len(rows) == 9 and [r["n_words"] for r in rows if r["doc_id"] in (1, 2, 3)] == [0, 0, 0] and quality.assess(empty_docs).count() == 0


# ---------------------------------------------------------------- decontamination


def edits(a, b):
    best = list(range(len(b) + 1))
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row), best and None


def test_all_occurrences_within_budget_are_found():
    rng = random.Random(9)
    make = lambda n: "".join(rng.choice("abcde ") for _ in range(n))
    items = [(i, decontam.normal(make(rng.choice([12, 60, 150])))) for i in range(12)]
    index = decontam.Index(items)
    texts = []
    for k in range(60):
        item = list(items[k % 12][1])
        for _ in range(rng.randint(0, len(item) // 8)):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], ["x"], [item[at], "y"]])
        texts.append(decontam.normal(make(80) + " " + "".join(item) + " " + make(80)))
    got = {(n, i): e for n, i, e, _, _ in decontam.matches(texts, index)}
    for n, text in enumerate(texts):
        for item_id, pattern, budget in index.items:
            least = edits(pattern, text)[0]
            assert ((n, item_id) in got) == (least <= budget), (n, item_id, least, budget)
            if (n, item_id) in got:
                assert got[n, item_id] == least


def test_hits_in_slices_and_short_items(monkeypatch):
    rng = random.Random(14)
    make = lambda n: "".join(rng.choice("ab ") for _ in range(n))
    index = decontam.Index([(i, make(rng.choice([20, 90]))) for i in range(20)] + [(90, " ab\n"), (91, "zz"), (92, " ")])
    texts = [decontam.normal(make(4000) + index.items[i][1]) for i in range(8)] + ["", "b"]
    want = sorted(decontam.matches(texts, index))
    monkeypatch.setattr(decontam, "_ROWS", 50)
    assert sorted(decontam.matches(texts, index)) == want
    assert {(n, i) for n, i, *_ in want if i >= 90} == {(n, 90) for n in range(8)}


def test_leaks_in_tables(spark, make_docs, edge_docs, empty_docs):
    passage = "what is the capital of the country that lies to the north of here and why"
    bench = spark.createDataFrame([(1, passage), (2, None), (3, ""), (4, "tiny"), (None, passage)], "item_id long, text string")
    docs = make_docs([(1, "before " + passage.upper() + " after", "en", "s"), (2, "clean text", "en", "s"), (3, None, None, None), (None, passage, "en", "s"), (1, "before " + passage.upper() + " after", "en", "s")])
    assert [(r["doc_id"], r["item_id"], r["edits"], r["start"], r["length"]) for r in decontam.find_leaks(docs, bench).orderBy("doc_id").collect()] == [(None, 1, 0, 0, 73), (1, 1, 0, 7, 73)]
    assert [r["doc_id"] for r in decontam.drop_leaks(docs, bench).orderBy("doc_id").collect()] == [2, 3]
    assert decontam.find_leaks(docs, bench, block_chars=10).count() == 2
    assert decontam.find_leaks(empty_docs, bench).count() == 0 and decontam.drop_leaks(edge_docs, bench.limit(0)).count() == 9


def test_short_items_have_their_whole_budget():
    rng = random.Random(23)
    make = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    items = [(n, make(n)) for n in range(3, 60)]
    for most in (0.1, 0.25):
        index = decontam.Index(items, max_error=most)
        assert {i: k for i, _, k in index.items} == {n: int(most * n) for n, _ in items if n >= 8 or int(most * n)}
        texts = []
        for _, text in items:
            item = list(text)
            for _ in range(int(most * len(text)) + rng.randint(0, 1)):
                at = rng.randrange(len(item))
                item[at : at + 1] = rng.choice([[], ["x"], [item[at], "y"]])
            texts.append(make(30) + "".join(item) + make(30))
        got = {(n, i): e for n, i, e, _, _ in decontam.matches(texts, index)}
        want = {(n, i): edits(item, text)[0] for n, text in enumerate(texts) for i, item in items}
        assert got == {(n, i): e for (n, i), e in want.items() if e <= int(most * i)}
        assert sum(e > 0 for (_, i), e in got.items() if i < 40) > 10


def test_items_without_an_id(spark, make_docs):
    passage = "a question that nobody gave a number but that is a question all the same"
    docs = make_docs([(1, "before " + passage + " after", "en", "s"), (2, "clean text", "en", "s")])
    bench = spark.createDataFrame([(None, passage), (None, None), (None, " ")], "item_id long, text string")
    assert decontam.find_leaks(docs, bench).count() == 0
    assert [(r["doc_id"], r["item_id"], r["edits"], r["start"]) for r in decontam.find_leaks(docs, bench, unnamed=True).collect()] == [(1, None, 0, 7)]
    assert [r["doc_id"] for r in decontam.drop_leaks(docs, bench).collect()] == [2]


# ---------------------------------------------------------------- HTML

PAGES = [
    ('<body><nav>Home</nav><div class="cookie-notice">We use</div><article><header>By me</header><h1>A &amp; B</h1><p>one <a href=x>two</a></p><div class="ad">buy</div><p>three&nbsp;four<br>five</p><form><input><label>x</label></form><section class="comments"><p>long comment text here is a long one</p></section></article><aside>side</aside><footer>f</footer>', "A & B one two three four five"),
    ('<div id="menu"><a>1</a><a>2</a></div><div class="content">Text here that is long<br>and more text</div><div class=sidebar><p>para in side</p></div>', "Text here that is long and more text"),
    ("", ""), (None, ""), ("<p>x", "x"), ("<article>T</article>", "T"), ('<script>var a="<p>"</script><p>a<b>b</b>c</p><p>wor<i>d</i></p><!-- <p>no</p> --><p', "abc word"),
    ("no tags at all & <3", "no tags at all & <3"), ("<article><h1>Hi</h1><ul><li>a</li><li>b c</li></ul><table><tr><td>x<td>y</table><p>See <a href=1>link</a></p></article><div class=related><p>More</p></div>", "Hi a b c x y See link"),
    ("<nav><a>never closed<article><p>Body text</p></article>", "Body text"), ("<title>t</title><style>p{}</style>", ""),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_best_run_is_the_largest_sum():
    rng = random.Random(6)
    for _ in range(200):
        scores = [rng.choice([-2.0, -1.0, 1.0, 1.5]) for _ in range(rng.randint(0, 12))]
        a, b = html.best_run(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert sum(scores[a:b]) == max([0.0, *sums])


MARK = re.compile(r"\[\[|\]\]|\{\{|\}\}")


def marked_text(page):
    """The text between the marks of a labelled page, by the marks alone."""
    inside = re.sub(r"\{\{.*?\}\}", " ", page[page.index("[[") + 2 : page.index("]]")], flags=re.S)
    inside = re.sub(rf"</?({'|'.join(html.INLINE)})( [^>]*)?>", "", inside)
    return " ".join(unescape(re.sub(r"<[^>]*>", " ", inside)).split())


def test_labelled_pages_are_recovered_and_held_out_ones_mostly():
    def alike(a, b):
        a, b = Counter(a.split()), Counter(b.split())
        return 2 * sum((a & b).values()) / max(1, sum(a.values()) + sum(b.values()))

    pages = html.labelled_pages()
    words = [html.labelled_words(p) for p in pages]
    seen = [alike(html.main_text(MARK.sub("", p)), marked_text(p)) for p in pages]
    assert sum(seen) / len(pages) > 0.97
    held_out = [alike(html.main_text(MARK.sub("", p), html.fit(words[:i] + words[i + 1 :])), marked_text(p)) for i, p in enumerate(pages)]
    assert sum(held_out) / len(pages) > 0.75


class Reader(HTMLParser):
    """The text of the one article element, by the parser of the standard library: an extractor of its own."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        if self.depth and tag not in html.INLINE:
            self.out.append(" ")

    def handle_endtag(self, tag):
        self.depth -= tag == "article"

    def handle_data(self, data):
        if self.depth:
            self.out.append(data)

    def text(self):
        return " ".join("".join(self.out).split())


@pytest.fixture(scope="module")
def table(sf):
    pages = [p for (p,) in duckdb.sql(f"select html from '{sf}/pages.parquet' where html is not null order by page_id").fetchall()]
    return pages, [Reader(p).text() for p in pages]


def test_scan_finds_the_article_with_and_without_its_element(table):
    pages, want = table
    weights = html.learn(pages[:50])
    assert [html.main_text(p, weights) for p in pages] == want
    soup = [re.sub(r"<(/?)article>", r"<\1div>", p) for p in pages]
    assert [html.main_text(p, weights) for p in soup] == want
    bare = [re.sub(r"<(/?)(article|nav|footer)>", r"<\1div>", p).replace(' class="ad"', "") for p in pages]
    assert [html.main_text(p, weights) for p in bare] == want
    whole = lambda scores: (0, len(scores))
    assert not any(html.main_text(p, weights, whole) == t for p, t in zip(bare, want, strict=True))  # the scan decides


def test_adverts_and_comments_inside_an_article(table):
    pages, want = table
    weights = html.learn(pages[:50])
    for p, t in list(zip(pages, want, strict=True))[50:150]:
        odd = p.replace("</h1>", '</h1><div class="ad">Buy two and get a third one free of charge today</div>', 1)
        odd = odd.replace("</article>", '<section class="comments"><p>So true, I said the same to my brother last week.</p></section></article>')
        odd = odd.replace("<footer>", '<aside class="sidebar"><p>Read on here about all of this</p></aside><footer>')
        assert html.main_text(odd, weights) == t


def test_deep_and_unclosed_pages_take_linear_time():
    import time

    began = time.perf_counter()
    assert html.main_text("<div>" * 60_000 + "<p>deep text here</p>" + "</i></div>" * 60_000) == "deep text here"
    assert html.main_text("<b><i class=x>" * 60_000 + "</u>" * 60_000 + "<p>" + "word " * 200_000).count("word") == 200_000
    assert time.perf_counter() - began < 20


def test_extraction_of_rows(spark):
    rows = [(i, None if i % 2 else "u", p) for i, (p, _) in enumerate(PAGES)] + [(None, None, "<p>x")]
    got = html.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    wide = spark.createDataFrame([(1, "u", "<p>x y", "kept out", 3, "<p>z")], "page_id long, url string, html string, text string, n_chars int, kind string")
    assert [tuple(r) for r in html.extract_main_text(wide).collect()] == [(1, "u", "x y", 3)]
    assert html.extract_main_text(wide.limit(0)).count() == 0


# ---------------------------------------------------------------- archives


def test_round_trip_and_revisits(spark, sf):
    big = "é" * 600
    rows = [(1, "http://a/ b\n", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", big), (2, None, big), (6, "u", "x" * 999), (7, "u", "x" * 999)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((repr(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_archives(warc.write_archives(pages, package=500)).collect())
    want = sorted([("1", 1200, "revisit", 2), ("2", 1200, "response", None), ("2", 1200, "response", None), ("3", 5, "response", None), ("4", 5, "response", None), ("5", 0, "response", None), ("None", 1200, "revisit", 2), ("6", 999, "response", None), ("7", 999, "response", None)])
    assert got == want
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0
    con = duckdb.connect()
    con.sql(f"create view pages as select * from read_parquet('{sf}/pages.parquet')")
    df = warc.op8_warc(spark, sf)
    order = sorted(df.columns)
    assert sorted(map(repr, con.sql(f"select {', '.join(order)} from ({warc.ORACLE})").fetchall())) == sorted(repr(tuple(r[c] for c in order)) for r in df.collect())


def test_zip64_directories_and_damage(tmp_path):
    import struct

    package = warc.Package(str(tmp_path))
    package.add({"page_id": 1, "url": "u", "html": b"hello", "payload_digest": "aaf4c61ddcc5e8a2dabede0f3b482cd9aea9434d", "refers_to": None})
    path = package.close()
    assert [r["page_id"] for r in warc.read_package(path, read=1)] == [1]
    data = bytearray(open(path, "rb").read())
    end = data.rfind(b"PK\x05\x06")
    count, size, start = struct.unpack_from("<HII", data, end + 10)
    record = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, size, start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1)
    tail = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    wide = tmp_path / "wide.wacz"
    wide.write_bytes(bytes(data[:end]) + record + locator + tail)
    assert [r["page_id"] for r in warc.read_package(str(wide))] == [1]
    assert warc._zip64(struct.pack("<HHQQ", 1, 16, 5_000_000_000, 7), 0xFFFFFFFF, 3, 0xFFFFFFFF) == [5_000_000_000, 3, 7]
    (tmp_path / "bad.wacz").write_bytes(b"nothing")
    with pytest.raises(ValueError, match="central directory"):
        list(warc.read_package(str(tmp_path / "bad.wacz")))


# ---------------------------------------------------------------- licences


def test_license_scan_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c.py", "x = 1"), (3, "a/b/LICENSE.txt", "Licensed under the Apache License, Version 2.0."), (4, "a/b/d/e.py", "many words of code and text here and there\n# SPDX-License-Identifier: GPL-3.0-or-later\ncode"),
        (5, "q/e.py", None), (6, None, "Some text. Licensed under CC BY-NC 4.0. And more words follow after that"), (None, "a/b/z", ""), (7, "top.txt", "nothing of this kind"), (8, "a/x/y/z.c", "the license of software is public"), (8, "a/x/y/z.c", "the license of software is public"),
    ]
    got = sorted((repr(r["id"]), r["license"], r["basis"], r["found_in"]) for r in licenses.scan(spark.createDataFrame(rows, "id int, path string, text string"), "id", "path").collect())
    want = [("1", "MIT", "file", None), ("2", "Apache-2.0", "inherited", "a/b/LICENSE.txt"), ("3", "Apache-2.0", "file", None), ("4", "GPL-3.0", "header", None), ("5", None, None, None), ("6", "CC-BY-NC-4.0", "header", None), ("7", None, None, None), ("8", "MIT", "inherited", "a/LICENSE"), ("8", "MIT", "inherited", "a/LICENSE"), ("None", "Apache-2.0", "inherited", "a/b/LICENSE.txt")]
    assert got == sorted(want, key=repr) or sorted(got, key=repr) == sorted(want, key=repr)
    assert licenses.scan(spark.createDataFrame([], "id int, path string, text string"), "id", "path").count() == 0


def test_licence_bodies_and_standard_headers(spark):
    texts = dict((n, [t for m, t in licenses.TEXTS if m == n]) for n, _ in licenses.TEXTS)
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + texts["MIT"][0].replace("software and", "software\nand") + "\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND."
    bsd = "Copyright 2020\n\n" + texts["BSD-3-Clause"][0].replace(" 2. ", "\n\n2. ").replace(" 3. ", "\n\n3. ") + "\n\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"
    gpl = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\n Copyright (C) 1989 Free Software Foundation\n"
    apache = "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n"
    head = "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 3 of the License, or\n * (at your option) any later version.\n */\nint main() { return 0; }\n" + "x = 1;\n" * 80
    rows = [(1, "m/LICENSE", mit), (2, "m/a/x.c", "int x;"), (3, "b/COPYING", bsd), (4, "b/y.c", "int y;"), (5, "g/COPYING", gpl), (6, "g/z.c", "int z;"), (7, "a/LICENSE", apache), (8, "a/w.c", "int w;"), (9, "h/v.c", head), (10, "h/u.c", "int u;")]
    got = {r["id"]: (r["license"], r["basis"]) for r in licenses.scan(spark.createDataFrame(rows, "id int, path string, text string"), "id", "path").collect()}
    want = {}
    for at, name in ((1, "MIT"), (3, "BSD-3-Clause"), (5, "GPL-2.0"), (7, "Apache-2.0")):
        want |= {at: (name, "file"), at + 1: (name, "inherited")}
    assert got == want | {9: ("GPL-3.0", "header"), 10: (None, None)}


def test_notices_wrapped_over_lines(spark):
    notices = [("Apache-2.0", "Licensed under the Apache", "License, Version 2.0."), ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0", "International License."), ("GPL-2.0", "This work is licensed under the GNU General Public", "License, version 2.")]
    rows = [(i, f"d{i}/x.c", f"Some words ahead of it.\n{mark}{a}\n{mark}{b}\nint x = 1;\n" + "y = x + 1;\n" * 40) for i, (mark, (_, a, b)) in enumerate((m, n) for m in ("", "// ", " * ") for n in notices)]
    got = {r["id"]: r["license"] for r in licenses.scan(spark.createDataFrame(rows, "id int, path string, text string"), "id", "path").collect()}
    assert got == {i: notices[i % 3][0] for i in range(9)}


def test_what_reaches_the_least_cosine_has_a_set_of_terms():
    rng = random.Random(10)
    for templates in (licenses.TEMPLATES, licenses.TEXTS):
        rows, _, _, sets = licenses._model(templates, licenses.LEAST)
        vectors = {}
        for i, _, t, w in rows:
            vectors.setdefault(i, {})[t] = w
        for v in vectors.values():
            for _ in range(2000):
                some = {t for t in v if rng.random() < rng.choice([0.2, 0.5, 0.8])}
                assert sum(v[t] ** 2 for t in some) < licenses.LEAST**2 or any(some >= set(x) for x in sets)


def test_cosines_against_brute_force(spark):
    rng = random.Random(8)
    rows, idf, unknown, _ = licenses._model(licenses.TEMPLATES, licenses.LEAST)
    vectors = {}
    for i, name, t, w in rows:
        vectors.setdefault((i, name), {})[t] = w
    terms = sorted(idf)
    units = {" ".join(w for w in rng.choice(licenses.TEMPLATES)[1].split() + ["other"] * rng.randint(0, 2) if rng.random() < 0.85) for _ in range(150)}
    units |= {" ".join(rng.choice(terms) for _ in range(rng.randint(1, 4))) for _ in range(300)} | {"under the MIT", "the under", "", "x" * 100_000}
    want = {}
    for unit in units:
        weight = {t: c * idf.get(t, unknown) for t, c in Counter(re.findall(licenses.TERM, unit.lower())).items()}
        norm = math.sqrt(sum(w * w for w in weight.values())) or 1
        scores = [(round(sum(w * v.get(t, 0) for t, w in weight.items()) / norm, 6), -i, name) for (i, name), v in vectors.items()]
        if max(scores)[0] >= licenses.LEAST:
            want[unit] = (max(scores)[2], max(scores)[0])
    assert want["under the MIT"][0] == "MIT"
    frame = spark.createDataFrame([(u,) for u in units], "unit string")
    got = {r["unit"]: (r["license"], r["similarity"]) for r in licenses.license_of_units(spark, frame).collect()}
    assert got.keys() == want.keys() and all(got[u][0] == want[u][0] and abs(got[u][1] - want[u][1]) < 2e-6 for u in want)
    from pyspark.sql import functions as F

    unit = F.lower("unit")
    passed = frame.where(licenses._told(unit, licenses.TEMPLATES, licenses.LEAST) & licenses._may_reach(unit, licenses.TEMPLATES, licenses.LEAST))
    assert {r["unit"] for r in passed.collect()} >= want.keys()


def test_table_of_all_kinds_of_statements_against_sql(spark):
    body = dict((n, t) for n, t in licenses.TEXTS)
    texts = [
        None, "", "some words\nunder the MIT\nmore words here", "Er kam mit dem Zug.", "a line. Licensed under the Apache License, Version 2.0. and on", "Licensed under the Apache\nLicense, Version 2.0.",
        "// This work is licensed under the GNU General Public\n// License, version 2.\nint x;", "head\n\n" + body["MIT"].replace(" the Software", "\nthe Software") + "\n\ntail of it", "/*\n * " + body["GPL-3.0"] + "\n */", body["BSD-3-Clause"].replace(". ", ".\n# "),
        "SPDX-License-Identifier: MIT", "the under of", "word " * 5000 + "\nReleased under the ISC License.", "Mozilla Public License Version 2.0", "Released under the MIT License.\nReleased under the ISC License.",
    ]
    rows = [(i, t, "en" if i % 3 else "de", f"s{i % 4}") for i, t in enumerate(texts)]
    con = duckdb.connect()
    con.register("documents", spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").toArrow())
    want = con.sql(f"select doc_id, path, license, basis, similarity, found_in from ({licenses.oracle()})").fetchall()
    docs = spark.createDataFrame([(*r, "clash", 1.0, "u") for r in rows], "doc_id long, text string, lang string, source string, license string, similarity double, unit string")
    from pyspark.sql import functions as F

    place = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    got = licenses.scan(docs.withColumn("path", place), "doc_id", "path").select("doc_id", "path", "license", "basis", "similarity", "found_in").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    found = {r[0]: r[2] for r in want if r[3] != "inherited"}
    assert [found.get(i) for i in (2, 4, 5, 6, 7, 8, 9, 10, 12, 13)] == ["MIT", "Apache-2.0", "Apache-2.0", "GPL-2.0", "MIT", "GPL-3.0", "BSD-3-Clause", "MIT", "ISC", "MPL-2.0"]


# ---------------------------------------------------------------- token counts


def test_rollup_follows_changes(spark, make_docs):
    import os

    if not os.path.exists(tokens.VOCABULARY):
        pytest.skip("no vocabulary here")
    tokenizer, rollup = tokens.Tokenizer(spark), tokens.Rollup(spark, fresh_path(spark, "rollup"))
    change = lambda rows: spark.createDataFrame(rows, "op string, doc_id long, source string, lang string, text string")
    totals = lambda: {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in rollup.totals().collect()}
    assert totals() == {}
    assert rollup.apply(1, change([("insert", 1, "a", "en", "hello world"), ("insert", 2, "a", "en", None), ("insert", 3, None, None, "hello"), ("insert", None, "a", "en", "lost")]), tokenizer)
    assert totals() == {("a", "en"): (2, 2), (None, None): (1, 1)}
    assert not rollup.apply(1, change([("insert", 9, "a", "en", "again")]), tokenizer)
    assert rollup.apply(2, change([("insert", 1, "b", "en", "hello hello hello"), ("delete", 2, None, None, None), ("delete", 77, "a", "en", None), ("insert", 3, None, None, "hello hello"), ("delete", 3, None, None, None)]), tokenizer)
    assert totals() == {("b", "en"): (1, 3), (None, None): (1, 2)}
    assert rollup.apply(3, change([("delete", 1, None, None, None)]), tokenizer) and totals() == {(None, None): (1, 2)}
    assert rollup.apply(4, change([]), tokenizer) and totals() == {(None, None): (1, 2)}


def test_whole_table_is_counted(spark, sf):
    import os

    if not os.path.exists(tokens.VOCABULARY):
        pytest.skip("no vocabulary here")
    encode = tokens._encoding(open(tokens.VOCABULARY, "rb").read(), tokens.PATTERN).encode_ordinary
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = tokens.op10_token_counts(spark, sf).collect()
    assert sum(r["docs"] for r in got) == len(docs) and sum(r["tokens"] for r in got) == sum(len(encode(d["text"])) for d in docs)


def test_rows_without_or_with_repeated_ids_are_counted_by_group(spark, make_docs, tmp_path):
    import os

    if not os.path.exists(tokens.VOCABULARY):
        pytest.skip("no vocabulary here")
    encode = tokens._encoding(open(tokens.VOCABULARY, "rb").read(), tokens.PATTERN).encode_ordinary
    rows = [(1, "one two", "en", "a"), (1, "one two", "en", "a"), (1, "three", "de", "a"), (None, "four", None, "a"), (None, None, "en", None), (2, "", "en", "b"), (3, "five " * 9000, "en", "b")]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1), (3, 1), (None, 1), (2, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    want = {}
    for _, text, lang, source in rows:
        docs, count = want.get((source, lang), (0, 0))
        want[source, lang] = docs + 1, count + len(encode(text or ""))
    got = tokens.op10_token_counts(spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"]): (r["docs"], r["tokens"]) for r in got} == want


# ---------------------------------------------------------------- pipeline


def test_pipeline_keeps_columns_and_counts(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
    assert len(corpus_pipeline.STAGES) == 5
