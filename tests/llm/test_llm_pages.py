"""Operators on pages."""

import base64
import hashlib
import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from climastar.llm import html_extract, url_filter, warc
from climastar.session import new_run_dir

PAGES = "/root/testdata/sf0.01/pages.parquet"


# --- URL filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]


def test_rules_and_list(spark):
    urls = ["http://a.com/x", "HTTP://Example.COM/en/", "https://sub.example.com/en/q?z#f", "http://www.example.com/en/q", "http://x.www.example.com/en/",
            "http://notexample.com/en/", "http://a.com", "a.com/x", None, "", "ftp://listed.org/p/?q", "http://www.listed.org/p", "http://other.org/p", "http://com/",
            "x://y://a.com/", "http://a.com:80/x"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(0, urls[0])]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({"host": F.lit(1), "verdict": F.lit(2), "key": F.lit(3)})
    listed = spark.createDataFrame([("listed.org/p",), ("listed.org/p",), (None,), ("unseen.org/",)], "url string")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.url_filter(df, listed, RULES).orderBy("page_id").collect()]
    assert got == [
        (0, "a.com", "/x", "com/", "allow"), (0, "a.com", "/x", "com/", "allow"), (1, "example.com", "/en/", "example.com/en/", "block"),
        (2, "sub.example.com", "/en/q", "example.com/en/", "block"), (3, "www.example.com", "/en/q", "www.example.com/en/", "allow"),
        (4, "x.www.example.com", "/en/", "www.example.com/en/", "allow"), (5, "notexample.com", "/en/", "com/", "allow"),
        (6, "a.com", "", None, "allow"), (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "", "", None, "allow"),
        (10, "listed.org", "/p/", None, "block"), (11, "www.listed.org", "/p", None, "block"), (12, "other.org", "/p", None, "allow"),
        (13, "com", "/", "com/", "allow"), (14, "y:", "//a.com/", None, "allow"), (15, "a.com:80", "/x", None, "allow")]


@pytest.mark.parametrize("blocks", [1, 16])
def test_filter_passes_all_and_join_decides(spark, blocks, monkeypatch):
    """A filter that is far too small lets much through; the result is the same."""
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", blocks)
    pages = spark.createDataFrame([(i, f"http://h{i % 70}.org/p{i}") for i in range(1500)], "page_id long, url string")
    listed = spark.createDataFrame([(f"h{i % 70}.org/p{i}",) for i in range(0, 1500, 3)], "url string")
    got = {r.page_id: r.verdict for r in url_filter.url_filter(pages, listed, []).collect()}
    assert got == {i: "block" if i % 3 == 0 else "allow" for i in range(1500)}
    keys = listed.withColumnRenamed("url", "key")
    bloom = url_filter.bloom_filter(keys, blocks)
    assert bloom.count() <= blocks
    assert url_filter.may_contain(keys, "key", bloom, blocks, "hit").where("not hit").count() == 0


def test_heavy_urls_are_dealt_by_their_count(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "HEAVY", 4)
    urls = ["http://hot.org/p"] * 600 + [f"http://h{i}.org/" for i in range(200)] + ["http://warm.org/q?x"] * 150
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("hot.org/p",), ("h7.org",), ("hot.org/p",)], "url string")
    got = {r.page_id: (r.verdict, r.listed) for r in url_filter.url_filter(pages, listed, []).collect()}
    assert got == {i: ("block", True) if u in ("http://hot.org/p", "http://h7.org/") else ("allow", False) for i, u in enumerate(urls)}


def test_url_filter_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.url_filter(none, none, RULES).count() == 0


# --- HTML extraction

def article(page):
    """Main text of the given pages, by their article element."""
    body = page[page.index("<article>") + 9:].split("</article>")[0]
    blocks = re.split(r"</?(?:p|h1)>", body)
    return "\n\n".join(b for b in (" ".join(html.unescape(re.sub("</?b>", "", re.sub("<br>", " ", x))).split()) for x in blocks) if b)


@pytest.fixture(scope="module")
def model(spark):
    """Fitted on half of the pages."""
    return html_extract.train(spark.read.parquet(PAGES).where("page_id % 2 = 0"))


def test_pages_give_their_article(spark, model):
    """Those that the model was not fitted on, too."""
    pages = spark.read.parquet(PAGES).withColumns({"x": F.lit(1), "o": F.lit(2)})
    got = html_extract.extract(pages, model=model).collect()
    assert len(got) == 250 and sum(r.text == article(r.html) for r in got) >= 248
    assert sum(r.text == article(r.html) for r in got if r.page_id % 2) >= 123


def test_extract_replaces_a_column_of_its_name(spark, model):
    pages = spark.read.parquet(PAGES).limit(5).select(F.lit("mine").alias("text"), "*", F.lit("p").alias("page"), F.lit("h").alias("__html"), F.lit(1).alias("a b"))
    got = html_extract.extract(pages, model=model)
    assert got.columns == ["page_id", "url", "html", "page", "__html", "a b", "text"]
    rows = got.collect()
    assert all(r.text != "mine" and r.text == article(r.html) and (r.page, r["__html"], r["a b"]) == ("p", "h", 1) for r in rows) and len(rows) == 5


def test_training_pages_are_limited_in_spark(spark):
    """A page id with very many equal rows counts once."""
    pages = spark.read.parquet(PAGES)
    many = pages.where("page_id < 20").union(pages.where("page_id = 1").crossJoin(spark.range(400)).select(*pages.columns))
    assert html_extract.train(many, how_many=15) is not None


def test_other_layouts(spark, model):
    """Layouts of pages that the model has not seen keep the marked text and no other."""
    rng = random.Random(77)
    n = same = 0
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(60).collect():
        for page in html_extract.layouts(html_extract.parse(r.html), rng, 2):
            t = html_extract.parse(page)
            y, keep = html_extract.labels(t), html_extract.decode(t, model.log_odds(html_extract.features(t)))
            n += 1
            same += all(bool(y[node]) == bool(keep[node]) for node, _, _ in t.runs)
    assert same >= 0.85 * n


def test_extract_edges(spark, model):
    body = "".join(f"<p>Of words that stand in a long paragraph number {i}, as articles do, there are many here.</p>" for i in range(6))
    rows = [(1, None), (2, ""), (3, "no markup at all"), (4, "<p"), (5, "<!-- never closed <p>x</p>"), (6, "<script>var a='<p>x</p>'"),
            (7, f"<html><body><nav><a href=/>Home</a></nav><article><h1>T&eacute;st&nbsp;&amp; more</h1>{body}<table><tr><td>a<td>b</table></article>"
                "<div id=comments><p>I like it</p></div></body></html>"), (7, None), (8, "<div>" * 3000 + "deep" + "</div>" * 3000),
            (9, "<a \"'<b>" * 500)]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text_", F.lit("clash"))
    got = html_extract.extract(df, model=model).collect()
    assert len(got) == len(rows) and all(r.text is not None for r in got)
    by = {(r.page_id, r.html is None): r.text for r in got}
    assert by[1, True] == by[2, False] == by[7, True] == ""
    assert by[7, False].startswith("Tést & more\n\nOf words") and "Home" not in by[7, False] and "like" not in by[7, False]
    assert by[7, False].count("\n\n") == 8 and "x" not in by[6, False]
    assert html_extract.extract(df.limit(0)).count() == 0
    assert {r.text for r in html_extract.extract(df.where("page_id < 7")).collect()} == {""}     # nothing to learn from


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n = 9
        t = html_extract.Tree(tag=["x"] * n, parent=[-1, *(int(rng.integers(0, i)) for i in range(1, n))])
        s = rng.normal(size=n)
        keep = html_extract.decode(t, s)
        best = max((sum(s[i] for i in range(1, n) if m >> i & 1) for m in range(1, 1 << n, 2)
                    if all(not m >> i & 1 or m >> t.parent[i] & 1 for i in range(1, n))))
        assert all(not keep[i] or keep[t.parent[i]] for i in range(1, n)) and np.isclose(s[1:][keep[1:]].sum(), best)


# --- WARC

ROWS = [(1, "http://a/\r\nX: y", "é€x" * 50_000), (2, "u", None), (3, "u", ""), (4, None, "abc"), (5, "u", "abc"), (5, "u", "abc"), (None, "u", "abc"),
        (None, "v", "zz"), (6, "q", "WARC/1.1\r\nWARC-Type: x"), (7, "q", "x\r\n\r\nWARC/1.1\r\nabc\r\n\r\nWARC/1.1\r\n\r\n\r\nWARC/1.1\r\n"),
        (8, "q", "\r\n\r\n"), (9, "q", "\r\n" * 30_000), (10, "q", "a\r\n\r\nWARC/1.1\r\n" * 3000), (11, "http://x/WARC/1.1", "\0 \x85é")]


def warc_records(rows, least=0):
    keeper = {}
    for i, _, h in rows:
        if i is not None:
            keeper[h or ""] = max(keeper.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = keeper.get(h or "") if len(data) >= least else None
        revisit = to is not None and to != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(map(str, out))


@pytest.mark.parametrize("size,least", [(16, 0), (1000, 4), (1 << 20, 0)])
def test_archives_round_trip(spark, size, least):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumns({"payload": F.lit(1), "n": F.lit(2), "s": F.lit(3)})
    path = new_run_dir(spark, "warc")
    warc.write_archives(warc.chunk_table(df.repartition(2), size, least), path)
    assert sorted(str(tuple(r)) for r in warc.read_records(spark, path).collect()) == warc_records(ROWS, least)
    chunks = warc.read_chunks(spark, path)
    assert chunks.where(F.octet_length("chunk") > max(size, 16)).count() == 0
    whole = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.record_id, r.chunk_no)):
        whole[r.record_id] = whole.get(r.record_id, b"") + bytes(r.chunk)
    assert {(h or "").encode() for _, _, h in ROWS} <= set(whole.values())


def test_empty_archive(spark):
    path = new_run_dir(spark, "warc")
    warc.write_archives(warc.chunk_table(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert warc.read_records(spark, path).count() == 0


def test_damage_is_found(spark):
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC/1.1\r\nWARC-Record-ID: <x>\r\nContent-Length: 10\r\n\r\nabc\r\n\r\n")
