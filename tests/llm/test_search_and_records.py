"""Vector search, WARC derivatives and reply threads against brute force."""

import json
import math
import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import registry, threads, vectors, warc
from tallyhouse.llm.common import scratch_path

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


def slow_top(rows, k=5):
    usable = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, a in usable:
        if q is None or q % 50:
            continue
        scores = [
            (-sum(x * y for x, y in zip(a, b, strict=True)), i is None, i)
            for i, b in usable
            if i != q and len(a) == len(b)
        ]
        for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k]):
            out.add((q, rank + 1, i, -s))
    return out


@pytest.mark.parametrize("dim", [1, 3, 17, 64])
def test_top_k_equals_brute_force(make, dim):
    rng = np.random.default_rng(dim)
    centers = rng.normal(size=(4, dim))
    rows = [(i, (centers[i % 4] + 0.3 * rng.normal(size=dim)).tolist()) for i in range(260)]
    rows += [(300 + i, rows[50][1]) for i in range(20)]  # ties
    rows += [(400, [0.0] * dim), (None, rows[7][1]), (450, None), (500, [float("nan")] * dim)]
    rows += [(501, [None] * dim), (550, [float("inf")] * dim), (600, [1.0] * (dim + 1))]
    df = make([(i, v, 0) for i, v in rows], VECTORS)
    found = vectors.top_k(df, F.col("vec_id") % 50 == 0, query_block=3, row_block=40).collect()
    assert {tuple(r) for r in found} == slow_top(rows) and len(found) == len(set(found))


def test_bounds_drop_pairs_of_the_given_vectors():
    """These have no direction that stands out, so only the finest level drops many pairs."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids = table["vec_id"].to_numpy()
    x = np.floor(256 * np.array(table["embedding"].to_pylist(), float)).astype(np.int64)
    asked, shares = ids % 50 == 0, []
    q, r, score = vectors.best(x[asked], ids[asked], x, ids, 5, shares)
    assert len(shares) == 4 and shares[2] > 0.9 and shares[3] < 0.7
    exact = x[asked] @ x.T
    exact[ids[asked][:, None] == ids[None, :]] = -(1 << 60)
    assert np.array_equal(score.reshape(-1, 5), -np.sort(-exact, axis=1)[:, :5])


def test_products_of_large_numbers_are_exact():
    x = np.array([[(1 << 30) + 1, 3], [5, -(1 << 30)]], np.int64)
    assert vectors._products(x, x).tolist() == [[int(a @ b) for b in x.astype(object)] for a in x.astype(object)]
    assert vectors._products(x % 100, x % 100).tolist() == ((x % 100) @ (x % 100).T).tolist()


def test_bounds_drop_most_candidates():
    rng = np.random.default_rng(0)
    x = np.cumsum(rng.integers(-60, 60, size=(2000, 64)), axis=1)
    shares = []
    q, r, s = vectors.best(x[:5], np.arange(5), x, np.arange(2000), 5, shares)
    full = x[:5] @ x.T
    for i in range(5):
        full[i, i] = -(1 << 60)
        order = np.lexsort((np.arange(2000), -full[i]))[:5]
        assert r[q == i].tolist() == order.tolist() and s[q == i].tolist() == full[i][order].tolist()
    assert shares == sorted(shares, reverse=True) and shares[-1] < 0.15


def test_few_or_no_vectors(make):
    one = make([(0, [1.0, 2.0], 1)], VECTORS)
    assert vectors.top_k(one, F.col("vec_id") % 50 == 0).count() == 0
    two = make([(0, [1.0, 2.0], 1), (1, [0.5, -1.0], 1), (2, [], 1), (50, [], 1)], VECTORS)
    found = vectors.top_k(two, F.col("vec_id") % 50 == 0).collect()
    assert {tuple(r) for r in found} == {(0, 1, 1, 256 * 128 - 512 * 256), (50, 1, 2, 0)}
    assert vectors.top_k(make([], VECTORS), F.col("vec_id") % 50 == 0).count() == 0
    again = make([(0, [1.0], 1), (0, [1.0], 1), (1, [1.0], 1), (1, [1.0], 1)], VECTORS)
    rows = vectors.top_k(again, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in rows) == [(0, k, 1, 65536) for k in (1, 1, 2, 2)]


class Slow(HTMLParser):
    """The visible text by a parser."""

    BLOCKS = set(
        "address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 "
        "header hr li main nav ol option p pre section table tbody td tfoot th thead tr ul".split()
    )
    HIDDEN = {"script", "style", "noscript", "template", "title", "svg"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hidden, self.links = [], 0, []

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in self.HIDDEN
        if tag in self.BLOCKS:
            self.out.append("\n")
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        self.hidden -= tag in self.HIDDEN
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(" ".join(data.split("\n")) if data.strip() else " ")

    def text(self):
        lines = (" ".join(line.split()) for line in "".join(self.out).split("\n"))
        return "\n".join(line for line in lines if line)


def test_derivatives_of_all_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    responses = {r.record_id: r for r in warc.responses_of(spark.read.parquet(f"{SMALL}/pages.parquet")).collect()}
    rows = registry.QUERIES["op2_warc"](spark, SMALL).collect()
    assert len(responses) == len(pages) and len(rows) == 2 * len(pages)
    assert len({r.record_id for r in rows}) == len(rows)
    for r in rows:
        source = responses[r.refers_to]
        page = pages[source.page_id]
        assert (r.target_uri, r.date) == (page.url, source.date)
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
        assert r.source_payload_digest == warc.digest(page.html.encode())
        if r.warc_type == "metadata":
            facts = json.loads(r.block)
            slow = Slow()
            slow.feed(page.html)
            assert facts["status"] == 200 and facts["links"] == slow.links
            assert facts["headers"][0] == ["Content-Type", "text/html; charset=utf-8"]
            assert facts["payload_length"] == len(page.html.encode())
        else:
            slow = Slow()
            slow.feed(page.html)
            slow.close()
            assert "".join(r.block.split()) == "".join(slow.text().split())
            assert "<script" not in r.block and "\n\n" not in r.block


OLD_LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
OLD_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)
OLD_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
OLD_TAG = re.compile(r"""<[a-zA-Z/!?](?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")


def test_linear_readers_equal_their_patterns():
    """Each reader finds what one regular expression would, which is too slow for long pages."""
    rng = random.Random(5)
    parts = ["<a ", "<A\n", "href=", " href = ", "HREF='", '"', "'", ">", "x", " ", "<html ", "lang=", "lang='de", "<title", "</title >", "<title>", "<b", "/", "=", "ahref="]
    for _ in range(4000):
        page = "".join(rng.choices(parts, k=rng.randint(1, 25)))
        assert warc.links_of(page) == ["".join(x) for x in OLD_LINK.findall(page)], page
        lang = OLD_LANG.search(page)
        assert warc.lang_of(page) == (lang[1] if lang else None), page
        title = OLD_TITLE.search(page)
        assert warc.title_of(page) == (" ".join(title[1].split()) if title else None), page
        assert warc.without_tags(page) == OLD_TAG.sub("", page), page


@pytest.mark.parametrize("part", ["<a ", "<title>", "<html ", '<a "', "<a '\"", "<a href= ", "</title ", "<!--", "<script ", "<p"])
def test_broken_pages_take_time_in_proportion(part):
    page = part * (900_000 // len(part))
    started = time.perf_counter()
    warc.derivatives("r", None, None, page.encode())
    assert time.perf_counter() - started < 10


def test_warc_files_round_trip(spark):
    rows = registry.QUERIES["op2_warc"](spark, SMALL)
    path = scratch_path(spark, "warc")
    warc.write_warc(rows, path)
    assert sorted(map(tuple, warc.read_warc(spark, path).collect()), key=str) == sorted(
        map(tuple, rows.collect()), key=str
    )


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain &amp; simple &lt;b&gt;", "plain & simple <b>"),
        ("<p>a<br>b</p><p>c", "a\nb\nc"),
        ("a<script>x</script>b<!-- c -->d<style>e", "a b d"),
        ('<a title="x>y" href=z>link</a> 1 < 2', "link 1 < 2"),
        ("<title>T</title><h1> A\n B </h1>", "A B"),
    ],
)
def test_plain_text(page, text):
    assert warc.plain_text(page) == text


def test_odd_responses(spark, make):
    import gzip

    schema = "record_id string, target_uri string, date string, block binary, warc_type string"
    packed = gzip.compress("<p>zip é</p>".encode())
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n"
    rows = [
        (None, None, None, None, "x"),
        ("<a>", "http://a", "d", b"", "x"),
        ("<b>", "http://b", "d", b"<p>no head</p>", "x"),
        ("<c>", "http://c", "d", b"HTTP/1.1 404 Not Found\r\nContent-Type: image/png\r\n\r\n\x89PNG", "x"),
        ("<d>", "http://d", "d", head + b"Content-Encoding: gzip\r\n\r\n" + packed, "x"),
        ("<e>", "http://e", "d", head + b"Transfer-Encoding: chunked\r\n\r\n3\r\n<p>\r\n2\r\nhi\r\n0\r\n\r\n", "x"),
        ("<f>", "http://f", "d", b"HTTP/1.0 200\r\nContent-Type: text/plain; charset=latin-1\r\n\r\n a  \xe9\n\n<b>", "x"),
        ("<g>", "http://g", "d", head.replace(b"html", b"html; charset=nonsense") + b"\r\n\xff ok", "x"),
        ("<b>", "http://b", "d", b"<p>no head</p>", "x"),
    ]
    found = warc.derive(make(rows, schema)).collect()
    texts = {r.refers_to: r.block for r in found if r.warc_type == "conversion"}
    assert texts == {"<b>": "no head", "<d>": "zip é", "<e>": "hi", "<f>": "a é\n<b>", "<g>": "� ok"}
    status = {r.refers_to: json.loads(r.block)["status"] for r in found if r.warc_type == "metadata"}
    assert status == {None: None, "<a>": None, "<b>": None, "<c>": 404, "<d>": 200, "<e>": 200, "<f>": 200, "<g>": 200}
    assert sum(r.refers_to == "<b>" for r in found) == 4
    assert [r.record_id for r in found if r.refers_to is None] == [None]
    assert warc.derive(make([], schema)).count() == 0


MAIL = "conv_id long, turn long, role string, text string, depth int, place string"


def test_parse_levels_and_attribution():
    body = "Ann wrote:\n> > deep  one\n> > goes on\n>\n> shallow\n>> again\nown text\n\nmore own\n> tail"
    own, passages = threads.parse(body)
    assert own == "own text\n\nmore own"
    assert [level for level, _ in passages] == [2, 1, 2, 0, 0, 1]
    assert passages[0][1] == threads.parse("DEEP one goes  on")[1][0][1]
    assert threads.parse(None) == threads.parse("") == ("", [])
    assert threads.levels(">" * 300 + " x")[0] == (300, "x")


def test_links_threads_and_order(make):
    rows = [
        (1, 0, "a", "Hello all"),
        (1, 1, "b", "> hello   ALL\nFirst answer"),
        (1, 2, "c", "> Hello all\nSecond answer"),
        (1, 3, "a", "b wrote:\n> > Hello all\n> First answer\nThanks"),
        (1, 4, "d", "A new thread"),
        (1, 5, "d", "> never said\nodd"),
        (1, 6, "e", "> Thanks\n> \n> Second answer\nboth"),
        (2, 0, "a", "> Hello all\nother conversation"),
        (2, 1, "b", "> not yet said\nx"),
        (2, 2, "b", "not yet said"),
    ]
    found = threads.link_replies(make([(*r, 1, "x") for r in rows], MAIL)).collect()
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth, r.position, r.text) for r in found}
    assert got == {
        (1, 0): (None, 0, 0, 0, "Hello all"),
        (1, 1): (0, 0, 1, 1, "First answer"),
        (1, 2): (0, 0, 1, 2, "Second answer"),
        (1, 3): (1, 0, 2, 3, "Thanks"),
        (1, 6): (3, 0, 3, 4, "both"),
        (1, 4): (None, 4, 0, 5, "A new thread"),
        (1, 5): (None, 5, 0, 6, "odd"),
        (2, 0): (None, 0, 0, 0, "other conversation"),
        (2, 1): (None, 1, 0, 1, "x"),
        (2, 2): (None, 2, 0, 2, "not yet said"),
    }
    counts = {(r.conv_id, r.turn): (r.n_quoted, r.n_linked) for r in found}
    assert counts[1, 6] == (2, 2) and counts[1, 5] == (1, 0) and counts[1, 3] == (2, 2)


def test_a_long_chain_and_a_popular_message(make):
    chain = [(1, 0, "a", "m0")] + [(1, i, "a", f"> m{i - 1}\nm{i}") for i in range(1, 90)]
    star = [(2, 0, "a", "the first")] + [(2, i, "a", f"> the first\nr{i}") for i in range(1, 200)]
    found = threads.link_replies(make([(*r, 1, "x") for r in chain + star], MAIL)).collect()
    assert {(r.turn, r.depth, r.position, r.root_turn) for r in found if r.conv_id == 1} == {
        (i, i, i, 0) for i in range(90)
    }
    assert {(r.turn, r.depth, r.position) for r in found if r.conv_id == 2} == {
        (i, int(i > 0), i) for i in range(200)
    }


def test_odd_messages(make):
    rows = [
        (None, 0, None, "x"), (None, 1, None, "> x\ny"), (3, None, None, "z"), (3, 1, None, "> z\nw"),
        (4, 0, "a", None), (4, 1, "a", ""), (4, 2, "a", "> \n>\n"), (5, 0, "a", "same"), (5, 0, "a", "same"),
        (5, 1, "b", "> same"), (6, 0, "a", "> " + "long " * 20_000),
    ]
    found = threads.link_replies(make([(*r, 1, "x") for r in rows], MAIL)).collect()
    assert len(found) == len(rows)
    assert sum(r.parent_turn is not None for r in found) == 1
    assert sorted(r.position for r in found if r.conv_id == 5) == [0, 1, 2]
    assert threads.link_replies(make([], MAIL)).count() == 0
