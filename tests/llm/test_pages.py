"""WARC archives and page text: round trips, brute force, odd rows."""

from __future__ import annotations

import base64
import hashlib
import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fundlens.llm import html_text as ht
from fundlens.llm import warc
from fundlens.session import scratch_dir

SHAPE = "page_id long, url string, html string, text string"


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + "é" * 700_000 + "</p>"
    rows = [(1, "http://a.b/1", "<p>x</p>", ""), (2, "http://a.b/2", "<p>x</p>", ""), (3, None, None, None), (4, "u", "", ""),
            (5, "http://a.b/long", long, ""), (6, "http://c.d/\r\nx", "WARC/1.1\r\n\r\nnot a header", ""), (7, "v", long, ""),
            (2, "http://a.b/2", "<p>x</p>", ""), (None, "w", "no id", "")]
    return spark.createDataFrame(rows, SHAPE)


def _b32(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_and_revisits(pages):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    want = []
    for page_id, data in rows:
        keep = max((p for p, d in rows if d == data and p is not None), default=None)
        want.append((page_id, len(data), _b32(data), "response" if page_id == keep else "revisit", None if page_id == keep else keep))
    got = warc.warc_round_trip(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_chunk_rows_carry_running_digests(pages, spark):
    manifest = warc.write_archives(pages, scratch_dir(spark, "test-warc"), roll_bytes=1000)
    rows = warc.read_chunks(spark, manifest, chunk=100_000).filter("record_type = 'response' AND record_id <> 2").collect()
    assert manifest.count() > 1
    payloads = {}
    for r in sorted(rows, key=lambda r: (str(r["record_id"]), r["chunk_no"])):
        seen = payloads.get((r["record_id"], r["url"]), b"")
        assert r["offset"] == len(seen) and r["size"] == len(r["data"]) <= 100_000
        payloads[r["record_id"], r["url"]] = seen = seen + bytes(r["data"])
        assert r["running_sha1"] == _b32(seen)
        if r["last"]:
            assert r["payload_digest"] == _b32(seen) and r["payload_bytes"] == len(seen)
    assert max(map(len, payloads.values())) > 1_000_000


def test_payloads_reach_the_writer_in_bounded_rows(spark):
    texts = {1: "a😀\r\n" * 5000, 2: "", 3: "é" * 8192, 4: "x" * 8193}
    rows = spark.createDataFrame([(i, f"u{i}", t, len(t.encode()), hashlib.sha1(t.encode()).hexdigest(), "response", None) for i, t in texts.items()]
                                 + [(5, "u5", texts[1], 1, "", "revisit", 1)],
                                 "page_id long, url string, html string, bytes long, sha1 string, record_type string, refers_to long")
    got = warc.payload_rows(rows.coalesce(1)).collect()
    assert [(r["page_id"], r["chunk_no"]) for r in got] == sorted((r["page_id"], r["chunk_no"]) for r in got)
    for i, t in texts.items():
        own = [r for r in got if r["page_id"] == i]
        assert "".join(r["data"] for r in own) == t and max(len(r["data"]) for r in own) <= 8192 and {r["chunks"] for r in own} == {len(own)}
        assert [r["url"] for r in own] == [f"u{i}", *[None] * (len(own) - 1)]
    assert [(r["chunk_no"], r["chunks"], r["data"]) for r in got if r["page_id"] == 5] == [(0, 1, None)]


def test_a_large_record_is_written_and_read_in_bounded_memory(spark):
    piece, times = "".join(random.Random(5).choices("abcdefgh <>\n", k=8192)), 6000  # 49 MB
    sha1 = hashlib.sha1()
    for _ in range(times):
        sha1.update(piece.encode())

    def batches():
        for at in range(0, times, 100):
            k = range(at, at + 100)
            yield pa.RecordBatch.from_pydict({
                "page_id": [9] * 100, "url": ["u"] * 100, "sha1": [sha1.hexdigest()] * 100, "bytes": [8192 * times] * 100,
                "record_type": ["response"] * 100, "refers_to": pa.array([None] * 100, pa.int64()), "chunk_no": list(k),
                "chunks": [times] * 100, "data": [piece] * 100})

    tracemalloc.start()
    try:
        (manifest,) = warc._write(batches(), scratch_dir(spark, "test-large"), 1 << 30)
        last = None
        for last in warc._record_rows(manifest.column("file")[0].as_py(), 1 << 16, False):
            pass
        assert tracemalloc.get_traced_memory()[1] < 15_000_000
    finally:
        tracemalloc.stop()
    assert last[6] and last[10] == 8192 * times and last[11] == _b32_hex(sha1.hexdigest())
    with pytest.raises(ValueError, match="chunk"):
        list(warc._write((b.slice(1) for b in batches()), scratch_dir(spark, "test-large"), 1 << 30))


def _b32_hex(digest):
    return base64.b32encode(bytes.fromhex(digest)).decode()


def test_small_payloads_are_never_revisits(pages):
    got = warc.warc_round_trip(pages, min_revisit_bytes=100).filter("record_type = 'revisit'").collect()
    assert [(r["page_id"], r["refers_to"]) for r in got] == [(5, 7)]


def test_no_pages_give_no_rows(spark):
    empty = spark.createDataFrame([], SHAPE)
    assert warc.warc_round_trip(empty).count() == 0 and ht.extract(empty).count() == 0


def _lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("most", [10**9, 3])
def test_alignment_is_a_longest_common_subsequence(most):
    rnd = random.Random(2)
    for _ in range(400):
        a, b = (rnd.choices("abcde", k=rnd.randint(0, 14)) for _ in range(2))
        got, rest = ht.shared(a, b, most), iter(b)
        assert len(got) == _lcs(a, b) and all(a[i] in rest for i in got) and got == sorted(set(got))


def _page(body, marked=True):
    inner = f"<article>{body}</article>" if marked else f"<div>{body}</div>"
    return ("<!DOCTYPE html><html><head><title>T</title><script>var a = '</p>';</script><style>p{}</style></head><body>"
            "<header><h2>Site</h2></header><nav><ul><li>Home<li>News</ul></nav><div class='cookie-notice'>We use cookies</div>"
            f"<p>Best site ever</p>{inner}<aside>Side</aside><form><p>Send</p></form><div id=comments><p>Nice!</p></div><footer>&copy; all</footer></body></html>")


def test_text_of_marked_and_plain_pages(spark):
    rows = [(1, "http://h.org/a/1", _page("<h1>One &amp; two</h1><p>First\n  line<br>goes on<p>Second &lt;b&gt; <b>bold")),
            (2, "http://h.org/a/2", _page("<p>Shared</p><p>Own two, a long line of its own</p>", False)),
            (3, "http://h.org/a/3", _page("<p>Shared</p><p>Own three, another long line of its own</p>", False)),
            (4, "http://h.org/a/4", _page("<p>Shared</p><p>Own four, longer</p>")),
            (5, "http://alone.org/", _page("<p>Only page</p>")),
            (6, "http://h.org/b", None), (7, None, "plain words"), (None, "http://h.org/c", "<p>unclosed <i>text"), (5, "http://alone.org/", "<div hidden>x</div>y")]
    want = {(1, "One & two\nFirst line goes on\nSecond <b> bold"), (2, "Shared\nOwn two, a long line of its own"), (3, "Own three, another long line of its own"), (4, "Shared\nOwn four, longer"),
            (5, "Only page"), (6, ""), (7, "plain words"), (None, "unclosed text"), (5, "y")}
    # page 2's nearest page is 1, which lacks "Shared"; page 3's is 2
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    for ranges in (1, 3, 9):
        got = ht.extract(frame, ranges).collect()
        assert {(r["page_id"], r["text"]) for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)
        assert sorted(str(r["url"]) for r in got) == sorted(str(r[1]) for r in rows)


@pytest.mark.parametrize("page", [
    "<body class='has-sidebar'><p>Kept</p></body>", "<body class='search'><p>Kept</p></body>", "<body><form><p>Kept</p></form></body>",
    "<div class='content-sidebar-wrap'><p>Kept</p></div>", "<div class='header social'><article><p>Kept</p></article></div>",
    "<form><main><fieldset><p>Kept</p></fieldset></main></form>", "<article class='social'><h2 id='search'>Kept</h2></article>",
    "<div class='related'><p>Kept</p></div>", "<div id='page' class='widget'>Kept<div class='ad' hidden>gone</div></div>"])
def test_one_name_never_empties_a_page(page):
    lines = ht.page_lines(f"<html class='modal'>{page}<footer>gone</footer></html>")
    assert [text for text, kind, _ in lines if kind != ht.FURNITURE] == ["Kept"]


def test_names_and_tags_of_furniture_still_count():
    lines = ht.page_lines("<p>Own</p><div class='box ad'>a</div><nav><article>b</article></nav><ul role=menu><li>c</ul><p id=comments>d</p>"
                          "<article>Main<div class='comments'><article>e</article></div><aside>f</aside></article>")
    assert [text for text, kind, _ in lines if kind != ht.FURNITURE] == ["Own", "Main"]


@pytest.mark.parametrize("page", [
    "<article>Kept</article><div id='comments'><li class='comment'><article class='comment-body'>Nice post!<p>More</p></article></li></div>",
    "<article>Kept</article><section class='related'><article class='teaser'><h3>Other</h3>story</article></section>",
    "<main>Kept<div class='comment-list'><p>Nice</p></div><ol class='comments-area'><li>Bad</ol></main>",
    "<main><article>Kept<article class='comment'>Nice</article></article></main>", "<article>Kept</article><article class='teaser'>Other</article>",
    "<div class='related'><article>Kept</article></div>", "<article class='teaser'>Kept</article>", "<div class='comments'><main>Kept</main></div>",
    "<article><h2 class='related'>Kept</h2></article>", "<article class='comments-open'><div class='comments-open'>Kept</div></article>"])
def test_comments_and_teasers_go_where_an_article_stays(page):
    assert ht.main_text(*_judged(ht.page_lines(f"<body><nav>Menu</nav>{page}<footer>gone</footer></body>"))) == "Kept"


def _judged(lines):
    return [x[0] for x in lines], [x[1] for x in lines], ht.line_keys(lines), []


def test_formulas_are_text():
    lines = ht.page_lines("<article>If <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='application/x-tex'>x=2</annotation></math> then</article>")
    assert [x[0] for x in lines] == ["If x=2 then"]


def test_copies_and_heavy_templates_are_compared_with_the_next_differing_page(spark):
    menu = "".join(f"<div>Menu entry number {i} of the whole site</div>" for i in range(9))

    def plain(text):
        return f"<body>{menu}<p>{text}</p><div>Imprint of the site</div></body>"

    rows = [(i, f"http://t.org/{i:03}", plain("Copied text") if 5 <= i < 45 else "" if i == 46 else plain(f"Own {i}")) for i in range(60)]
    rows += [(100 + i, f"http://u.org/{i}", plain(("Left", "Right")[i % 2])) for i in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {i: "Copied text" if 5 <= i < 45 else "" if i == 46 else f"Own {i}" for i in range(60)}
    want |= {100 + i: ("Left", "Right")[i % 2] for i in range(30)}
    for ranges in (1, 7, 40):
        assert {r["page_id"]: r["text"] for r in ht.extract(frame, ranges).collect()} == want


def test_differing_pages_are_met_wherever_ranges_are_cut(spark):
    rnd = random.Random(5)
    words = [f"<p>{c}</p>" for c in "abcdefgh"]
    rows = [(i, f"http://h{rnd.randint(0, 2)}/{rnd.choice(['x', 'y/z', 'y'])}/{i}", "".join(rnd.choices(words, k=rnd.choice([0, 1, 1, 2, 5])))) for i in range(150)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    placed = sorted((u.split("/")[2], "/" + u.split("/", 3)[3], i, ht.page_lines(h)) for i, u, h in rows)
    want = {}
    for at, (host, path, page_id, lines) in enumerate(placed):
        sides = []
        for part in (placed[:at][::-1], placed[at + 1:]):
            found = {}
            for other in part:
                text = [x[0] for x in other[3]]
                if other[0] == host and text and text != [x[0] for x in lines]:
                    found.setdefault(tuple(text), other)
            sides.append(list(found.values())[:2])
        turns = [s[k] for k in range(2) for s in sides if k < len(s)]
        turns.sort(key=lambda o: -len(ht.commonprefix([path, o[1]])))
        others = {}
        for o in turns:
            others.setdefault(tuple(x[0] for x in o[3]), ht.line_keys(o[3]))
        want[page_id] = ht.main_text([x[0] for x in lines], [x[1] for x in lines], ht.line_keys(lines), list(others.values()))
    for ranges in (1, 4, 30):
        assert {r["page_id"]: r["text"] for r in ht.extract(frame, ranges).collect()} == want


def test_doubtful_blocks_inside_an_article_are_decided_by_comparison(spark):
    def page(i, own):
        return (f"<nav>Menu</nav><article><p>Own {i}</p><p>Shared passage</p><div class='share-buttons'><p>Tell a friend</p><p>{own}</p></div>"
                "<form><label>Your e-mail</label></form></article>")

    rows = [(i, f"http://h.org/{i}", page(i, "Same" if i < 2 else f"Only {i}")) for i in range(6)] + [(9, "http://one.org/", page(9, "Same"))]
    got = {r["page_id"]: r["text"] for r in ht.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), 3).collect()}
    want = {i: f"Own {i}\nShared passage\n" + ("Same" if i < 2 else f"Only {i}") for i in range(6)}
    assert got == want | {9: "Own 9\nShared passage\nTell a friend\nSame\nYour e-mail"}
