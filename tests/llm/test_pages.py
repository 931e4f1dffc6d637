import base64
import hashlib
import io
import os
from collections import Counter

import pytest

from candlemill.llm import html_text, warc


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""), ("", ""), ("<div></div>", ""), ("plain text only", "plain text only"), ("<p>a<p>b", "a b"),
        ("<body><p>x &lt; y<br>z&nbsp;&amp; é&#233;</p>", "x < y z & éé"),
        ("<p>one <b>bo</b>ld\n\t word</p>", "one bold word"), ("<script>var t='</p>';</script><p>t</p>", "t"),
        ("<body><nav><ul><li><a href=x>m</a></ul></nav><article><h1>T</h1><p>long text here</p></article><footer>f</footer>", "T long text here"),
        ("<body><header>top</header><main><p>a<div class='ad'>buy</div><p>b</main><aside>s</aside>", "a b"),
        ("<div id=content><p>first para of it</p><div class='post'><p>second para of it</p><ul><li>x<li>y</ul></div></div>"
         "<div class='cookie-notice'>c</div><div id='comments'><p>reader said a lot of things</p></div>",
         "first para of it second para of it x y"),
        ("<article><form>f<p>in form</p></form><p>kept</p><style>p{}</style><!-- no --></article>", "kept"),
        ("<article><p>unclosed <b>bold<p>next</article><p>after", "unclosed bold next"),
        ("<article><nav>menu<p>still menu</article><p>x", "x"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(
    "page,text",
    [
        ("<article><p class='notice'>Ad<p>Real one<p>Real two</article>", "Real one Real two"),
        ("<p class=ad>x<p>Real</p><p>more</p>", "Real more"), ("<p class=ad>x<b>y<p>Real</p>", "Real"),
        ("<article><p>a</p><ul><li class=share>s<li>kept<li class='social'>t<li>too</ul></article>", "a kept too"),
        ("<dl><dt>a<dd class=promo>b<p>c<dt>d<dd>e</dl>", "a d e"), ("<table><tr><td class=ad>x<td>y<tr><td>z</table>", "y z"),
        ("<article><aside>a<p>b<p>c</aside><p>d</article>", "d"), ("<article><p class=ad>x<div>kept</div></article>", "kept"),
        ("<article><div class=ad>x<p>y<div>z</div></div><p>d</article>", "d"),
        ("<article><ul class=related><li>x<li>y<ul><li>z</ul></ul><p>d</article>", "d"),
        ("<article><h2 class=ad>x<h3>Head</h3><p>d</article>", "Head d"), ("<article><p class=ad>x<script>'<p>'</script>y<p>d</article>", "d"),
    ],
)
def test_left_out_end_tags_of_left_out_parts(page, text):
    assert html_text.main_text(page) == text


def test_broken_and_very_long_pages():
    deep = "<div>" * 20_000 + "<p>bottom</p>"
    assert html_text.main_text(deep) == "bottom"
    long = "<p>" + "word " * 200_000 + "</p>"
    assert html_text.main_text(f"<body><nav>m</nav>{long}").count("word") == 200_000
    for broken in ("<", "<a", "<p", "</", "<!--", "<p title='", "&", "<script>", "<p></b></i></p></p>"):
        assert isinstance(html_text.main_text(broken), str)


def test_a_tree_without_links_has_characters_per_tag():
    nodes = html_text.measure(html_text.tree("<body><div><p>12345</p><p>123</p></div></body>"))
    by = {n.name: n for n in nodes}
    assert by["div"].chars == 8 and by["div"].tags == 2 and by["div"].density == 4
    assert by["div"].sum == 8 and by["body"].sum == by["div"].density


def test_extract_passes_rows_on(pages_of):
    rows = [(1, "u", "<p>a b"), (1, "u", "<p>a b"), (None, None, None), (2, None, "")]
    got = sorted((r.page_id or 0, r.url, r.text, r.n_chars) for r in html_text.extract_text(pages_of(rows)).collect())
    assert got == [(0, None, "", 0), (1, "u", "a b", 3), (1, "u", "a b", 3), (2, None, "", 0)]
    assert html_text.extract_text(pages_of([])).collect() == []


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_warc_round_trip(spark, pages_of, tmp_path):
    big = "é" * 300_000
    rows = [(i, f"http://x.org/{i}", h) for i, h in enumerate(["a", "b", "a", "", None, big, big, "a\r\n\r\nb", "WARC/1.1\r\n"])]
    rows += [(100 + i, "u", "copy") for i in range(60)] + [(3, "again", ""), (200, "bad\r\nurl", "c"), (201, None, "d")]
    rows += [(None, "no id", "a"), (None, "x", "alone"), (None, "x", "alone"), (300, "s", "e"), (300, "s", "e")]
    folder = str(tmp_path / "warc")
    files = warc.write_warc(pages_of(rows), folder, roll_bytes=2000).collect()
    assert sum(f.records for f in files) == len(rows) and len(files) > 1
    for f in files:
        data = open(f"{folder}/{f.file}", "rb").read()
        assert len(data) == f.bytes and hashlib.sha256(data).hexdigest() == f.sha256
    assert not [n for n in os.listdir(folder) if n.startswith("_temporary")]
    first = {}
    for page_id, _, h in rows:
        if page_id is not None:
            first[h or ""] = min(first.get(h or "", page_id), page_id)
    seen = Counter()
    expected = []
    for page_id, _, h in rows:
        keeper = first.get(h or "")
        seen[page_id, h or ""] += 1
        revisit = keeper is not None and (page_id != keeper or seen[page_id, h or ""] > 1)
        expected.append((page_id or -1, len((h or "").encode()), digest(h), "revisit" if revisit else "response", keeper if revisit else -1))
    got = warc.read_warc(spark, folder).collect()
    assert sorted((r.page_id or -1 if r.page_id != 0 else -1, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in got) == sorted(expected)
    texts = {r.page_id: r.payload for r in got if r.record_type == "response"}
    assert texts[5] == big.encode() and texts[7] == b"a\r\n\r\nb"


def test_warc_is_deterministic(pages_of, tmp_path):
    rows = [(i, f"u{i}", f"text {i % 7} " * 50) for i in range(50)]
    one = warc.write_warc(pages_of(rows, 1), str(tmp_path / "a"), 1500).collect()
    two = warc.write_warc(pages_of(rows, 1), str(tmp_path / "b"), 1500).collect()
    assert sorted(one) == sorted(two)


def test_warc_of_nothing(spark, pages_of, tmp_path):
    assert warc.write_warc(pages_of([]), str(tmp_path / "w")).collect() == []
    assert warc.read_warc(spark, str(tmp_path / "w")).collect() == []


def test_broken_archives_are_noticed():
    record = warc.page_record(1, "u", b"payload", None, False, "0.0")
    assert [b.endswith(b"payload") for _, b in warc.parse(io.BytesIO(record * 2), 7)] == [True, True]
    with pytest.raises((ValueError, EOFError)):
        list(warc.parse(io.BytesIO(record[:-20])))
