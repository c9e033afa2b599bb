"""Archives and page extraction against small cases and the tables."""

import collections
import html.parser
import random
import zlib

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tractlake.llm import htmltext, warc
from tractlake.llm.queries import REGISTRY


def _pages(spark):
    rows = [(1, "http://a/1", "x"), (2, "http://a/2", "x"), (3, None, None), (4, "b", ""), (5, "http://a/é\r\n", "ü" * 9),
            (5, "http://a/5", "ü" * 9), (None, "u", "x"), (6, "http://a/6", "y" * 300000)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_warc_round_trip_of_edge_cases(spark):
    got = warc.read_warc(warc.write_warc(_pages(spark), roll=64)).collect()
    assert {r.kind for r in got} == {"record"}
    role = collections.Counter((r.record_key, r.record_type, r.refers_to, r.payload_bytes) for r in got)
    assert role == {("1", "revisit", "2", 1): 1, ("2", "response", None, 1): 1, ("3", "revisit", "4", 0): 1,
                    ("4", "response", None, 0): 1, ("5", "response", None, 18): 2, (None, "revisit", "2", 1): 1,
                    ("6", "response", None, 300000): 1}
    assert all(r.payload_digest == warc.sha1_base32(r.payload) for r in got if r.record_type == "response")
    small = warc.read_warc(warc.write_warc(_pages(spark), min_bytes=2)).collect()
    assert {r.record_key for r in small if r.record_type == "revisit"} == set()
    assert warc.read_warc(warc.write_warc(_pages(spark).limit(0))).count() == 0


def _members(n=6, plain=False):
    out = [warc.record(i, f"http://h/{i}", b"payload %d " % i * 50, warc.sha1_base32(b"payload %d " % i * 50))
           for i in range(n)]
    return out if plain else [warc.member(x) for x in out]


def _found(data):
    items = list(warc.salvage(data))
    return [i[3]["warc-record-id"][12:-1] for i in items if i[0] == "record"], [i[1:3] for i in items if i[0] == "gap"]


@pytest.mark.parametrize("plain", [False, True])
def test_salvage_recovers_all_but_the_damaged(plain):
    parts = _members(plain=plain)
    ends = [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
    data = b"".join(parts)
    assert _found(data) == (list("012345"), [])
    broken = bytearray(data)
    broken[ends[2] + len(parts[2]) // 2] ^= 0x55
    assert _found(bytes(broken)) == (list("01345"), [(ends[2], ends[3])])
    cut = data[:ends[2] + 40] + data[ends[3]:]
    assert _found(cut) == (list("01345"), [(ends[2], ends[2] + 40)])
    assert _found(data[:-5])[0] == list("01234") and _found(b"junk\n" + data) == (list("012345"), [(0, 5)])
    assert _found(b"") == ([], []) and _found(b"\x1f\x8b\x08" * 40)[1] == [(0, 120)]


def test_salvage_needs_the_digests():
    good = warc.record(1, None, b"abc", warc.sha1_base32(b"abc"))
    lying = warc.record(2, None, b"abc", warc.sha1_base32(b"abd"))
    mixed = warc.member(good) + warc.member(lying) + good + warc.member(good)
    ids, gaps = _found(mixed)
    assert ids == ["1", "1", "1"] and len(gaps) == 1
    member = bytearray(warc.member(good))
    member[-8:-4] = (zlib.crc32(b"") ^ 1).to_bytes(4, "little")
    assert _found(bytes(member) + warc.member(good))[0] == ["1"]


PAGE = ('<html><head><title>T</title><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li>Home'
        '<li>News</ul></nav><div class="cookie-notice">We use cookies</div>{}<aside>side</aside>'
        '<div id="comments"><p>first!</p></div><form>q</form><footer>&copy; me</footer>')


def test_blocks_by_markup():
    html = PAGE.format('<article><header><h1>The  &amp; title</h1></header><p>One <b>bold</b>\n word<p>Two&#33;<br>x'
                       '<div class="ad">buy</div><!-- no --><script>no</script><p>Three</article>')
    assert htmltext.main_texts([htmltext.blocks_of(html)]) == ["The & title\nOne bold word\nTwo! x\nThree"]
    assert htmltext.blocks_of("") == [] and htmltext.blocks_of("a < b <!-- open") == [("L", "a < b")]


def test_host_repeats_go_and_unique_runs_stay():
    line = "this same long line of text stands on each page of the host"
    pages = [[("L", f"{line} and page {i} says something quite of its own {i * 7}"), ("L", "Top")] for i in range(8)]
    got = htmltext.main_texts(pages)
    assert all("stands on each" not in t and f"{i} says something" in t or t.endswith(str(i * 7)) for i, t in enumerate(got))
    assert all("Top" not in t for t in got)
    article = [[("A", line + " in full"), ("D", "menu")]] * 30  # copies of one page aren't boilerplate
    assert set(htmltext.main_texts(article)) == {line + " in full"}
    alone = [[("A", f"{line} {i}")] for i in range(5)]
    assert htmltext.main_texts(alone) == [f"{line} {i}" for i in range(5)]


def test_pages_give_the_documents_they_were_made_of(spark):
    got = REGISTRY["op5_host_suffix_array"][0](spark, SF_SMALL).collect()
    con = duckdb.connect()
    texts = {" ".join(t.split()) for t, in con.sql(f"SELECT text FROM '{SF_SMALL}/documents.parquet'").fetchall()}
    n, = con.sql(f"SELECT count(*) FROM '{SF_SMALL}/pages.parquet'").fetchall()[0]
    assert len(got) == n and all(r.n_chars == len(r.text) for r in got)
    assert all(" ".join(r.text.split("\n", 1)[1].split()) in texts for r in got)


def test_main_text_edge_rows(spark):
    got = {(r.page, r.text) for r in htmltext.main_text(_pages(spark)).collect()}
    assert (3, "") in got and (4, "") in got and (1, "x") in got or (1, "") in got
    assert htmltext.main_text(_pages(spark).limit(0)).count() == 0


def _words(seed, n):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))


def test_quotes_and_near_copies_stay_on_pages_without_article():
    menu, passage, story = _words("menu", 20), _words("quote", 60), _words("story", 80).split(" ")
    pages = [[("L", menu), ("L", "Top"), ("L", _words(i, 60))] for i in range(12)]
    for i in (3, 7):
        pages[i].append(("L", passage))
        pages[i].append(("L", "See also"))
    for i in range(6):  # near copies: one word differs
        pages.append([("L", menu), ("L", "Top"), ("L", " ".join([*story[:30 + i], f"own{i}", *story[31 + i:]]))])
    want = ["\n".join(t for _, t in p if t not in (menu, "Top")) for p in pages]
    assert htmltext.main_texts(pages) == want
    assert htmltext.main_texts(pages[:4] + pages[7:8] + pages[12:14]) == want[:4] + want[7:8] + want[12:14]


def test_repeats_are_counted_over_the_whole_host(spark, monkeypatch):
    menu, notice = _words("menu", 30), _words("notice", 25)
    pages = [(i, f"http://big/{i}", f"<p>{menu}</p><p>{_words(i, 200)}</p>" if i % 10 == 0 else
              f"<article><p>{_words(i, 200)}</p><p>{notice if i % 8 else 'none'}</p></article>") for i in range(60)]
    pages += [(100 + i, f"http://big/c{i}", f"<article><p>{_words('copied', 100)} end{i}</p></article>") for i in range(3)]
    rows = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    want = {p: t for (p, _, _), t in zip(pages, htmltext.main_texts([htmltext.blocks_of(h) for _, _, h in pages]))}
    assert all(notice not in t and menu not in t for t in want.values()) and want[100].endswith("end0")
    monkeypatch.setattr(htmltext, "SHARD_BYTES", 4000)
    monkeypatch.setattr(htmltext, "SHARD_PAGES", 3)
    assert {r.page: r.text for r in htmltext.main_text(rows).collect()} == want


def test_notices_inside_articles_go_on_small_hosts():
    notice, quote = _words("notice", 20), _words("quote", 50)
    pages = [[("A", _words(i, 90)), ("A", notice)] for i in range(6)]
    for i in range(2):
        pages[i].append(("A", quote))
    assert htmltext.main_texts(pages) == ["\n".join(t for _, t in p if t != notice) for p in pages]


def test_salvage_inside_a_member_of_several_records():
    plain = _members(plain=True)
    lying = plain[2].replace(b"payload 2 ", b"payload x ", 1)
    whole = b"".join([*plain[:2], lying, *plain[3:]])
    data = warc.member(whole)
    ids, gaps = _found(data)
    assert ids == list("01345") and gaps == [(0, len(data))]
    for broken in (data[:-5], data[:-8] + b"wrong" + data[-3:]):
        kinds = [(i[0], i[3]["warc-record-id"][12:-1]) for i in warc.salvage(broken) if i[0] != "gap"]
        assert kinds == [("salvaged", x) for x in "01345"]
    long = warc.member(b"".join(plain), 0)
    kept = [i[3]["warc-record-id"][12:-1] for i in warc.salvage(long[:len(plain[0]) * 4]) if i[0] == "salvaged"]
    assert kept[:3] == list("012")
    every = [i[3]["warc-record-id"][12:-1] for i in warc.salvage(long[:len(plain[0]) * 4]) if i[0] != "gap"]
    assert every == kept and _found(warc.member(b"") + data)[0] == list("01345")

ARTICLE = "<article><h1>Head</h1><p>One two three.</p><p>Four five.</p></article>"
WANT = "Head\nOne two three.\nFour five."


@pytest.mark.parametrize("html", [
    f"<html><head><title>t</title><body>{ARTICLE}</body></html>",  # the head's end tag is optional
    f"<html><head><meta charset=utf-8><title>t</title>{ARTICLE}</html>",
    f"<body><form action=/x><nav>menu</nav>{ARTICLE}</form></body>",
    f'<div class="content has-sidebar">{ARTICLE}</div>', f'<div class="layout sidebar-right">{ARTICLE}</div>',
    f'<div id="search-results-page">{ARTICLE}</div>', f'<div class="site with-sidebar">{ARTICLE}</div>',
    f"<nav><a>menu</a>{ARTICLE}<footer><nav>low</nav></footer>", f"<aside>side{ARTICLE}",
    f'<div class="sidebar">{ARTICLE}</div><div class="related"><p>more</p></div>',
    f'{ARTICLE}<div class="related"><article>teaser</article></div>',
    f'{ARTICLE}<section id="comments"><article class="comment"><p>first!</p></article></section>',
    f'<div class="site-header"><p>Site</p></div><div class="cookie-notice">We use cookies</div>{ARTICLE}<footer>x</footer>',
])
def test_articles_stay(html):
    assert htmltext.main_texts([htmltext.blocks_of(html)]) == [WANT]


def test_text_inside_articles_and_forms():
    text = lambda h: htmltext.main_texts([htmltext.blocks_of(h)])[0]
    for word in ("related-work", "notice", "body social-issues", "search"):
        assert text(f'<article><p>One.</p><section class="{word}"><p>Two.</p></section></article>') == "One.\nTwo."
    assert text('<article><p>One.</p><div class="share-buttons">tweet</div><div class="newsletter-signup">join</div></article>') == "One."
    body = "<p>The page's own words stand here, in a form, as old pages do.</p>"
    assert text(f"<body><form><nav>menu</nav>{body}<footer>low</footer></form>") == body[3:-4]
    assert text(f"{body}<form>Search <input></form>") == body[3:-4]
    # comments never count as most of the page
    assert text(f'{body}<div id="comments">{"<p>first! me too!</p>" * 30}</div>') == body[3:-4]


@pytest.mark.parametrize("html, want", [
    ('<p title="it>Para one.</p><p class="x">Two.</p>', "Para one.\nTwo."), ("<p title='it>One.</p><p>It is 'so'.</p>", "One.\nIt is 'so'."),
    ('<p data-x="<b>a</b>" class=y>One.</p>', "One."), ('<p title="a > b">One.</p>', "One."), ('<p title = "a<b">One.</p>', "One."),
    ("a <b or c < d <p>x", "a <b or c < d\nx"), ('<p =">One.</p>', "One."), ("<p a=b'c>One.</p>", "One.")])
def test_tags_with_odd_quotes(html, want):
    assert htmltext.main_texts([htmltext.blocks_of(html)]) == [want]


def test_phrases_inside_sentences_stay():
    phrase = "is expected to be announced later this year by the company"
    pages = [[("A", f"{_words(i, 12)} {phrase} {_words(-i, 9)}.")] for i in range(4)]
    assert htmltext.main_texts(pages) == [p[0][1] for p in pages]
    many = [[("A", f"{_words(i, 12)} {phrase} {_words(100 + i, 9)}.")] for i in range(20)]
    assert htmltext.main_texts(many) == [p[0][1] for p in many]  # on many pages too
    line = "This story is free to read because of our readers."
    ends = [[("A", f"{_words(i, 30)}. {line} {_words(100 + i, 30)}.")] for i in range(20)]
    assert htmltext.main_texts(ends) == [p[0][1].replace(line + " ", "") for p in ends]
    assert htmltext.main_texts(ends[:5]) == [p[0][1] for p in ends[:5]]  # on few pages a sentence stays


def test_near_copies_are_found():
    """Share of pairs of 400 tokens with a true overlap of 0.80 to 0.83 that fold."""
    rng, found, n = random.Random(3), 0, 0
    while n < 150:
        words = _words(n, 400).split(" ")
        other = list(words)
        for i in rng.sample(range(400), rng.randrange(10, 16)):
            other[i] = f"new{rng.random()}"
        a, b = ([("A", " ".join(x))] for x in (words, other))
        x, y = (set(zip(w, w[1:], w[2:])) for w in (words, other))
        if 0.8 <= len(x & y) / len(x | y) <= 0.83:
            n += 1
            found += htmltext.fold([a, b]) == [0, 0]
    assert found >= 0.9 * n


def test_a_hot_group_of_copies_is_dealt_over_shards(spark, monkeypatch):
    monkeypatch.setattr(htmltext, "SHARD_BYTES", 20_000)
    menu = _words("menu", 30)
    page = lambda text: f"<article><p>{text}</p><p>{menu}</p></article>"
    rows = [(i, "http://big/x", page(_words("copied", 100) + f" end{i % 50}")) for i in range(300)]
    rows += [(300 + i, "http://big/y", page(_words(i, 100))) for i in range(40)]
    got = {r.page: r.text for r in htmltext.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: h[12:h.index("</p>")] for i, _, h in rows}


class Plain(html.parser.HTMLParser):
    """An extraction of its own: the paragraphs and headings of the article."""

    def __init__(self):
        super().__init__()
        self.open, self.blocks, self.now = 0, [], []

    def handle_starttag(self, tag, attrs):
        self.cut(tag)
        self.open += tag == "article"

    def handle_endtag(self, tag):
        self.cut(tag)
        self.open -= tag == "article"

    def cut(self, tag):
        if tag in ("p", "h1", "article"):
            text = " ".join("".join(self.now).split())
            self.blocks += [text] if text else []
            self.now = []
        elif tag == "br":
            self.now.append(" ")

    def handle_data(self, data):
        if self.open:
            self.now.append(data)


def test_query_against_a_plain_parser(spark):
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        p = Plain()
        p.feed(r.html or "")
        want[r.page_id] = "\n".join(p.blocks)
    assert {r.page_id: r.text for r in REGISTRY["op5_host_suffix_array"][0](spark, SF_SMALL).collect()} == want


def test_digests_of_either_spelling_folded_fields_and_other_versions():
    import base64
    import hashlib
    block = b"HTTP/1.1 200 OK\r\n\r\npayload"

    def made(digest, version=b"WARC/1.0", fold=b"", body=b"payload"):
        data = b"HTTP/1.1 200 OK\r\n\r\n" + body
        return (version + b"\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:x-page:1>" + fold + b"\r\nWARC-Payload-Digest: "
                + digest + b"\r\nContent-Length: %d\r\n\r\n" % len(data) + data + b"\r\n\r\n")
    sha1 = hashlib.sha1(b"payload").digest()
    right = [b"sha1:" + x for x in (base64.b32encode(sha1), base64.b32encode(sha1).lower(), sha1.hex().encode(), sha1.hex().upper().encode())]
    right += [b"SHA-256:" + hashlib.sha256(b"payload").hexdigest().encode(), b"md5:" + hashlib.md5(b"payload").hexdigest().encode(),
              b"sha256:" + base64.b32encode(hashlib.sha256(b"payload").digest()).rstrip(b"="), b"crc32:00000000"]
    for digest in right:
        for version in (b"WARC/0.17", b"WARC/0.18", b"WARC/1.0", b"WARC/1.1", b"WARC/2.0"):
            data = made(digest, version, b"\r\nX-Note: a field\r\n  that goes on\r\n\tand on")
            end, fields, got = warc.parse_record(data, 0)
            assert end == len(data) and got == block and fields["x-note"] == "a field that goes on and on"
            assert _found(b"junk" + data)[0] == ["1"]
        if digest != b"crc32:00000000":
            with pytest.raises(warc.Bad, match="payload digest"):
                warc.parse_record(made(digest, body=b"Payload"), 0)
    with pytest.raises(warc.Bad, match="line without field"):
        warc.parse_record(made(b"sha1:").replace(b"\r\nWARC-Type", b"\r\n folded\r\nWARC-Type", 1), 0)


def test_pages_with_clashing_columns(spark):
    rows = [(i, f"http://h/{i}", f"<article><p>Page {i} here.</p></article>", "x", 1, "y", True, [1]) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, id int, host string, "
                                     "counted boolean, bands array<int>")
    assert {r.page: r.text for r in htmltext.main_text(df).collect()} == {i: f"Page {i} here." for i in range(3)}
    assert len(warc.read_warc(warc.write_warc(df)).collect()) == 3


def test_store_names():
    from tractlake.llm.files import known
    assert [known(u) for u in ("s3a://b/k", "s3n://b", "file:/tmp/x", "hdfs://n/x", "/tmp/s3a://x")] == [
        "s3://b/k", "s3://b", "file:/tmp/x", "hdfs://n/x", "/tmp/s3a://x"]
