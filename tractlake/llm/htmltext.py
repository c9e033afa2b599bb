"""Main text of web pages: markup first, then a suffix array per host.

1. Markup. A page becomes blocks of text with a role: ``D`` what markup names as menu, header,
   footer, sidebar, notice, advert, form, comment and the like (by element, or by a whole
   word of its class, id or role); ``A`` what stands inside an article or main element; ``L``
   all else. A page's end decides about elements that are dropped by their name, or are forms or
   headers: where no other article is, one that holds the article stays, and so does, without any
   article, one with more than half of the text. Menus, footers, asides and comments stay dropped. Scripts,
   styles and markup never become text. Character references are decoded; white space inside a
   block becomes one space.
2. Host suffix array. The token streams of a shard's pages are concatenated, each block ended
   by a token of its own, and their suffixes are sorted by their first ``RUN`` tokens (prefix
   doubling: 1, 2, 4, ... tokens; a longer order isn't needed to find repeats of ``RUN``
   tokens or more). Neighbours that agree in ``RUN`` tokens are repeats; a run found on
   enough distinct pages of the host is boilerplate and covers its tokens. Near copies (``ALIKE``
   of the windows of ``SHINGLE`` tokens of two pages are common) count as one page, by the first of
   them, so copies of a text don't make it boilerplate. Enough is at least ``PAGES`` and ``SHARE`` of
   the host's distinct pages of the kind, those with and those without ``A`` blocks counted apart.
   ``L`` blocks shorter than ``RUN`` are compared whole. Of ``A`` blocks whole ones go, or, on
   more pages (``S``), whole sentences; a phrase inside a sentence never does.
3. Of each block what isn't covered stays. A page with ``A`` blocks keeps those; one without
   keeps its ``L`` blocks.

Each page is parsed once, and its blocks are stored. A host's distinct pages are dealt into
shards of about ``SHARD_BYTES`` of html, or of ``SHARD_PAGES`` pages if that is more, so no task
gathers a host of any size; copies aren't dealt at all. Support is counted over the host: a run on
a share of its pages is on that share of some shard's, so what a shard finds (its candidates) is
looked up in every distinct page of a host of several shards, and counted. What is on enough pages is then
covered in each page by itself, copies included.

Defined cases: null and empty html give the empty text; a null url, or one without a host,
belongs to the host ''; repeated rows get the same text; a null page id is hashed as null; an
unclosed comment, script or style reaches to the end of the page, an unclosed head to the first
content of the body, an unclosed menu to the article; a tag that can't be read ends at its ``>``;
an empty table gives an empty result; columns besides the three are neither read nor able to clash.
"""

from __future__ import annotations

import re
import zlib
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tractlake.llm.common import written
from tractlake.llm.simhash import components

RUN = 8
SHARD_BYTES = 1 << 20
SHARD_PAGES = 32
# On how many, and on which share, of a host's distinct pages a run is boilerplate, by role.
PAGES = {"L": 4, "A": 4, "S": 8}
SHARE = {"L": 0.25, "A": 0.5, "S": 0.5}
KINDS = ("L", "A")
SHINGLE, BANDS, BAND, ALIKE = 3, 10, 5, 0.8
ROWS = 64

# Elements of HTML by what they mean here.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "svg", "math", "iframe", "object", "canvas"}
HARD = {"nav", "footer", "aside", "menu", "dialog", "button", "select", "head"}  # never hold the main text
IN_HEAD = {"meta", "link", "base"} | RAW
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
         "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead",
         "tr", "ul"}
CLOSES_P = BLOCK - {"body", "html"}
_COMMENTS = r"comments?|commentlist|disqus|replies|respond"
_ASIDE = (r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|cookies?|consent|gdpr|newsletter|subscribe|signup|sidebar|widgets?|menu|"
          r"nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|share|sharing|social|related|recommend\w*|popup|modal|"
          r"overlay|login|skip|toolbar|complementary|contentinfo")
_PLACE = r"site|page|main|top|bottom|left|right|primary|secondary|global|post|entry|mobile|sticky|header|footer"
_PART = (r"left|right|top|bottom|lists?|items?|box|bar|area|wrap|wrapper|container|content|sections?|blocks?|links?|buttons?|icons?|"
         r"form|inner|outer|posts?|articles?|slot|unit|text|title|message|policy|header|\d+")


def _vocabulary(core: str) -> re.Pattern:
    """Whole class words: one of ``core``, with a place before it and parts after it."""
    return re.compile(rf"(?:(?:{_PLACE})[-_])*(?:{core})(?:[-_](?:{core}|{_PART}))*", re.I)


COMMENTS = _vocabulary(_COMMENTS)
NAMED = _vocabulary(f"{_ASIDE}|{_COMMENTS}|notices?|banners?|masthead|search|copyright")
IN_ARTICLE = _vocabulary(f"{_ASIDE}|{_COMMENTS}")
HEADER = re.compile(r"(?:(?:site|page|main|top|global)[-_])?(?:header|banner)(?:[-_](?:inner|wrap|wrapper|container|top|bar))?", re.I)

# Values in quotes may hold "<" only where the quote surely ends; any other tag ends at its first ">".
TAG = re.compile(r"""<!--|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?>[^<>"'=]+|=\s*"[^"<]*"|=\s*'[^'<]*'"""
                 r"""|=\s*"[^"]*"(?=[\s/>])|=\s*'[^']*'(?=[\s/>])|=)*>|[^<>]*>)""")
NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
STOP = re.compile(r"[.!?…。！？:]['\")\]»”’]*$")
SPACES = re.compile(r"\s+")


class Dropped:
    """An element that is dropped, or may be: ``soft`` ones stay where the main text is in them."""

    def __init__(self, above, soft: bool):
        self.above, self.soft, self.article, self.size, self.kept = above, soft, False, 0, False

    def chain(self):
        d = self
        while d is not None:
            yield d
            d = d.above


def _unclosed(name: str, html: str, at: int) -> bool:
    """Whether no end tag from ``at`` on is left for an element that is open there."""
    ends = len(re.findall(f"</{re.escape(name)}[\\s/>]", html[at:], re.I))
    return ends <= len(re.findall(f"<{re.escape(name)}[\\s/>]", html[at:], re.I))


def _place(name: str, attributes: str, role: str) -> str | None:
    """``hard`` or ``soft`` if an element is dropped, by its name, class, id and role."""
    words = [w for t in NAMES.findall(attributes) for x in t if x for w in x.split()] if "=" in attributes else []
    if name in HARD or any(COMMENTS.fullmatch(w) for w in words):
        return "hard"
    if name in ARTICLE:
        return None
    if name == "form" or any((IN_ARTICLE if role == "A" else NAMED).fullmatch(w) for w in words):
        return "soft"
    return "soft" if role == "L" and (name == "header" or any(HEADER.fullmatch(w) for w in words)) else None


def blocks_of(html: str) -> list[tuple[str, str]]:
    """(role, text) of a page's blocks, in page order."""
    out: list[tuple[str, str, Dropped | None]] = []
    drops: list[Dropped] = []
    stack: list[tuple[str, str, Dropped | None]] = []  # open elements: name, and role and drop inside
    parts: list[str] = []
    role, drop = "L", None

    def flush():
        text = SPACES.sub(" ", "".join(parts)).strip()
        parts.clear()
        if text:
            out.append((role, text, drop))
            for d in drop.chain() if drop else ():
                d.size += len(text)

    def close(name):
        nonlocal role, drop
        at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
        if at < 0:
            return
        if any(n in BLOCK or n == "head" for n, _, _ in stack[at:]):
            flush()
        del stack[at:]
        role, drop = stack[-1][1:] if stack else ("L", None)

    at, n = 0, len(html)
    while at < n:
        m = TAG.search(html, at)
        text = html[at:m.start() if m else n]
        if text:
            if stack and stack[-1][0] == "head" and text.strip():
                close("head")
            parts.append(unescape(text) if "&" in text else text)
        if not m:
            break
        at = m.end()
        name = m[2].lower() if m[2] else None
        if name is None:
            if m[0] == "<!--":
                end = html.find("-->", at)
                at = end + 3 if end >= 0 else n
            continue
        attributes = m[3][:-1]
        if m[1]:
            close(name)
            continue
        if stack and stack[-1][0] == "head" and name not in IN_HEAD:
            close("head")
        if name in RAW:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else n
            continue
        if name in VOID:
            if name in BLOCK:
                flush()
            elif name == "br":
                parts.append(" ")
            continue
        if name in CLOSES_P:
            # A paragraph ends where the next block starts.
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    close("p")
                    break
                if stack[i][0] in BLOCK:
                    break
            if name == "li" and any(x[0] == "li" for x in stack[-2:]):
                close("li")
        if name in BLOCK:
            flush()
        if name in ARTICLE and drop is not None:
            # An article doesn't stand in a menu that is never closed: the menu ends here.
            while (open_ := next((x[0] for x in reversed(stack) if x[0] in HARD), None)) and _unclosed(open_, html, at):
                close(open_)
        inside, below = role, drop
        if name not in ("html", "body"):
            place = _place(name, attributes, role)
            if place:
                below = Dropped(drop, place == "soft")
                drops.append(below)
            elif name in ARTICLE:
                inside = "A"
                for d in drop.chain() if drop else ():
                    d.article = True
        stack.append((name, inside, below))
        role, drop = inside, below
    flush()
    _settle(out, drops)
    return [(r if d is None or all(x.kept for x in d.chain()) else "D", t) for r, t, d in out]


def _settle(out, drops: list[Dropped]) -> None:
    """Keeps soft elements that hold the page's article, or without one most of its text."""
    def keep(which):
        for d in drops:  # outer ones come first
            if d.soft and which(d) and (d.above is None or d.above.kept):
                d.kept = True

    def article():
        return any(r == "A" and (d is None or all(x.kept for x in d.chain())) for r, _, d in out)
    if not drops or article():
        return
    keep(lambda d: d.article)
    if not article():
        whole = sum(len(t) for _, t, d in out if d is None or all(x.soft for x in d.chain()))
        keep(lambda d: 2 * d.size > whole)


def _ranks(tokens: np.ndarray) -> np.ndarray:
    """Equal ranks: equal next ``RUN`` tokens. Ranks order suffixes by those tokens."""
    rank, step = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while step < RUN:
        ahead = np.concatenate([rank[step:], np.arange(len(rank), len(rank) + step)])[:len(rank)]
        rank = np.unique(rank * (2 * len(rank) + step) + ahead, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return rank


def _hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    from pandas.util import hash_array
    code: dict[str, int] = {}
    at = [code.setdefault(w, len(code)) for w in words]
    return hash_array(np.array(list(code), dtype=object), categorize=False)[at] if at else np.zeros(0, np.uint64)


def _joined(columns, seed) -> np.ndarray:
    """One hash for each row of the columns, by their order."""
    out = seed
    for x in columns:
        out = (out ^ x) * np.uint64(0x9E3779B97F4A7C15)
        out = out ^ (out >> np.uint64(29))
    return out


def _windows(hashed: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` tokens from each token on, where so many follow."""
    size = max(len(hashed) - n + 1, 0)
    return _joined((hashed[i:i + size] for i in range(n)), np.full(size, n, np.uint64))


def kind_of(page: list[tuple[str, str]]) -> str:
    return "A" if any(r == "A" for r, _ in page) else "L"


def kept_blocks(page: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The A blocks of a page, or its L blocks if it has none."""
    kind = kind_of(page)
    return [b for b in page if b[0] == kind]


# --- Near copies -------------------------------------------------------------------------

def windows_of(page: list[tuple[str, str]]) -> np.ndarray:
    """The set of a page's SHINGLE-token windows over its kept blocks, sorted; the kinds don't meet."""
    h = _hashes([w for _, t in kept_blocks(page) for w in t.split(" ")])
    return np.unique(_windows(h ^ np.uint64(kind_of(page) == "L"), min(SHINGLE, max(len(h), 1))))


def bands_of(found: np.ndarray) -> np.ndarray:
    """Keys of which similar sets share one: the least hashes of the parts of one permutation,
    an empty part taking those of the next one that isn't."""
    n = BANDS * BAND
    if not len(found):
        return np.zeros(BANDS, np.int64)
    bounds = (np.arange(n + 1) * (2 ** 64 / n)).astype(float)
    first = np.searchsorted(found, bounds[:-1].astype(np.uint64))
    full = np.append(first[1:], len(found)) > first
    at = np.flatnonzero(full)
    source = at[np.searchsorted(at, np.arange(n)) % len(at)]
    least = found[first[source]] ^ (np.uint64(0x9E3779B97F4A7C15) * ((source - np.arange(n)) % n).astype(np.uint64))
    return _joined(least.reshape(BANDS, BAND).T, np.arange(1, BANDS + 1, dtype=np.uint64)).view(np.int64)


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets share ``ALIKE`` of their union."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= ALIKE * (len(a) + len(b) - both)


def fold(pages: list[list[tuple[str, str]]]) -> list[int]:
    """Numbers of the distinct pages: near copies have the same. As ``_folded`` does in Spark."""
    group, sets, first = list(range(len(pages))), [windows_of(p) for p in pages], {}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, found in enumerate(sets):
        for band in bands_of(found).tolist():
            j = first.setdefault(band, i)
            if j != i and root(i) != root(j) and alike(found, sets[j]):
                a, b = sorted((root(i), root(j)))
                group[b] = a
    return [root(i) for i in range(len(pages))]


# --- Repeats -----------------------------------------------------------------------------

class Shard:
    """Token streams of some pages: ``key`` hashes what starts at a token (RUN tokens; a whole L
    block if shorter), odd for L blocks; ``span`` is its tokens (0: nothing starts there)."""

    def __init__(self, pages: list[list[tuple[str, str]]], counted: list[bool]):
        """``counted``: whether a page counts, or is a near copy of one that does."""
        words, owner, loose, span = [], [], [], []
        self.pages = [kept_blocks(p) for p in pages]
        for who, p in enumerate(self.pages):
            for role, text in p:
                mine = text.split(" ")
                n = len(mine)
                words += mine
                words.append("\n")  # in no block
                owner += [who] * (n + 1)
                loose += [role == "L"] * (n + 1)
                span += [RUN] * (n - RUN + 1) + [0] * RUN if n >= RUN else [n if role == "L" else 0] + [0] * n
        self.owner, self.loose, self.span = np.array(owner, np.int64), np.array(loose, bool), np.array(span, np.int64)
        self.words, self.counted = words, np.array(counted, bool)
        self.n_pages = {k: sum(c and kind_of(p) == k for p, c in zip(self.pages, counted)) for k in KINDS}
        hashed = _hashes(words)
        self.key = np.zeros(len(words), np.uint64)
        self.key[:max(len(words) - RUN + 1, 0)] = _windows(hashed, RUN)
        for n in range(1, RUN):
            at = np.flatnonzero(self.span == n)
            self.key[at] = _joined((hashed[at + i] for i in range(n)), np.full(len(at), n, np.uint64))
        self.key = self.key >> np.uint64(1) << np.uint64(1) | self.loose.astype(np.uint64)
        # The suffix array's ranks; each block end is a token of its own.
        tokens = np.unique(hashed, return_inverse=True)[1].astype(np.int64) if len(words) else np.zeros(0, np.int64)
        ends = np.flatnonzero(np.array([w == "\n" for w in words], bool)) if words else np.zeros(0, np.int64)
        tokens[ends] = -1 - np.arange(len(ends))
        self.tokens = tokens

    def supports(self) -> tuple[np.ndarray, np.ndarray]:
        """(keys, number of distinct pages here that have each)."""
        if not len(self.tokens):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        rank = _ranks(self.tokens)
        order = np.lexsort((self.owner, rank))  # the suffix array, pages ascending among equals
        order = order[(self.span[order] > 0) & self.counted[self.owner[order]]]
        r, p = rank[order], self.owner[order]
        fresh = np.ones(len(r), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (p[1:] != p[:-1])
        short = self.span[order] < RUN  # ended by its block's end, so alone in its rank: by key
        keys, on = np.unique(self.key[order][fresh & ~short], return_counts=True)
        pairs = np.unique(np.stack([self.key[order][short], p[short].view(np.uint64)]), axis=1)
        more, times = np.unique(pairs[0], return_counts=True)
        return np.concatenate([keys, more]), np.concatenate([on, times])

    def texts(self, keys: np.ndarray, on: np.ndarray, pages: dict[str, int]) -> list[str]:
        """Main texts, without what ``keys`` cover that are on enough (``on``) of the host's ``pages``."""
        covered = self.covered(keys, on, pages)
        out, at = [], 0
        for p in self.pages:
            blocks = []
            for _, text in p:
                words = text.split(" ")
                gone = covered[at:at + len(words)]
                at += len(words) + 1
                if gone.any():
                    text = " ".join(w for w, g in zip(words, gone.tolist()) if not g)
                if text:
                    blocks.append(text)
            out.append("\n".join(blocks))
        return out

    def covered(self, keys: np.ndarray, on: np.ndarray, pages: dict[str, int]) -> np.ndarray:
        n = len(self.key)
        if not len(keys) or not n:
            return np.zeros(n, bool)
        order = np.argsort(keys)
        keys, on = keys[order], on[order]
        at = np.minimum(np.searchsorted(keys, self.key), len(keys) - 1)
        here = np.where((keys[at] == self.key) & (self.span > 0), on[at], 0)

        def from_starts(starts):
            edge = np.zeros(n + RUN + 1, np.int64)
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + self.span[starts], -1)
            return np.cumsum(edge)[:n] > 0
        out = from_starts(np.flatnonzero(self.loose & (here >= enough("L", pages["L"]))))
        whole = from_starts(np.flatnonzero(~self.loose & (here >= enough("A", pages["A"]))))
        if whole.any():
            runs = from_starts(np.flatnonzero(~self.loose & (here >= enough("S", pages["A"]))))
            ends = np.flatnonzero(self.tokens < 0)
            for a, b in zip([0, *(ends + 1).tolist()], ends.tolist()):
                if whole[a:b].any():
                    out[a:b] |= True if whole[a:b].all() else self._sentences(runs[a:b], self.words[a:b])
        return out

    @staticmethod
    def _sentences(runs: np.ndarray, words: list[str]) -> np.ndarray:
        """The whole sentences of a block that ``runs`` cover."""
        out = np.zeros(len(words), bool)
        if runs.any():
            ends = [i + 1 for i, w in enumerate(words) if STOP.search(w)]
            for a, b in zip([0, *ends], [*ends, len(words)]):
                out[a:b] = a < b and runs[a:b].all()
        return out


def enough(role: str, pages: int) -> float:
    """On how many of a host's ``pages`` distinct pages of a kind a run must stand to be boilerplate."""
    return max(PAGES[role], SHARE[role] * pages)


def main_texts(pages: list[list[tuple[str, str]]]) -> list[str]:
    """Main texts of a host's pages, given as blocks."""
    shard = Shard(pages, [i == g for i, g in enumerate(fold(pages))])
    return shard.texts(*shard.supports(), shard.n_pages)


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(
        url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def _parse(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            read = [blocks_of(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(map(_spelt, read), pa.binary()), *part.columns[3:],
                 pc.binary_length(part.column(2)).cast(pa.int64()),
                 pa.array([bands_of(windows_of(p)) for p in read], pa.list_(pa.int64())), pa.array(map(kind_of, read))],
                ["page", "url", "blocks", *part.schema.names[3:], "bytes", "bands", "kind"])


def _spelt(page: list[tuple[str, str]]) -> bytes:
    return zlib.compress("\n".join(r + t for r, t in kept_blocks(page)).encode("utf-8", "surrogatepass"))


def _blocks(spelt: bytes) -> list[tuple[str, str]]:
    text = zlib.decompress(spelt).decode("utf-8", "surrogatepass")
    return [(b[0], b[1:]) for b in text.split("\n")] if text else []


def _alike(batches):
    for batch in batches:
        a, b = ([windows_of(_blocks(x)) for x in batch.column(i).to_pylist()] for i in (2, 3))
        keep = [alike(x, y) for x, y in zip(a, b)]
        yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])


def _folded(parsed: DataFrame) -> DataFrame:
    """v, root: pages that are near copies of page root of their host. A page is compared
    with the least of each of its bands' pages, over all of their windows."""
    banded = parsed.select("id", F.explode("bands").alias("band"), "host").select(
        "id", F.xxhash64("host", "band").alias("band"))
    least = banded.groupBy("band").agg(F.min("id").alias("m"), F.max("id").alias("most")).filter("m <> most")
    pairs = written(banded.join(least, "band").filter("id <> m").select("id", "m").distinct(), "page-pairs")
    asked = pairs.select("id").union(pairs.select("m")).distinct()
    one = parsed.select("id", "blocks").join(asked, "id", "left_semi").groupBy("id").agg(F.min("blocks").alias("x"))
    both = pairs.join(one, "id").join(one.select(F.col("id").alias("m"), F.col("x").alias("y")), "m")
    edges = both.select(F.col("id").alias("v"), "m", "x", "y").mapInArrow(_alike, "v bigint, m bigint")
    return components(edges)


def _candidates(key, rows):
    """Keys that may be on enough pages of a host: what is on a share of all its pages is on
    that share of the pages of one of its shards. In a host of one shard that is the count."""
    shard = Shard([_blocks(b) for b in rows.column("blocks").to_pylist()], [True] * len(rows))
    keys, on = shard.supports()
    pages = rows.column("pages")[0].as_py()
    need = [enough(k, pages[k]) * shard.n_pages[k] / max(pages[k], 1) - 1e-6 for k in ("A", "L")]
    mine = on >= np.array(need)[(keys & np.uint64(1)).astype(int)]
    n = int(mine.sum())
    return pa.table({"host": pa.array([rows.column("host")[0].as_py()] * n, pa.string()),
                     "key": pa.array(keys[mine].view(np.int64)), "on": pa.array(on[mine], pa.int64())})


def _counts(batches):
    """How many pages of a batch have each of their host's candidates."""
    for batch in batches:
        found: dict[str, list[np.ndarray]] = {}
        for host, blocks, keys in zip(*[c.to_pylist() for c in batch.columns]):
            shard = Shard([_blocks(blocks)], [True])
            here = np.unique(shard.key[shard.span > 0])
            found.setdefault(host, []).append(here[np.isin(here, np.array(keys, np.int64).view(np.uint64))])
        for host, lists in found.items():
            keys, on = np.unique(np.concatenate(lists), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                                              pa.array(on, pa.int64())], ["host", "key", "on"])


def _extract(batches):
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            part, texts = batch.slice(a, ROWS), []
            for blocks, pages, keys, on in zip(*[c.to_pylist() for c in part.columns[2:]]):
                page = _blocks(blocks)
                texts.append("\n".join(t for _, t in kept_blocks(page)) if not keys else Shard([page], [True]).texts(
                    np.array(keys, np.int64).view(np.uint64), np.array(on, np.int64), pages)[0])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page", "url", "text", "n_chars"])


def _enough(kind: str) -> Column:
    return F.greatest(F.lit(float(PAGES[kind])), F.lit(SHARE[kind]) * F.col(f"pages.{kind}"))


def _repeats(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """host, pages, keys, on: what is on enough pages of a host, with the number of its distinct
    pages. ``pages`` are the distinct ones, with host, pages, shards, shard and blocks."""
    found = written(pages.groupBy("host", "shard").applyInArrow(
        _candidates, "host string, key bigint, on bigint"), "host-candidates").join(
        hosts.select("host", "pages", "shards"), "host")
    asked = found.filter("shards > 1").select("host", "key").distinct().groupBy("host").agg(F.collect_list("key").alias("keys"))
    counts = pages.filter("shards > 1").join(written(asked, "host-asked"), "host").select(
        "host", "blocks", "keys").mapInArrow(_counts, "host string, key bigint, on bigint")
    counts = counts.groupBy("host", "key").agg(F.sum("on").alias("on")).join(hosts.select("host", "pages", "shards"), "host")
    least = F.when(F.col("key").bitwiseAND(F.lit(1)) == 1, _enough("L")).otherwise(_enough("A"))
    every = found.filter("shards = 1").select(*counts.columns).unionByName(counts).filter(F.col("on") >= least)
    return written(every.groupBy("host").agg(F.first("pages").alias("pages"), F.collect_list(F.struct("key", "on")).alias("x"))
                   .select("host", "pages", F.col("x.key").alias("keys"), F.col("x.on").alias("on")), "host-repeats")


def main_text(pages: DataFrame, *, page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page, url, text, n_chars: one row per page."""
    kind = pages.schema[page].dataType.simpleString()
    rows = pages.select(pages[page].alias("page"), pages[url].alias("url"),
                        F.coalesce(pages[html], F.lit("")).alias("html"), host_of(pages[url]).alias("host"))
    rows = rows.withColumn("id", F.xxhash64("host", "html")).withColumn("row", F.monotonically_increasing_id())
    parsed = written(rows.mapInArrow(
        _parse, f"page {kind}, url string, blocks binary, host string, id bigint, row bigint, bytes bigint, "
                "bands array<bigint>, kind string"), "page-blocks")
    moved = written(_folded(parsed).withColumnRenamed("v", "id"), "page-groups")
    # A page of several rows, or with near copies, counts by one row of its group's root page.
    signs = parsed.select("host", "id", "row", "bytes", "kind").join(moved, "id", "left")
    own = F.col("root").isNull() | (F.col("root") == F.col("id"))
    first = signs.filter(own).groupBy("id").agg(F.min("row").alias("first"))
    copies = signs.join(first, "id", "left").filter(F.col("first").isNull() | (F.col("row") != F.col("first")) | ~own)
    copies = written(copies.select("row"), "page-copies")
    counted = parsed.join(copies, "row", "left_anti")
    hosts = counted.groupBy("host").agg(F.sum("bytes").alias("bytes"), *[
        F.count_if(F.col("kind") == k).alias(k) for k in KINDS])
    shards = F.least(F.ceil(F.col("bytes") / SHARD_BYTES), F.ceil((F.col("L") + F.col("A")) / SHARD_PAGES))
    hosts = written(hosts.select("host", F.struct(*KINDS).alias("pages"),
                                 F.greatest(shards, F.lit(1)).cast("int").alias("shards")), "hosts", 8)
    dealt = counted.select("host", "row", "blocks").join(hosts, "host").select(
        "host", "pages", "shards", "blocks", F.pmod(F.xxhash64("row"), F.col("shards")).alias("shard"))
    return parsed.select("page", "url", "host", "blocks").join(_repeats(dealt, hosts), "host", "left").select(
        "page", "url", "blocks", "pages", "keys", "on").mapInArrow(
        _extract, f"page {kind}, url string, text string, n_chars bigint")
