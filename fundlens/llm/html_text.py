"""Main text of web pages by nearest-URL page differencing.

1. A page becomes text lines, one per block (white space turned into single spaces,
   character references decoded). Each line has a key. Under markup that can only be furniture
   (navigation, header, footer, aside, hidden parts, or a whole class, id or role name for them) the key is the
   line's place in the markup, as menus repeat in form while their words change; elsewhere it
   is the line's text. Names never mark the page, an article or what holds one, nor a heading by its id or class, nor all text
   of a page; forms are no furniture by themselves.
2. Pages are ordered by host, URL path and id; each meets up to ``SIDE`` pages of its host before
   and after it. Pages whose lines to keep are equal are copies, which say nothing about
   furniture: behind a copy the next page with another text is met, however many copies
   lie between. Those whose path shares the longer beginning are nearer. The lines of both
   are aligned by longest common subsequence (bit-parallel), and lines shared with the two
   nearest (or the only one) are deleted. Inside an article that the page marks itself
   (``article`` or ``main``) the mark decides instead, as articles share passages that no comparison can
   tell from furniture (figures in the README); only its doubtful blocks (forms, names with a part that
   marks furniture) lose the lines that all differing pages met, two at least, share. Articles that are reader comments or
   teasers by their name or by what holds them go where the page has other marked text.
3. An exact check follows: furniture that the nearest page lacks goes by its markup, and
   of a page that marks its article only lines inside it stay.

Order is found on narrow rows (place and a hash of the lines to keep). Range partitions cut a
host of any size; the last differing pages before and the first after each range are known
from a few rows a range and go, for comparison only, to that range, so results don't depend
on where ranges are cut. Page text is shuffled once.

Null html gives an empty text, a null url is a host of its own with an empty path, rows
repeating an id are treated each, an empty table gives no rows, and a text of any length
is whole.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import partial
from itertools import zip_longest
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import shuffle_partitions, slices, staged

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)/?>", re.S)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
#: Elements whose content is no text of the page.
_RAW = frozenset("script style noscript template iframe textarea title svg annotation annotation-xml object canvas audio video select datalist".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td
    tfoot th thead tr ul caption""".split())
#: Start tags that end an open element of the same kind.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "option": ("option",)}
_HOLDS = frozenset("ul ol dl table article main section div body".split())
_MAIN = frozenset(("article", "main"))
_FURNITURE = frozenset("nav footer aside menu dialog button".split())
#: Never furniture by a name: what holds the whole page or its article.
_WHOLE = frozenset(("html", "body", "article", "main"))
#: Inside an article the comparison decides on these and on names with a part that marks furniture.
_DOUBTFUL = frozenset("form fieldset label".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Whole class, id or role names that mark furniture.
_MARKS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies
    consent disclaimer disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice popup promo promotion
    related recommended reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription toolbar widget alert complementary contentinfo dialog tracking pagination pager cookie-notice cookie-banner
    cookie-consent site-header site-footer site-nav main-nav""".split())

#: Of these, and of names that begin with ``comment-`` or ``comments-`` (but for their states), an article
#: inside or by itself is a comment or a teaser where the page has other text in an article.
_ANSWERS = frozenset("comment comments disqus recommended related replies reply respond sponsored teaser teasers".split())
_COMMENT = re.compile(r"comments?[-_](?!open|closed|count|enabled|disabled)")

_PARTS = re.compile(r"[a-z]+")

FURNITURE, MAIN, OTHER, DOUBTFUL = 0, 1, 2, 3
_NAMED = 4  # furniture by a name only, while a page is read
_KEPT = (MAIN, DOUBTFUL)
#: Differing pages to meet on each side.
SIDE = 2


def _marked(tag: str, attributes: str) -> int | None:
    """``FURNITURE`` for a hidden element, ``_NAMED`` for one with a furniture name, ``DOUBTFUL`` for one
    with part of such a name or a form, else None."""
    got = DOUBTFUL if tag in _DOUBTFUL else None
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return FURNITURE
        if name in ("class", "id", "role") and tag not in _WHOLE and not (name != "role" and tag in _HEADINGS):
            if not _MARKS.isdisjoint(value.split()) or any(map(_COMMENT.match, value.split())):
                got = _NAMED
            elif got is None and not _MARKS.isdisjoint(_PARTS.findall(value)):
                got = DOUBTFUL
    return got


def _answers(attributes: str) -> bool:
    """Whether a class or id names comments or teasers."""
    names = [n for a, v in _ATTRIBUTE.findall(attributes) if a.lower() in ("class", "id") for n in v.strip("\"'").lower().split()]
    return not _ANSWERS.isdisjoint(names) or any(map(_COMMENT.match, names))


def page_lines(page: str) -> list[tuple[str, int, str]]:
    """(text, kind, place in the markup) of every block of text in page order."""
    out, run, stack = [], [], []  # stack: (tag, kind, whether in comments or teasers)

    def kind():
        return stack[-1][1] if stack else OTHER

    def flush():
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                out.append((text, kind(), "/".join(t for t, *_ in stack[-4:]), bool(stack) and stack[-1][2]))

    def pop_to(tags, stop=frozenset()):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in tags:
                del stack[i:]
                return
            if stack[i][0] in stop:
                return

    at, size = 0, len(page)
    while at < size:
        found = _TAG.search(page, at)
        text = page[at:found.start() if found else size]
        if text:
            run.append(entities.unescape(text) if "&" in text else text)
        if not found:
            break
        at = found.end()
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            run.append(" ")
        if found[1]:
            pop_to((tag,), _HOLDS if tag not in _HOLDS else frozenset())
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in _VOID:
            continue
        if tag in _BLOCK:
            pop_to(("p",), _HOLDS)
        if tag in _CLOSES:
            pop_to(_CLOSES[tag], _HOLDS)
        own = kind()
        mark = _marked(tag, found[3])
        if own != FURNITURE:
            if tag in _FURNITURE or (tag == "header" and own != MAIN) or mark == FURNITURE:
                own = FURNITURE
            elif tag in _MAIN and not (own == _NAMED and any(t == "article" for t, *_ in stack)):
                own = MAIN  # also below a furniture name; only in an article that is a comment or a teaser
            elif mark == _NAMED:
                own = _NAMED
            elif mark == DOUBTFUL and own == MAIN:
                own = DOUBTFUL
        if tag not in _BLOCK and own != kind():
            flush()  # an inline piece of furniture is a line of its own
        answer = bool(stack) and stack[-1][2]
        if not answer and tag != "main" and (mark == _NAMED or tag == "article") and found[3]:
            answer = _answers(found[3])
        stack.append((tag, own, answer and tag != "main"))
    flush()
    # names alone never empty a page: without any other text the comparison with its nearest page decides
    named = FURNITURE if any(k in (MAIN, OTHER, DOUBTFUL) for _, k, *_ in out) else OTHER
    # an article among comments or teasers is the page's own only where no other text is marked
    other = any(k in _KEPT and not answer for _, k, _, answer in out)
    return [(text, named if k == _NAMED else FURNITURE if answer and other and k in _KEPT else k, place) for text, k, place, answer in out]


def line_keys(lines: list[tuple[str, int, str]]) -> list[int]:
    """A 64-bit key per line: its place for furniture, its text elsewhere."""
    return [int.from_bytes(hashlib.blake2b((f"\0{place}" if kind == FURNITURE else text).encode("utf-8", "surrogatepass"), digest_size=8)
                           .digest(), "little", signed=True) for text, kind, place in lines]


# ---- alignment -------------------------------------------------------------------------------------------------

def _rows(a: list, b: list, keep: bool) -> list[int]:
    """Bit vectors of the LCS table of ``a`` by ``b``: a zero bit j in row i is a step of the table."""
    masks: dict = {}
    for j, y in enumerate(b):
        masks[y] = masks.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, out = full, []
    for x in a:
        u = v & masks.get(x, 0)
        v = (v + u | v - u) & full
        if keep:
            out.append(v)
    return out if keep else [v]


def _steps(v: int, n: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(v.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def shared(a: list, b: list, most: int = 200_000_000) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``. Beyond ``most`` table cells
    ``a`` is halved and the best place to cut ``b`` is found from both sides, so memory stays linear."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    mid_a, mid_b = a[head:len(a) - tail], b[head:len(b) - tail]
    out = []
    if mid_a and mid_b and len(mid_a) * len(mid_b) > most and len(mid_a) > 1:
        cut = len(mid_a) // 2
        left = _steps(_rows(mid_a[:cut], mid_b, False)[0], len(mid_b))
        right = _steps(_rows(mid_a[:cut - 1 if cut else None:-1], mid_b[::-1], False)[0], len(mid_b))[::-1]
        best = int((left + right).argmax())
        out = shared(mid_a[:cut], mid_b[:best], most) + [cut + i for i in shared(mid_a[cut:], mid_b[best:], most)]
    elif mid_a and mid_b:
        rows, i, j = _rows(mid_a, mid_b, True), len(mid_a), len(mid_b)
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
                continue
            i -= 1
            if i == 0 or rows[i - 1] >> (j - 1) & 1:
                out.append(i)
                j -= 1
        out.reverse()
    return [*range(head), *(head + i for i in out), *range(len(a) - tail, len(a))]


def wanted_kinds(kinds) -> tuple[int, ...]:
    """The kinds of line that a page may keep: those of its article if it marks one."""
    return (MAIN, DOUBTFUL) if MAIN in kinds or DOUBTFUL in kinds else (OTHER,)


def signature(lines: list[tuple[str, int]]) -> int:
    """A 64-bit hash of the lines to keep, equal for copies; 0 for a page without any."""
    wanted = wanted_kinds([k for _, k, *_ in lines])
    kept = "\n".join(t for t, k, *_ in lines if k in wanted)
    return kept and int.from_bytes(hashlib.blake2b(kept.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True) or 0


def main_text(texts: list[str], kinds, keys: list[int], others: list[list[int]]) -> str:
    """The lines that stay, joined by line feeds; ``others`` holds the keys of differing pages of the host, nearest first."""
    wanted = wanted_kinds(kinds)
    # the two nearest judge a page without a marked article, all (two at least) a doubtful block inside one
    judged, others = (OTHER, others[:2]) if wanted == (OTHER,) else (DOUBTFUL, others if len(others) > 1 else [])
    gone = set.intersection(*(set(shared(keys, o)) for o in others)) if others and judged in kinds else set()
    return "\n".join(t for i, (t, k) in enumerate(zip(texts, kinds, strict=True)) if k in wanted and not (k == judged and i in gone))


# ---- Spark -----------------------------------------------------------------------------------------------------

_LINES = pa.schema([("range", pa.int64()), ("own", pa.bool_()), ("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()),
                    ("sig", pa.int64()), ("url", pa.string()), ("keys", pa.list_(pa.int64())), ("kinds", pa.list_(pa.int8())),
                    ("texts", pa.list_(pa.string()))])
_LINES_DDL = ("range long, own boolean, host string, path string, page_id long, sig long, url string, keys array<long>, kinds array<byte>, "
              "texts array<string>")
_PLACES = pa.schema([("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("sig", pa.int64())])
_PLACES_DDL = "host string, path string, page_id long, sig long"
_TEXT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
_ADDRESS = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
_NO_ID = -(1 << 63)


def _places(batches) -> Iterator[pa.RecordBatch]:
    """Where each page stands and the signature of its text; null ids as the least id."""
    for cols, texts in slices(batches, "html"):
        ids = [_NO_ID if i is None else i for i in cols["page_id"]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((cols["host"], cols["path"], ids, [signature(page_lines(t)) for t in texts]),
                                                                              _PLACES, strict=True)], schema=_PLACES)


def _met(recent: list[tuple], sig: int, page: tuple) -> None:
    """``recent`` holds the last pages of ``SIDE`` + 1 different texts, the last one first."""
    if sig:
        recent[:] = [(sig, page), *[x for x in recent if x[0] != sig][:SIDE]]


def _ends(batches) -> Iterator[pa.RecordBatch]:
    """A row per range: its first and last place, and as ``(host, path, page_id, sig)`` the differing pages met from either end."""
    low = high = None
    head, tail = [], []  # of the first host and of the last
    for batch in batches:
        for place in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if low is None:
                low = place
            if high is not None and high[0] != place[0]:
                tail.clear()
            high = place
            _met(tail, place[3], place)
            if place[0] == low[0] and place[3] and len(head) <= SIDE and all(x[3] != place[3] for x in head):
                head.append(place)
    if low is not None:
        kinds = [(0, low), (1, high), *((2, x) for x in head), *((3, x) for _, x in tail)]
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * len(kinds), pa.int64()), pa.array([k for k, _ in kinds], pa.int64()),
                                          *[pa.array([x[i] for _, x in kinds], _PLACES[i].type) for i in range(4)]],
                                         names=["p", "what", "host", "path", "page_id", "sig"])


def visits(ranges: list[dict]) -> dict[tuple, list[int]]:
    """Place of a page -> the ranges it goes to for comparison. A range is ``low``, ``high``, ``head`` and ``tail`` of ``_ends``, in order."""
    out: dict = {}

    def carry(at, step, end, near, side):
        known: list = []
        for r in at:
            if not 0 <= r + step < len(ranges):
                continue
            own, beside = ranges[r], ranges[r + step]
            host, single = beside[near][0], beside["low"][0] == beside["high"][0]
            more = [x for x in known if x[0] == host] if single else []
            known = list(beside[side])
            for x in more:
                if len(known) <= SIDE and all(x[3] != y[3] for y in known):
                    known.append(x)
            if own[end][0] == host:
                for x in known:
                    out.setdefault(x, []).append(r)

    carry(range(1, len(ranges)), -1, "low", "high", "tail")
    carry(range(len(ranges) - 2, -1, -1), 1, "high", "low", "head")
    return out


def _lines(batches, lows: list[tuple], goes: dict[tuple, list[int]]) -> Iterator[pa.RecordBatch]:
    """Parsed pages with their range; the pages that another range compares with also for that range."""
    for cols, texts in slices(batches, "html"):
        rows = []
        for host, path, page_id, url, page in zip(cols["host"], cols["path"], cols["page_id"], cols["url"], texts, strict=True):
            lines = page_lines(page)
            place = (host, path, _NO_ID if page_id is None else page_id)
            keys, kinds, sig = line_keys(lines), [k for _, k, _ in lines], signature(lines)
            wanted = wanted_kinds(kinds)
            rows.append((max(0, bisect_right(lows, place) - 1), True, host, path, page_id, sig, url, keys, kinds,
                         [t if k in wanted else "" for t, k, _ in lines]))
            for other in goes.get((*place, sig), ()):
                rows.append((other, False, host, path, page_id, sig, None, keys, kinds, []))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _LINES, strict=True)], schema=_LINES)


def _difference(batches) -> Iterator[pa.RecordBatch]:
    """Each page between the differing pages before and after it. Pages wait until the differing ones after
    them have come; copies that wait share their texts."""
    recent: list = []
    wait: list = []  # (row, differing pages before it)
    out: list = []
    due, group = 8, None

    def done(row, before, after):
        _, _, _, path, page_id, _, url, keys, kinds, texts = row
        turns = sorted((x for pair in zip_longest(before, after) for x in pair if x), key=lambda x: -len(commonprefix([path, x[1][0]])))
        others = {}
        for sig, (_, other) in turns:
            others.setdefault(sig, other)
        text = main_text(texts, kinds, keys, list(others.values()))
        out.append((page_id, url, text, len(text)))

    def settle(last: bool):
        """Finishes the waiting pages whose differing pages after them are known, or all."""
        later: list = []
        left = []
        for row, before in reversed(wait):
            after = [x for x in later if x[0] != row[5]][:SIDE]
            if not row[1]:
                if not last:
                    left.append((row, before))
            elif last or len(after) == SIDE:
                done(row, before, after)
            else:
                left.append((row, before))
            _met(later, row[5], (row[3], row[7]))
        wait[:] = left[::-1]

    def rows():
        got = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _TEXT, strict=True)], schema=_TEXT)
        out.clear()
        return got

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(len(_LINES))), strict=True):
            if (row[0], row[2]) != group:
                settle(True)
                recent.clear()
                group, due = (row[0], row[2]), 8
            if wait and wait[-1][0][5] == row[5]:  # a copy: what it has in common with the page before is held once
                row = (*row[:7], *(old if old == new else new for old, new in zip(wait[-1][0][7:], row[7:], strict=True)))
            wait.append((row, [x for x in recent if x[0] != row[5]][:SIDE]))
            _met(recent, row[5], (row[3], row[7]))
            if len(wait) >= due:
                settle(False)
                due = max(8, 2 * len(wait))
            if len(out) > 500:
                yield rows()
    settle(True)
    if out:
        yield rows()


def extract(pages: DataFrame, ranges: int | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    n = ranges or shuffle_partitions(pages.sparkSession)
    url = F.coalesce(F.col("url"), F.lit(""))
    placed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                          F.lower(F.regexp_extract(url, _ADDRESS, 1)).alias("host"), F.regexp_extract(url, _ADDRESS, 2).alias("path"))
    places = staged(placed.mapInArrow(_places, _PLACES_DDL), "page-places")
    found = places.repartitionByRange(n, "host", "path", "page_id").sortWithinPartitions("host", "path", "page_id", "sig") \
        .mapInArrow(_ends, f"p long, what long, {_PLACES_DDL}").collect()  # a few rows per range
    by_range: dict = {}
    for p, what, *place in found:
        ends = by_range.setdefault(p, {"head": [], "tail": []})
        if what < 2:
            ends["high" if what else "low"] = tuple(place)
        else:
            ends["tail" if what == 3 else "head"].append(tuple(place))
    ranges_found = [by_range[p] for p in sorted(by_range)]
    lines = placed.mapInArrow(partial(_lines, lows=[r["low"][:3] for r in ranges_found], goes=visits(ranges_found)), _LINES_DDL)
    return (lines.repartitionById(n, F.col("range").cast("int")).sortWithinPartitions("range", "host", "path", "page_id", "sig", "own")
            .mapInArrow(_difference, "page_id long, url string, text string, n_chars long"))
