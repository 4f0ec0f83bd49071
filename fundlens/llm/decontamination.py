"""Benchmark decontamination by pigeonhole edit matching.

Texts and benchmark items are normalised (lower case, runs of letters and digits joined
by one space). An item of ``m`` characters may differ by ``k = floor(error_rate * m)``
edits. It is split into ``k + 1`` pieces of nearly equal length: a passage within ``k``
edits of the item must hold at least one piece unchanged. One Aho-Corasick automaton over
the pieces of all items finds every exact piece hit in a single pass over a text; a hit
fixes where the item would begin. Hits of an item that lie within ``k`` of each other are
one candidate, and Myers' bit-parallel algorithm (one machine operation on the whole item
per text character, in Python integers) verifies it: the smallest edit distance of the
item to any passage of the candidate window. Nothing within the budget is missed.

Items are the stated query set: they are taken in blocks of at most ``block_chars``
characters (one block for any usual benchmark), each block an automaton sent to the tasks
once, and every block meets all documents. Documents are never shuffled, so no key is hot.

Items of fewer than ``min_words`` words (a character of a script without spaces counts as a word) prove less: they
are searched without edits, bounded by words, and their rows say ``short``. Items with a null id are searched like others;
null and empty texts and items match nothing; rows repeating an id are searched
as they stand; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import batch_slices, slices, text_or_empty, to_batch, worker_cache

ERROR_RATE = 0.08
MIN_WORDS = 5
BLOCK_CHARS = 8_000_000

_WORDS = re.compile(r"[^\W_]+")
#: Letters of scripts that set no spaces between words (Thai to Burmese, Khmer, kana, Han).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("budget", pa.int64()),
                    ("span_end", pa.int64()), ("item_chars", pa.int64()), ("short", pa.bool_())])
_FOUND_DDL = "doc_id long, item_id long, distance long, budget long, span_end long, item_chars long, short boolean"


def normalise(text: str) -> str:
    return " ".join(_WORDS.findall(text.lower()))


def _word_count(norm: str) -> int:
    return norm.count(" ") + 1 + max(0, len(_UNSPACED.findall(norm)) - 1)


def _bounded(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` begins and ends with words, as far as its script has spaces."""
    return (start == 0 or text[start - 1] == " " or bool(_UNSPACED.match(text[start]))) and \
        (end == len(text) or text[end] == " " or bool(_UNSPACED.match(text[end - 1])))


def split_pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` (offset, piece) of nearly equal length that make up the item."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def myers(pattern: str, text: str, budget: int) -> tuple[int, int] | None:
    """(distance, end) of the passage of ``text`` nearest to ``pattern``, the first of the best; None beyond ``budget``."""
    m, peq = len(pattern), defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, (budget + 1, 0)
    get = peq.get
    for end, c in enumerate(text, 1):
        eq = get(c, 0)
        across = (((eq & up) + up) ^ up) | eq | down
        plus = down | ~(across | up) & full
        minus = up & across
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus = plus << 1 & full
        minus = minus << 1 & full
        vertical = eq | down
        up = minus | ~(vertical | plus) & full
        down = plus & vertical
        if score < best[0]:
            best = (score, end)
    return best if best[0] <= budget else None


class Matcher:
    """The automaton of a block of items."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_words: int):
        import ahocorasick

        self.items, where = [], defaultdict(list)
        for item_id, text in items:
            norm = normalise(text or "")
            if not norm:
                continue
            short = _word_count(norm) < min_words
            budget = 0 if short else int(error_rate * len(norm))
            for offset, piece in split_pieces(norm, budget):
                where[piece].append((len(self.items), offset + len(piece) - 1))
            self.items.append((item_id, norm, budget, short))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, tuple(uses))
        self.automaton.make_automaton()
        self.some = bool(where)

    def find(self, text: str) -> Iterator[tuple[int | None, int, int, int, int, bool]]:
        """(item_id, distance, budget, end in the normalised text, item's length, short), the best of each item."""
        if not self.some:
            return
        norm, starts = normalise(text), defaultdict(set)
        for end, uses in self.automaton.iter(norm):
            for item, inside in uses:
                start = end - inside
                if not self.items[item][3] or _bounded(norm, start, end + 1):
                    starts[item].add(start)
        for item, found in starts.items():
            item_id, pattern, budget, short = self.items[item]
            best, at = None, sorted(found)
            while at:
                run = 1
                while run < len(at) and at[run] - at[run - 1] <= budget:
                    run += 1
                low = max(0, at[0] - budget)
                hit = myers(pattern, norm[low:at[run - 1] + len(pattern) + budget], budget)
                if hit and (best is None or hit[0] < best[0]):
                    best = (hit[0], low + hit[1])
                at = at[run:]
            if best:
                yield item_id, best[0], budget, best[1], len(pattern), short


def _matcher(items: tuple, error_rate: float, min_words: int) -> Matcher:
    return worker_cache("decontamination", (items, error_rate, min_words), lambda: Matcher(list(items), error_rate, min_words))


def _search(batches, items: tuple, error_rate: float, min_words: int) -> Iterator[pa.RecordBatch]:
    matcher = _matcher(items, error_rate, min_words)
    for cols, texts in slices(batches):
        rows = [(doc_id, *hit) for doc_id, text in zip(cols["doc_id"], texts, strict=True)
                for hit in matcher.find(text)]
        if rows:
            yield to_batch(list(zip(*rows, strict=True)), _FOUND)


def _clean(batches, items: tuple, error_rate: float, min_words: int, short: bool) -> Iterator[pa.RecordBatch]:
    matcher = _matcher(items, error_rate, min_words)
    for part, texts in batch_slices(batches):
        yield part.filter(pa.array([all(hit[-1] and not short for hit in matcher.find(t)) for t in texts], pa.bool_()))


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[tuple]:
    """The items (id, text) in blocks of about ``block_chars`` characters, one at a time; those with null or empty text are left out."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty().alias("text")) \
        .filter(F.length("text") > 0).distinct()
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-chars // block_chars) or 1
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield tuple(sorted(((r["item_id"], r["text"]) for r in own), key=lambda x: (x[0] is None, x[0] or 0, x[1])))


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row per document and benchmark item that it holds within the error budget:
    ``doc_id, item_id, distance, budget, span_end, item_chars, short``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    out = None
    for items in item_blocks(benchmark, block_chars):
        found = texts.mapInArrow(partial(_search, items=items, error_rate=error_rate, min_words=min_words), _FOUND_DDL)
        out = found if out is None else out.unionByName(found)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               block_chars: int = BLOCK_CHARS, short: bool = True) -> DataFrame:
    """``docs``, all columns, without the rows that hold a benchmark item within the error budget; with ``short=False`` those
    that hold only short items stay."""
    for items in item_blocks(benchmark, block_chars):
        docs = docs.mapInArrow(partial(_clean, items=items, error_rate=error_rate, min_words=min_words, short=short), docs.schema)
    return docs
