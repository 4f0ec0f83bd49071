"""Fill-in-the-middle transformation by secondary sort.

A text is cut into units (lines with their line break); a prefix ends after the smaller and a
middle after the larger of two unit numbers drawn from a hash of the document's id, the rest is
the suffix. The output puts the marked segments in the order of the document's form: ``psm``
``<P>prefix<S>suffix<M>middle``, ``spm`` ``<S>suffix<P>prefix<M>middle``, or ``plain``, the text.

1. ``pieces`` emits each document as pieces keyed by document and output position: runs of
   whole units of one segment up to ``chunk`` characters (a longer unit is divided), each
   segment's marker before its first piece.
2. ``assembled`` deals the pieces out by document and sorts them within the partitions
   by output position (repartition and sort within partitions: the secondary sort). One
   pass streams them into a digest of the output, which never exists as a whole.
3. The same pass reads the markers and gives each piece its place in the original text.
   ``restored`` sorts the partitions again by that place, without another shuffle, and
   a second pass streams the pieces into the digest of the restored text.

Every document has a key of its own (its place in the scanned table), so equal ids, equal texts or
one id on a third of all rows neither mix nor meet in one task, and a document of any length is a run of
pieces. The input should be a table or file scan, whose rows a retried task sees in the
same order. Null text counts as empty, a null id is hashed as an empty one, repeated rows
are returned each, an empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import slices, text_or_empty, to_batch

MARKS = {"prefix": "<P>", "suffix": "<S>", "middle": "<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
SEED = 7
RATE = 100
SPM_RATE = 50
#: Characters of a piece; the only thing that is held of a document while it is assembled.
CHUNK = 8_192
#: Rows that a task hands on at once at most, and characters.
_ROWS, _CHARS = 4096, 2_000_000

_PLACE = {"<P>": 0, "<M>": 1, "<S>": 2}  # of a segment in the original text
_PIECES = pa.schema([("key", pa.int64()), ("pos", pa.int64()), ("last", pa.bool_()), ("doc_id", pa.int64()), ("n", pa.int64()),
                     ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("text", pa.string())])
_OUTPUT = pa.schema([("key", pa.int64()), ("place", pa.int32()), ("pos", pa.int64()), ("text", pa.string()), ("doc_id", pa.int64()),
                     ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                     ("output_sha256", pa.string())])
_DIGESTS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                      ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_DDL = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_DDL[f.type]}" for f in schema)


def draws(doc_id, seed: int = SEED) -> list[int]:
    """Four 32-bit numbers of a document id."""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def unit_ends(text: str) -> list[int]:
    """Where each line, with its line break, ends."""
    ends, at = [], text.find("\n")
    while at >= 0:
        ends.append(at + 1)
        at = text.find("\n", at + 1)
    if text and not text.endswith("\n"):
        ends.append(len(text))
    return ends


def plan(doc_id, text: str, ends: list[int], seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[str, int, int]:
    """(form, units of the prefix, units up to the end of the middle)."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    lo, hi = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    if not text or h3 % 100 >= rate or any(m in text for m in MARKS.values()):
        return "plain", 0, 0
    return ("spm" if h4 % 100 < spm_rate else "psm"), lo, hi


def _runs(ends: list[int], lo: int, hi: int, chunk: int) -> Iterator[tuple[int, int]]:
    """Units ``lo`` to ``hi`` as spans of at most ``chunk`` characters: whole units while they fit."""
    start = end = ends[lo - 1] if lo else 0
    for stop in ends[lo:hi]:
        if stop - start > chunk and end > start:
            yield start, end
            start = end
        while stop - start > chunk:
            yield start, start + chunk
            start += chunk
        end = stop
    if end > start:
        yield start, end


def _emit(batches: Iterator[pa.RecordBatch], seed: int, rate: int, spm_rate: int, chunk: int) -> Iterator[pa.RecordBatch]:
    rows, chars = [], 0
    for cols, texts in slices(batches):
        for key, doc_id, text in zip(cols["key"], cols["doc_id"], texts, strict=True):
            ends = unit_ends(text)
            form, lo, hi = plan(doc_id, text, ends, seed, rate, spm_rate)
            cut = [0, *ends]
            sizes = (None, None) if form == "plain" else (cut[lo], cut[hi] - cut[lo])
            bounds = {"prefix": (0, lo), "middle": (lo, hi), "suffix": (hi, len(ends))}
            segments = [("", 0, len(ends))] if form == "plain" else [(MARKS[s], *bounds[s]) for s in ORDERS[form]]
            spans = [(mark if i == 0 else "", a, b) for mark, u, v in segments
                     for i, (a, b) in enumerate([*_runs(ends, u, v, chunk)] or [(0, 0)])]
            for pos, (mark, a, b) in enumerate(spans):
                rows.append((key, pos, pos == len(spans) - 1, doc_id, len(ends), form, *sizes, mark + text[a:b]))
                chars += b - a
                if len(rows) >= _ROWS or chars >= _CHARS:
                    yield to_batch(list(zip(*rows, strict=True)), _PIECES)
                    rows, chars = [], 0
    if rows:
        yield to_batch(list(zip(*rows, strict=True)), _PIECES)


def pieces(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE, chunk: int = CHUNK) -> DataFrame:
    """Every document's output as pieces ``key, pos, last, doc_id, n, form, prefix_chars, middle_chars, text``;
    the texts of a ``key`` in the order of ``pos`` are its output."""
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
                        text_or_empty().alias("text"))
    return keyed.mapInArrow(partial(_emit, seed=seed, rate=rate, spm_rate=spm_rate, chunk=chunk), _ddl(_PIECES))


def _encoded(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The batch's rows, their text as the last item."""
    return zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces in, the same pieces with their place in the original text out; the output's
    digest goes out with the last piece of a document."""
    key = digest = place = None
    for batch in batches:
        out = []
        for row_key, pos, last, doc_id, n, form, prefix, middle, text in _encoded(batch):
            if row_key != key or pos == 0:
                if pos or digest is not None:
                    raise ValueError(f"document {doc_id}: a piece is missing before position {pos}")
                key, digest, place, next_pos = row_key, hashlib.sha256(), 0, 0
            if pos != next_pos:
                raise ValueError(f"document {doc_id}: position {next_pos} is missing")
            next_pos += 1
            digest.update(text.encode())
            if form != "plain" and text[:3] in _PLACE:
                place, text = _PLACE[text[:3]], text[3:]
            done = digest.hexdigest() if last else None
            out.append((key, place, pos, text, doc_id, n, form, prefix, middle, done))
            if last:
                digest = None
        if out:
            yield to_batch(list(zip(*out, strict=True)), _OUTPUT)
    if digest is not None:
        raise ValueError("the last document is not complete")


def assembled(made: DataFrame) -> DataFrame:
    """The pieces by document in output order, with ``place`` (segment) in the original text and, on
    each document's last piece, ``output_sha256``."""
    return made.repartition("key").sortWithinPartitions("key", "pos").mapInArrow(_assemble, _ddl(_OUTPUT))


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = digest = row = None
    for batch in batches:
        out = []
        for row_key, _, _, text, *about, output_sha256 in _encoded(batch):
            if row_key != key:
                if key is not None:
                    out.append((*row, digest.hexdigest()))
                key, digest, row = row_key, hashlib.sha256(), None
            digest.update(text.encode())
            if output_sha256 is not None:
                row = (*about, output_sha256)
        if out:
            yield to_batch(list(zip(*out, strict=True)), _DIGESTS)
    if key is not None:
        yield to_batch(list(zip((*row, digest.hexdigest()), strict=True)), _DIGESTS)


def restored(output: DataFrame) -> DataFrame:
    """The digests of every document's output and of the text rebuilt from its pieces and form."""
    return output.sortWithinPartitions("key", "place", "pos").mapInArrow(_restore, _ddl(_DIGESTS))


def restore_text(output: str, form: str) -> str:
    """The original text of one whole output."""
    if form == "plain":
        return output
    marks = [MARKS[s] for s in ORDERS[form]]
    at = [output.index(m) for m in marks]
    parts = {m: output[a + len(m):b] for m, a, b in zip(marks, at, [*at[1:], len(output)], strict=True)}
    return parts["<P>"] + parts["<M>"] + parts["<S>"]


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE,
                   chunk: int = CHUNK) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of each document."""
    return restored(assembled(pieces(docs, seed, rate, spm_rate, chunk)))
