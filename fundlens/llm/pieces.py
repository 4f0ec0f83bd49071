"""Whole texts encoded by the tokenizers library, each distinct piece once per worker.

Both vocabularies split a text before merging: no token spans a border between a
character that is not white space and the white space after it, nor one between a
letter and an ASCII sign other than the apostrophe after it, nor one after a single line
feed. A text is cut at such borders only, every distinct piece is encoded by the library,
and the results are put together in order, which gives the ids of the whole text (checked
in the tests against whole texts). Pieces of Latin letters go to the library's merge model
directly, by the byte alphabet of byte-level vocabularies; any other piece passes its whole
chain (normalisation, splitting, merges). Strings of added tokens in a text become that
token, as the library has it by default, and the text is cut there first.

The piece table of a worker holds at most about ``MAX_PIECES`` pieces, ``MAX_CHARS`` characters
and as many ids, and what one slice of texts adds; beyond, pieces used once are forgotten
(and encoded anew if they come again), so memory is bounded whatever the corpus holds,
texts without spaces too, of which a piece can be a whole text.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from fundlens.llm.common import release_memory, worker_cache

MAX_PIECES = 900_000
MAX_CHARS = 10_000_000
#: Characters of text that are encoded at once: the arrays of a slice take some 15 times as many bytes.
ENCODE_CHARS = 1_000_000

_SPACE = r"[^\S\x1c-\x1f]"
_INK = r"[\S\x1c-\x1f]"
#: Latin letters up to U+024F, without the signs for times and division and the dotted capital I, whose
#: lower case ends in a combining mark that would join a sign after it.
_LETTER = r"[A-Za-zÀ-ÖØ-öø-įı-ɏ]"
_SIGN = r"[!-&(-/:-@\[-`{-~]"
_ENDS = rf"(?={_SIGN}*(?:{_SPACE}|\Z))"
_KEEP_SPACE = re.compile(rf" ?{_LETTER}+{_ENDS}|{_SIGN}+(?={_SPACE}|\Z)|(?<!{_SPACE})\n(?={_INK})|{_SPACE}*{_INK}+|{_SPACE}+")
_DROP_SPACE = re.compile(rf"{_LETTER}+{_ENDS}|{_SIGN}+(?={_SPACE}|\Z)|{_INK}+")
_WORD = re.compile(rf" ?{_LETTER}+")


def byte_alphabet() -> dict[int, str]:
    """The printable character of each byte in byte-level vocabularies, by its rule:
    visible Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)}


class PieceEncoder(dict):
    """piece -> number; ``ids_of`` gives the token ids of whole texts."""

    def __init__(self, path: str, max_pieces: int = MAX_PIECES, max_chars: int = MAX_CHARS):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Strings of added tokens in a text are that token to the library; it splits the text there first.
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = sorted((t.content for t in added), key=len, reverse=True)
        self.added_cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")")
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError(f"{path}: added tokens that are matched in context are not supported")
        self.model, self.normalizer = self.tokenizer.model, self.tokenizer.normalizer
        self.drops_space = self.normalizer is not None
        self.cut = _DROP_SPACE if self.drops_space else _KEEP_SPACE
        self.max_pieces, self.max_chars, self.chars = max_pieces, max_chars, 0
        self.alphabet = byte_alphabet()
        self.space = self.alphabet[32]
        self.start, self.size, self.flat, self.uses = array("i"), array("i"), array("i"), np.zeros(0, np.int64)

    def encode_piece(self, piece: str) -> list[int]:
        """The library's ids of a piece. Letters are lower-cased here where the vocabulary does
        (single letters up to U+024F need no normalisation)."""
        if _WORD.fullmatch(piece):
            plain = piece.lower() if self.drops_space else piece
            if not plain.isascii():
                plain = "".join(map(self.alphabet.__getitem__, plain.encode()))
            elif plain[0] == " ":
                plain = self.space + plain[1:]
            return [t.id for t in self.model.tokenize(plain)]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def add(self, ids) -> int:
        self.start.append(len(self.flat))
        self.size.append(len(ids))
        self.flat.extend(ids)
        return len(self.start) - 1

    def __missing__(self, piece: str) -> int:
        k = self[piece] = self.add(self.encode_piece(piece))
        self.chars += len(piece)
        return k

    def forget(self) -> None:
        """Keep the pieces used more than once, at most half of each bound, most used first."""
        uses, chars = np.zeros(len(self.start), np.int64), np.zeros(len(self.start), np.int64)
        uses[:len(self.uses)] = self.uses
        for piece, k in self.items():
            chars[k] = len(piece)
        kept = np.flatnonzero((uses > 1) & (chars > 0))  # the end ids of each call are no pieces
        kept = kept[np.argsort(-uses[kept], kind="stable")[:self.max_pieces // 2]]
        weight = np.maximum(chars, np.frombuffer(self.size, np.int32))[kept]
        kept = np.sort(kept[np.cumsum(weight) <= self.max_chars // 2])
        self.chars = int(chars[kept].sum())
        start, size, flat = self.start, self.size, self.flat
        self.start, self.size, self.flat, self.uses = array("i"), array("i"), array("i"), uses[kept]
        new = {k: self.add(flat[start[k]:start[k] + size[k]]) for k in kept.tolist()}
        held = [(piece, new[k]) for piece, k in self.items() if k in new]
        self.clear()
        self.update(held)
        del held, new, start, size, flat
        release_memory()

    def ids_of(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each with ``end_id`` last; ids per text)."""
        if len(self.start) > self.max_pieces or max(self.chars, len(self.flat)) > self.max_chars:
            self.forget()
        numbers, per_text, end, find, of = [], [], self.add([end_id]), self.cut.findall, self.__getitem__
        for text in texts:
            pieces = find(text)
            for mark in self.added:
                if mark in text:
                    parts = self.added_cut.split(text)  # every second part is an added token
                    pieces = [p for i, part in enumerate(parts) for p in ([part] if i % 2 else find(part))]
                    break
            numbers.extend(map(of, pieces))
            numbers.append(end)
            per_text.append(len(pieces) + 1)
        k = np.fromiter(numbers, np.int64, len(numbers))
        start, size = np.frombuffer(self.start, np.int32), np.frombuffer(self.size, np.int32)
        flat = np.frombuffer(self.flat, np.int32)
        uses = np.bincount(k, minlength=len(start))
        uses[:len(self.uses)] += self.uses
        self.uses = uses
        sizes = size[k]
        ends = np.cumsum(sizes, dtype=np.int32)  # a slice of texts has far fewer ids than 2**31
        total = int(ends[-1]) if len(k) else 0
        place = np.repeat(start[k] - ends + sizes, sizes)
        place += np.arange(total, dtype=np.int32)
        return flat[place], np.diff(ends[np.cumsum(per_text, dtype=np.int64) - 1].astype(np.int64), prepend=0) if len(texts) else ends


def encoder(path: str, max_pieces: int = MAX_PIECES) -> PieceEncoder:
    """The worker's encoder of a vocabulary file; kept between the tasks of operators that encode."""
    return worker_cache("pieces", (path, max_pieces), lambda: PieceEncoder(path, max_pieces))
