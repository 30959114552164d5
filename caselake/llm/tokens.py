"""Whole texts to token ids, with a cache of pieces.

A text is cut at blanks, where both tokenizers' own pre-tokenizers cut as well, so the ids of a text are
the ids of its pieces in a row. Each distinct piece is encoded once and looked up afterwards. Texts with other
white space than single blanks and line feeds go through the tokenizer as a whole.

For a byte-level vocabulary no step takes one piece at a time: Arrow cuts the texts and numbers their pieces, new
pieces are joined into runs, and a piece's ids begin at the token that holds its blank. In pieces of common
characters the words are also told apart here, by the tokenizer's own rule, and only merged by the tokenizer.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED_PIECES = 1_000_000
CHARS_AT_ONCE = 2_000_000
BYTE_CHARS_AT_ONCE = 6_000_000  # the pieces known so far are hashed anew for each run
WORDS_AT_ONCE = 5_000
_LETTERS = r"[^\W\d_]+"
# Words of letters, each with at most one mark behind it, on lines of their own.
_PLAIN = re.compile(rf"{_LETTERS}[.,]?(?:\n{_LETTERS}[.,]?)*\Z").match
_PARTS = re.compile(rf"{_LETTERS}|[.,]|\n").findall
# White space that a byte-level tokenizer joins across a piece's own borders. The line feed before a text's first piece is ours.
_ODD = re.compile(r"\A\n?+(?:\Z|\s)|\s\Z").search
_WHOLE = ("",)  # a piece that is never encoded apart
_SEPARATORS = re.compile("[\x1c-\x1f]").search  # blanks to Python, not to the tokenizers
_OTHER, _LETTER, _NUMBER, _MARK, _BLANK, _FEED = range(6)
_KINDS_BELOW = 0x250  # Latin: a byte or two each, and of the same kind in every version of Unicode
_KNOWN_PIECES = pa.array([], pa.large_string())


def _kinds() -> np.ndarray:
    """Kind of each character below U+0280; _OTHER where words are told apart by the tokenizer: white space, controls, apostrophes."""
    kinds = np.full(0x280, _OTHER, np.uint8)
    for code in [*range(0x21, 0x7F), *range(0xA1, _KINDS_BELOW)]:
        kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(code))[0], _MARK)
    kinds[ord("'")], kinds[ord(" ")], kinds[ord("\n")] = _OTHER, _BLANK, _FEED
    return kinds


def _byte_names() -> np.ndarray:
    """Character that stands for each byte in byte-level vocabularies."""
    names = np.zeros(256, np.uint16)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names[shown] = shown
    names[names == 0] = 256 + np.arange(256 - len(shown))
    return names


_KINDS, _BYTE_NAMES = _kinds(), _byte_names()


class _Index(dict):
    """Piece to its number; a new piece gets the next number and is kept for encoding."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key):
        self[key] = number = len(self)
        self.fresh.append(key)
        return number


class PieceEncoder:
    """Encodes lists of texts with a byte-level vocabulary (a blank belongs to the next word) or one with word ends."""

    def __init__(self, file: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(file)
        # A text that spells a special token is encoded as a whole, so that the token is found as the library finds it.
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        vocabulary = self.tokenizer.get_vocab()
        self.names = [""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            self.names[number] = name
        self.byte_level = not any(n.endswith("</w>") for n in self.names)
        self.word_edge = np.array([n.startswith("Ġ") if self.byte_level else n.endswith("</w>") for n in self.names])
        cutter = self.tokenizer.pre_tokenizer
        self.merger = None  # merges words that are cut already and spelled in the vocabulary's characters
        if self.tokenizer.normalizer is None and isinstance(cutter, pre_tokenizers.ByteLevel) and cutter.use_regex and not cutter.add_prefix_space:
            self.merger = Tokenizer.from_file(file)
            self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self._clear()

    def _clear(self) -> None:
        self.index, self.words = _Index(), {}
        self.known, self.first = _KNOWN_PIECES, np.zeros(0, bool)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.bad = np.zeros(0, np.uint32), np.zeros(0, bool)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _run(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of words encoded as one text, with each word's start and count; None where they can't be told apart."""
        ids = self.whole(" ".join(words))
        bounds = np.append(0, np.flatnonzero(self.word_edge[ids]) + 1)
        return (ids, bounds[:-1], np.diff(bounds)) if len(bounds) - 1 == len(words) else None

    def _learn_words(self, words: set[str]) -> None:
        bare = [w for w in words if w.isalpha()]
        rest = list(words.difference(bare))
        for low in range(0, len(bare), WORDS_AT_ONCE):
            run = bare[low:low + WORDS_AT_ONCE]
            if (found := self._run(run)) is None:
                rest += run
                continue
            raw = found[0].tobytes()
            self.words.update(zip(run, (raw[a:z] for a, z in zip((4 * found[1]).tolist(), (4 * (found[1] + found[2])).tolist()))))
        for low in range(0, len(rest), WORDS_AT_ONCE):
            run = rest[low:low + WORDS_AT_ONCE]
            for w, found in zip(run, self.tokenizer.encode_batch_fast(run, add_special_tokens=False)):
                self.words[w] = np.array(found.ids, np.uint32).tobytes()

    def _parts(self, key) -> tuple[str, ...]:
        """What of a piece is encoded apart; nothing where the pieces around it may not be encoded apart."""
        # Lower case may turn one letter into a letter and a mark, which belongs to what follows.
        return () if key.__class__ is tuple else tuple(_PARTS(key)) if _PLAIN(key) and _PLAIN(key.lower()) else (key,)

    def _learn(self) -> None:
        fresh, self.index.fresh = self.index.fresh, []
        if not fresh:
            return
        parts = [self._parts(k) for k in fresh]
        self._learn_words({p for ps in parts for p in ps if p not in self.words})
        get = self.words.__getitem__
        found = [get(ps[0]) if len(ps) == 1 else b"".join(map(get, ps)) for ps in parts]
        sizes = np.array(list(map(len, found))) // 4
        self._keep(np.frombuffer(b"".join(found), np.uint32), len(self.flat) + np.cumsum(sizes) - sizes, sizes, np.array([not ps for ps in parts]))

    def _keep(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bad: np.ndarray) -> None:
        self.starts = np.append(self.starts, starts)
        self.sizes = np.append(self.sizes, sizes)
        self.flat = np.append(self.flat, flat)
        self.bad = np.append(self.bad, bad)

    def _joined(self, tokenizer, text: str, count: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of some pieces with a blank before each, and each piece's count; None where they can't be told apart."""
        if any(map(text.__contains__, self.special)):
            return None
        ids = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        edges = np.flatnonzero(self.word_edge[ids])
        return (ids, np.diff(np.append(edges, len(ids)))) if len(edges) == count and edges[0] == 0 else None

    def _learn_common(self, pieces: pa.LargeStringArray) -> tuple[list, np.ndarray]:
        """Ids of the pieces of common characters, a run at a time with each piece's count; which pieces these are."""
        bounds = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        raw = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        raw = np.insert(raw, bounds[:-1] - bounds[0], np.uint8(ord(" ")))
        lengths = np.diff(bounds) + 1
        kinds = np.where(raw < 0x80, _KINDS[raw], np.uint8(_OTHER))
        two = np.flatnonzero((raw >= 0xC2) & (raw <= 0xC9))
        kinds[two] = kinds[two + 1] = _KINDS[((raw[two] & 0x1F).astype(np.int64) << 6) | (raw[two + 1] & 0x3F)]
        after = np.append(kinds[1:], np.uint8(_BLANK))
        fault = (kinds == _OTHER) | ((kinds >= _BLANK) & (after == _BLANK)) | ((kinds == _FEED) & (after == _FEED))
        common = ~np.logical_or.reduceat(fault, np.cumsum(lengths) - lengths)
        inside = np.repeat(common, lengths)
        raw, kinds, lengths = raw[inside], kinds[inside], lengths[common]
        before = np.append(np.uint8(_FEED), kinds[:-1])
        begins = (kinds != before) & ~((before == _BLANK) & (kinds < _BLANK))
        ends, runs = np.append(0, np.cumsum(lengths)), []
        for low in range(0, len(lengths), WORDS_AT_ONCE):
            count = min(WORDS_AT_ONCE, len(lengths) - low)
            some = slice(ends[low], ends[low + count])
            spelled = np.insert(_BYTE_NAMES[raw[some]], np.flatnonzero(begins[some]), np.uint16(ord("\n")))
            text = spelled.astype("<u2").tobytes().decode("utf-16-le")
            if (found := self._joined(self.merger, text, count)) is None:
                return [], np.zeros(len(pieces), bool)
            runs.append(found)
        return runs, common

    def _learn_pieces(self, pieces: pa.LargeStringArray) -> None:
        """Encode new pieces; a line feed in front marks a text's first piece, which has no blank before it."""
        runs, common = self._learn_common(pieces) if self.merger else ([], np.zeros(len(pieces), bool))
        others = pieces.filter(pa.array(~common)).to_pylist()
        odd = np.array([_ODD(p) is not None for p in others], bool)
        whole = [p for p, o in zip(others, odd.tolist()) if not o]
        for low in range(0, len(whole), WORDS_AT_ONCE):
            run = whole[low:low + WORDS_AT_ONCE]
            if (found := self._joined(self.tokenizer, " " + " ".join(run), len(run))) is None:
                alone = [self.whole(" " + p) for p in run]
                found = np.concatenate(alone), np.array(list(map(len, alone)))
            runs.append(found)
        rest = np.flatnonzero(~common)
        place = np.argsort(np.concatenate([np.flatnonzero(common), rest[~odd], rest[odd]]))
        sizes = np.concatenate([*(r[1] for r in runs), np.zeros(odd.sum(), np.int64)])
        starts, sizes = (len(self.flat) + np.cumsum(sizes) - sizes)[place], sizes[place]
        bad = np.zeros(len(pieces), bool)
        bad[rest[odd]] = True
        first = np.array(pc.starts_with(pieces, "\n"))
        drop = 2 * (first & ~bad)  # a blank and a line feed make two tokens of their own before a first piece
        self.first = np.append(self.first, first)
        self._keep(np.concatenate([np.zeros(0, np.uint32), *(r[0] for r in runs)]), starts + drop, sizes - drop, bad)

    def _numbered(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the texts' pieces, their count in each text, and which of them may not be encoded apart."""
        marked = pa.array(["" if any(map(t.__contains__, self.special)) else "\n" + t for t in texts], pa.large_string())
        pieces = pc.split_pattern(marked, " ")
        counts = np.array(pc.list_value_length(pieces), np.int64)
        # The known pieces go first and so keep their numbers.
        found = pa.concat_arrays([self.known, pieces.flatten()]).dictionary_encode()
        if (fresh := found.dictionary[len(self.known):]):
            self._learn_pieces(fresh)
        rows = np.array(found.indices)[len(self.known):]
        self.known = found.dictionary
        inner = np.ones(len(rows), bool)
        inner[np.cumsum(counts) - counts] = False
        return rows, counts, self.bad[rows] | (inner & self.first[rows])

    def _some(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        if max(len(self.index), len(self.known)) > CACHED_PIECES:
            self._clear()
        if self.byte_level:
            rows, counts, bad = self._numbered(texts)
        else:
            get, rows, counts = self.index.__getitem__, [], []
            for text in texts:
                if any(map(text.__contains__, self.special)):
                    pieces = [_WHOLE]
                else:
                    pieces = [(text,)] if _SEPARATORS(text) else text.split()
                rows.extend(map(get, pieces))
                counts.append(len(pieces))
            self._learn()
            rows = np.array(rows, np.int64)
            bad = self.bad[rows]
        ends = np.cumsum(counts)
        sizes = self.sizes[rows]
        total = np.concatenate([[0], np.cumsum(sizes)])
        flat = self.flat[np.repeat(self.starts[rows] - total[:-1], sizes) + np.arange(total[-1])]
        lengths = np.diff(total[ends], prepend=0)
        apart = np.unique(np.searchsorted(ends, np.flatnonzero(bad), side="right"))
        if len(apart):
            parts = np.split(flat, np.cumsum(lengths)[:-1])
            for i in apart:
                parts[i] = self.whole(texts[i])
                lengths[i] = len(parts[i])
            flat = np.concatenate(parts)
        return flat, lengths

    def encode(self, texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Yield (number of the first text, ids of some texts in a row, their counts), a bounded run at a time."""
        low, size = 0, 0
        for high, text in enumerate(texts):
            size += len(text or "")
            if size >= (BYTE_CHARS_AT_ONCE if self.byte_level else CHARS_AT_ONCE) or high == len(texts) - 1:
                yield (low, *self._some([t or "" for t in texts[low:high + 1]]))
                low, size = high + 1, 0


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(file: str) -> PieceEncoder:
    """One encoder per file and Python worker; its cache serves the worker's later tasks too."""
    if file not in _ENCODERS:
        _ENCODERS[file] = PieceEncoder(file)
    return _ENCODERS[file]


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append ``end`` to each text's ids."""
    return np.insert(ids, np.cumsum(lengths), np.uint32(end)), lengths + 1
