"""Texts cut into the pieces of a byte-level tokenizer, a block of documents at a time.

Cutting and looking up work on whole blocks with numpy; only pieces that a worker has not
met yet are handed, as text, to an encoder.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np

from meterlake.llm.spans import long_hash, mixed_runs

#: Characters of a block; a longer text is cut where two pieces meet.
BLOCK = 1 << 19
#: Places of the table of known pieces, and the pieces after which it starts anew.
SLOTS = 1 << 22
MOST_PIECES = 1 << 20
#: Characters of a piece that is found by hash; a longer one is found by its text.
LONG_PIECE = 48
#: Ids, and characters of long pieces, after which the table starts anew.
MOST_IDS = 1 << 23

END, LETTER, NUMBER, OTHER, WHITE, SPACE = range(6)
_BETWEEN_WORDS = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_LAST = 0x110000
#: Code points, of 21 bits each, that make up one value.
_WIDTH = 3
_FIRST_CODES = np.array([(1 << 21 * i) - 1 for i in range(_WIDTH + 1)], dtype=np.uint64)

Encode = Callable[[list[str]], list[Sequence[int]]]


def every_character() -> str:
    return "".join(map(chr, (*range(0xD800), *range(0xE000, _LAST))))


def class_table(letters: str, numbers: str, white: str) -> np.ndarray:
    """The class of each code point, from the characters a tokenizer library puts in each."""
    table = np.full(_LAST, OTHER, dtype=np.uint8)
    for text, kind in ((letters, LETTER), (numbers, NUMBER), (white, WHITE)):
        table[_codes(text)] = kind
    table[0x20] = SPACE
    return table


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def codes_at(codes: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Up to three code points from some places on, as one value each."""
    wide = codes.astype(np.uint64)
    three = wide.copy()
    three[:-1] |= wide[1:] << np.uint64(21)
    three[:-2] |= wide[2:] << np.uint64(42)
    return lambda at, count: three[at] & _FIRST_CODES[count]


def piece_starts(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where pieces start; an END character is a piece of its own.

    The rules of the public pattern: an apostrophe with s, t, m, d, re, ve or ll; runs of
    letters, of numbers and of other signs, each with one space before it; white space up
    to the last character before such a run.
    """
    before = np.empty_like(classes)
    before[0], before[1:] = END, classes[:-1]
    after = np.empty_like(classes)
    after[-1], after[:-1] = END, classes[1:]
    white, white_before = classes >= WHITE, before >= WHITE
    starts = np.where(
        white,
        ~white_before | ((after < WHITE) & (after != END)),
        (classes != before) & (before != SPACE),
    )
    starts |= classes == END
    quotes = np.flatnonzero(starts & (codes == 0x27) & (after == LETTER))
    if quotes.size:
        padded = np.concatenate([codes, np.zeros(2, codes.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(one, _codes("stmd"))
        long = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e")))
        long |= (one == ord("l")) & (two == ord("l"))
        for places, length in ((quotes[short], 2), (quotes[long], 3)):
            starts[places + 1] = False
            rest = places + length
            rest = rest[rest < len(codes)]
            starts[rest[classes[rest] == LETTER]] = True
    return np.flatnonzero(starts)


class _Growing:
    """An array that grows at its end."""

    def __init__(self, values: Sequence[int], kind: type) -> None:
        self._data = np.array(values, dtype=kind)
        self.size = len(self._data)

    def extend(self, values: np.ndarray) -> None:
        upto = self.size + len(values)
        if upto > len(self._data):
            grown = np.empty(max(upto, 2 * len(self._data)), self._data.dtype)
            grown[: self.size] = self._data[: self.size]
            self._data = grown
        self._data[self.size : upto] = values
        self.size = upto

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self._data[at]


class Pieces:
    """Ids of the pieces met so far.

    A piece is found by its hash and then compared, code point by code point, with the piece
    that was met under that hash; so ids never depend on a hash being without collisions.
    Strings in ``added`` are pieces of their own wherever they stand, and the text around
    one is cut as if it ended there.
    """

    def __init__(
        self,
        encode: Encode,
        classes: np.ndarray,
        end_ids: Sequence[int] = (),
        added: Sequence[str] = (),
    ) -> None:
        self._encode = encode
        self._classes = classes
        self._end_ids = list(end_ids)
        longest_first = sorted(added, key=len, reverse=True)
        self._added = re.compile("|".join(map(re.escape, longest_first))) if added else None
        self._forget()

    def _forget(self) -> None:
        self._known = np.zeros(SLOTS, dtype=np.uint64)
        self._entry = np.zeros(SLOTS, dtype=np.int32)
        self._ids = _Growing(self._end_ids, np.uint32)
        self._start = _Growing([0], np.int64)
        self._count = _Growing([len(self._end_ids)], np.int64)
        self._size = _Growing([0], np.int64)
        self._first_part = _Growing([0], np.int64)
        self._parts = _Growing([], np.uint64)
        self._long: dict[str, int] = {}
        self._long_size = 0

    def encode(self, texts: Sequence[str]) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
        """For each text in order: its number, whether this is its end, ids, piece hashes.

        A very long text comes in several parts, of which the last says so.
        """
        for numbers, whole, parts in _blocks(texts):
            text = "\0".join(parts) + "\0"
            codes = _codes(text)
            ends_at = np.cumsum([len(part) + 1 for part in parts]) - 1
            starts = self._cut(text, codes, ends_at)
            last = np.searchsorted(starts, ends_at)
            sizes = np.diff(starts, append=len(codes))
            sizes[last] = 0
            entries, hashes = self._find(text, codes, starts, sizes)
            counts = self._count[entries]
            counts[last[~np.array(whole)]] = 0
            total = np.cumsum(counts)
            shift = self._start[entries] - (total - counts)
            ids = self._ids[np.repeat(shift, counts) + np.arange(total[-1])]
            first_piece, first_id = 0, 0
            for number, ended, piece, upto in zip(numbers, whole, last, total[last]):
                yield number, ended, ids[first_id:upto], hashes[first_piece:piece]
                first_piece, first_id = piece + 1, upto

    def _cut(self, text: str, codes: np.ndarray, ends_at: np.ndarray) -> np.ndarray:
        classes = self._classes[codes]
        classes[ends_at] = END
        found = [m.span() for m in self._added.finditer(text)] if self._added else []
        for start, end in found:
            classes[start:end] = END
        starts = piece_starts(codes, classes)
        if not found:
            return starts
        inside = np.zeros(len(codes), bool)
        for start, end in found:
            inside[start + 1 : end] = True
        return starts[~inside[starts]]

    def _find(
        self, text: str, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Entry and hash of each piece; the end of a text, of size 0, is entry 0."""
        if (
            self._count.size > MOST_PIECES
            or self._ids.size > MOST_IDS
            or self._long_size > MOST_IDS
        ):
            self._forget()
        entries = np.zeros(len(starts), np.int64)
        hashes = np.zeros(len(starts), np.uint64)
        part = codes_at(codes)
        short = np.flatnonzero((sizes > 0) & (sizes <= LONG_PIECE))
        hashes[short] = mixed_runs(part, starts[short], sizes[short], _WIDTH)
        found, slots = self._look_up(hashes[short])
        same = self._same(part, starts[short], sizes[short], found)
        entries[short] = found
        new = short[~same]
        if new.size:
            _, where, back = np.unique(hashes[new], return_index=True, return_inverse=True)
            numbers = self._learn(text, part, starts[new[where]], sizes[new[where]])
            entries[new] = numbers[back]
            at = slots[~same][where]
            self._known[at] = hashes[new[where]]
            self._entry[at] = numbers
            other = new[~self._same(part, starts[new], sizes[new], entries[new])]
            if other.size:  # another new piece has the same hash
                entries[other] = self._learn(text, part, starts[other], sizes[other])
        for place in np.flatnonzero(sizes > LONG_PIECE).tolist():
            entries[place], hashes[place] = self._find_long(
                text[starts[place] : starts[place] + sizes[place]]
            )
        return entries, hashes

    def _look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The entry known under each hash, 0 where there is none, and where to put a new one."""
        mask = np.uint64(SLOTS - 1)
        first = (hashes & mask).astype(np.int64)
        entries = np.where(self._known[first] == hashes, self._entry[first], 0).astype(np.int64)
        slots = first
        rest = np.flatnonzero(entries == 0)
        if rest.size:
            second = ((hashes[rest] >> np.uint64(24)) & mask).astype(np.int64)
            known = self._known[second] == hashes[rest]
            entries[rest] = np.where(known, self._entry[second], 0)
            slots[rest] = np.where(self._known[first[rest]] == 0, first[rest], second)
        return entries, slots

    def _same(self, part, starts: np.ndarray, sizes: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Whether each piece consists of the code points of its entry."""
        same = self._size[entries] == sizes
        first = self._first_part[entries]
        live = np.flatnonzero(same)
        done = 0
        while live.size:
            rest = sizes[live] - _WIDTH * done
            value = part(starts[live] + _WIDTH * done, np.minimum(rest, _WIDTH))
            equal = self._parts[first[live] + done] == value
            same[live[~equal]] = False
            live = live[equal & (rest > _WIDTH)]
            done += 1
        return same

    def _learn(self, text: str, part, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Encode pieces and remember them; returns their entries."""
        words = [text[s : s + n] for s, n in zip(starts.tolist(), sizes.tolist())]
        numbers = self._add(words)
        parts = -(-sizes // _WIDTH)
        total = np.cumsum(parts)
        step = _WIDTH * (np.arange(total[-1]) - np.repeat(total - parts, parts))
        rest = np.minimum(np.repeat(sizes, parts) - step, _WIDTH)
        self._first_part.extend(self._parts.size + total - parts)
        self._size.extend(sizes)
        self._parts.extend(part(np.repeat(starts, parts) + step, rest))
        return numbers

    def _add(self, words: list[str]) -> np.ndarray:
        found = self._encode(words)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        numbers = np.arange(self._count.size, self._count.size + len(words))
        self._start.extend(self._ids.size + np.cumsum(counts) - counts)
        self._count.extend(counts)
        self._ids.extend(np.fromiter(chain.from_iterable(found), np.uint32, counts.sum()))
        return numbers

    def _find_long(self, word: str) -> tuple[int, int]:
        if word not in self._long:
            self._long[word] = int(self._add([word])[0])
            self._first_part.extend(np.zeros(1, np.int64))
            self._size.extend(np.zeros(1, np.int64))  # equal to no piece found by hash
            self._long_size += len(word)
        return self._long[word], long_hash(word.encode())


def _blocks(texts: Sequence[str]) -> Iterator[tuple[list[int], list[bool], list[str]]]:
    """Texts in blocks of about ``BLOCK`` characters: numbers, whether whole, parts."""
    numbers: list[int] = []
    whole: list[bool] = []
    parts: list[str] = []
    size = 0
    for number, text in enumerate(texts):
        at = 0
        while True:
            cut = _BETWEEN_WORDS.search(text, at + BLOCK) if len(text) - at > BLOCK else None
            upto = cut.start() if cut else len(text)
            numbers.append(number)
            whole.append(cut is None)
            parts.append(text[at:upto])
            size += upto - at + 1
            at = upto
            if size >= BLOCK:
                yield numbers, whole, parts
                numbers, whole, parts, size = [], [], [], 0
            if cut is None:
                break
    if parts:
        yield numbers, whole, parts
