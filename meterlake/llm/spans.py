"""Words of texts, and 64-bit hashes of words and of runs of them, with numpy.

No hash is a sum of its parts: every part is mixed in before the next one, so texts that are
built of two letters in a regular way do not collide by construction, as they would in a
running sum.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np

#: Bytes handled at a time; longer texts are cut at white space.
BLOCK = 1 << 20
#: Bytes of a word that are hashed together with those of other words; longer words are rare.
LONG_WORD = 64

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of each value spread over all bits (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def long_hash(content: bytes) -> int:
    return max(1, int.from_bytes(hashlib.blake2b(content, digest_size=8).digest(), "little"))


def mixed_runs(
    part: Callable[[np.ndarray, np.ndarray], np.ndarray],
    starts: np.ndarray,
    sizes: np.ndarray,
    width: int,
) -> np.ndarray:
    """Hashes of runs of units, ``width`` units at a time; 0 is never a hash.

    ``part(at, count)`` gives the units at some places as one value each.
    """
    hashes = mixed(sizes.astype(np.uint64) * _FACTOR + np.uint64(1))
    live = np.arange(len(starts))
    done = 0
    while live.size:
        rest = sizes[live] - done
        value = part(starts[live] + done, np.minimum(rest, width))
        hashes[live] = mixed(hashes[live] * _FACTOR ^ value)
        done += width
        live = live[rest > width]
    return np.maximum(hashes, 1)


def window_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` values, from those of its halves; never 0."""
    count = max(0, len(values) - length + 1)
    power, width = values, 1
    result, done = np.full(count, length, np.uint64), 0
    while count:
        if length & width:
            result = mixed(result * _FACTOR + power[done : done + count])
            done += width
        if done == length:
            break
        power = mixed(power[:-width] * _FACTOR + power[width:])
        width *= 2
    return np.maximum(result, 1)


def bytes_at(data: bytes) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Up to eight bytes of ``data`` from some places on, as one value each."""
    eight = np.ascontiguousarray(
        np.ndarray((len(data),), "<u8", data + bytes(8), 0, (1,))
    )
    return lambda at, count: eight[at] & _FIRST_BYTES[count]


def word_hashes(data: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The hash of each word ``data[start:stop]``."""
    sizes = stops - starts
    long = np.flatnonzero(sizes > LONG_WORD)
    if not long.size:
        return mixed_runs(bytes_at(data), starts, sizes, 8)
    short = np.flatnonzero(sizes <= LONG_WORD)
    hashes = np.zeros(len(starts), np.uint64)
    hashes[short] = mixed_runs(bytes_at(data), starts[short], sizes[short], 8)
    hashes[long] = [
        long_hash(data[a:b]) for a, b in zip(starts[long].tolist(), stops[long].tolist())
    ]
    return hashes


class WordHasher:
    """Hashes of the words of texts, a word being a run without ASCII white space."""

    def __call__(self, texts: Sequence[str]) -> Iterator[np.ndarray]:
        """For each text the hashes of its words, in order."""
        open_parts: list[np.ndarray] = []
        parts: list[bytes] = []
        ends: list[bool] = []
        size = 0
        for text in texts:
            for part, last in _parts(text.encode()):
                parts.append(part)
                ends.append(last)
                size += len(part)
                if size >= BLOCK:
                    yield from self._block(parts, ends, open_parts)
                    parts, ends, size = [], [], 0
        if parts:
            yield from self._block(parts, ends, open_parts)

    def _block(self, parts, ends, open_parts) -> Iterator[np.ndarray]:
        joined = b"\n".join(parts) + b"\n"
        white = _WHITE[np.frombuffer(joined, np.uint8)]
        edges = np.flatnonzero(white[1:] != white[:-1]) + 1
        if not white[0]:
            edges = np.concatenate([[0], edges])
        starts, stops = edges[0::2], edges[1::2]
        hashes = word_hashes(joined, starts, stops)
        bounds = np.searchsorted(starts, np.cumsum([len(part) + 1 for part in parts]))
        first = 0
        for upto, last in zip(bounds, ends):
            open_parts.append(hashes[first:upto])
            first = upto
            if last:
                yield open_parts[0] if len(open_parts) == 1 else np.concatenate(open_parts)
                open_parts.clear()


def _parts(data: bytes) -> Iterator[tuple[bytes, bool]]:
    """A text in parts of about a block, cut at spaces; and whether a part is the last."""
    at = 0
    while len(data) - at > BLOCK:
        cut = data.find(b" ", at + BLOCK)
        if cut < 0:
            break
        yield data[at:cut], False
        at = cut
    yield data[at:], True
