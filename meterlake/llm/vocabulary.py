"""Public tokenizers as functions from pieces to ids. Files are given by path, never copied."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Sequence

import numpy as np
import public_tokenizers

from meterlake.llm.merges import MergeReplay
from meterlake.llm.pieces import Pieces, class_table, every_character

_CLASSES = (r"\p{L}", r"\p{N}", r"\s")
#: Words handed to the tokenizers library at a time: it returns far more than the ids of each.
WORDS_AT_A_TIME = 4096


def _matched_by_tiktoken(pattern: str) -> str:
    import tiktoken

    every_byte = {bytes([i]): i for i in range(256)}
    probe = tiktoken.Encoding(
        "probe", pat_str=pattern, mergeable_ranks=every_byte, special_tokens={}
    )
    return bytes(probe.encode_ordinary(every_character())).decode()


def _classes() -> np.ndarray:
    """Classes of code points as the installed library has them; a test holds both to it."""
    return class_table(*map(_matched_by_tiktoken, _CLASSES))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=1)
def merging_pieces(path: str) -> tuple[Pieces, MergeReplay]:
    """Pieces encoded by the merges of a rank file, cut as the tiktoken library cuts."""
    replay = MergeReplay(read_ranks(path))
    return Pieces(lambda words: replay.encode([w.encode() for w in words]), _classes()), replay


@functools.lru_cache(maxsize=1)
def library_pieces(path: str, end_id: int) -> Pieces:
    """Pieces encoded by the tokenizers library; every text ends with ``end_id``.

    As the library does unless told otherwise, strings of added tokens become their ids.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = list(tokenizer.get_added_tokens_decoder().values())
    for token in added:
        if token.lstrip or token.rstrip or token.single_word or " " in token.content:
            raise ValueError(f"added token {token.content!r} takes more than its own characters")

    def encode(words: list[str]) -> list[Sequence[int]]:
        return [
            encoded.ids
            for at in range(0, len(words), WORDS_AT_A_TIME)
            for encoded in tokenizer.encode_batch_fast(
                words[at : at + WORDS_AT_A_TIME], add_special_tokens=False
            )
        ]

    return Pieces(encode, _classes(), [end_id], [token.content for token in added])


def default_path(name: str) -> str:
    return public_tokenizers.path(name)


class Decoder:
    """Bytes of ids, all at once."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self._length = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self._start = np.cumsum(self._length) - self._length
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def __call__(self, ids: np.ndarray) -> bytes:
        lengths = self._length[ids]
        total = np.cumsum(lengths)
        if not len(total):
            return b""
        shift = self._start[ids] - (total - lengths)
        return self._bytes[np.repeat(shift, lengths) + np.arange(total[-1])].tobytes()
