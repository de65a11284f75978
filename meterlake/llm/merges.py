"""Byte-pair merges replayed over many words at once, from an index of token pairs."""

from __future__ import annotations

import heapq

#: Between words, and the rank of a pair that never merges.
GONE = -1
#: A token that its left neighbour took in.
MERGED = -2
#: Pairs remembered before the table starts anew.
MOST_PAIRS = 300_000


class MergeReplay:
    """Merges of a rank file, each applied to all words of a block before the next rank.

    Words lie end to end as linked tokens. An inverted index maps the rank of a token pair
    to the places where that pair stands; merging a place touches its two neighbours only.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self._tokens = {rank: token for token, rank in ranks.items()}
        self._byte = [ranks[bytes([i])] for i in range(256)]
        self._width = max(ranks.values()) + 1
        self._pair: dict[int, int] = {}

    def _learn(self, left: int, right: int) -> int:
        """The rank of two neighbours as one token, GONE if they never merge; remembered."""
        if len(self._pair) > MOST_PAIRS:
            self._pair.clear()
        rank = self.ranks.get(self._tokens[left] + self._tokens[right], GONE)
        self._pair[left * self._width + right] = rank
        return rank

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word, as merging lowest ranks first, leftmost first, gives them."""
        whole = self.ranks.get
        result: list[list[int]] = []
        open_words: list[int] = []
        for number, word in enumerate(words):
            rank = whole(word)
            result.append([] if rank is None else [rank])
            if rank is None and word:
                open_words.append(number)
        if not open_words:
            return result
        token: list[int] = []
        first: list[int] = []
        byte = self._byte
        for number in open_words:
            first.append(len(token))
            token.extend(byte[b] for b in words[number])
            token.append(GONE)  # between words: merges with nothing
        after = list(range(1, len(token) + 1))
        before = list(range(-1, len(token) - 1))
        self._replay(token, before, after)
        for number, start in zip(open_words, first):
            ids, at = result[number], start
            while token[at] != GONE:
                ids.append(token[at])
                at = after[at]
        return result

    def _replay(self, token: list[int], before: list[int], after: list[int]) -> None:
        known, learn, width = self._pair.get, self._learn, self._width
        places: dict[int, list[int]] = {}
        left = GONE
        for at, right in enumerate(token):
            if left != GONE and right != GONE:
                rank = known(left * width + right)
                if rank is None:
                    rank = learn(left, right)
                if rank != GONE:
                    if rank in places:
                        places[rank].append(at - 1)
                    else:
                        places[rank] = [at - 1]
            left = right
        waiting = list(places)
        heapq.heapify(waiting)

        def wait(rank: int, at: int) -> None:
            if rank in places:
                places[rank].append(at)
            else:
                places[rank] = [at]
                heapq.heappush(waiting, rank)

        while waiting:
            rank = heapq.heappop(waiting)
            todo = places.pop(rank)
            todo.sort()
            for done, at in enumerate(todo):
                one = token[at]
                right = after[at]
                if one < 0 or token[right] < 0:
                    continue  # merged away meanwhile, or the end of a word
                found = known(one * width + token[right])
                if found is None:
                    found = learn(one, token[right])
                if found != rank:
                    continue
                token[at] = rank
                token[right] = MERGED
                beyond = after[right]
                after[at] = beyond
                before[beyond] = at
                lower = False
                earlier = before[at]
                if earlier >= 0 and token[earlier] >= 0:
                    new = known(token[earlier] * width + rank)
                    if new is None:
                        new = learn(token[earlier], rank)
                    if new != GONE:
                        wait(new, earlier)
                        lower = new < rank
                if token[beyond] >= 0:
                    new = known(rank * width + token[beyond])
                    if new is None:
                        new = learn(rank, token[beyond])
                    if new != GONE:
                        wait(new, at)
                        lower = lower or new < rank
                if lower:  # a lower rank came up and goes first
                    for later in todo[done + 1 :]:
                        wait(rank, later)
                    break
