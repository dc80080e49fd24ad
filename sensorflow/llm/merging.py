"""Byte-pair merging with a heap and a linked list."""

from __future__ import annotations

from heapq import heapify, heappop, heappush

PLACES = 1 << 32


class Merges:
    """Merge ranks over numbered symbols: two neighbours are one number, and so are a rank and a place."""

    def __init__(self, merges: list[tuple[str, str]], ids: dict[str, int]):
        self.width = max(ids.values(), default=0) + 1
        known = [(rank, a, b) for rank, (a, b) in enumerate(merges) if a in ids and b in ids and a + b in ids]
        self.rank = {ids[a] * self.width + ids[b]: rank * PLACES for rank, a, b in known}
        self.product = {rank * PLACES: ids[a + b] for rank, a, b in known}

    def run(self, symbols: list[int]) -> tuple[list[int], int]:
        """The symbols left once no neighbouring pair has a rank, and the number of merges.

        The heap holds rank and place of the left symbol; the list is linked by place. A popped entry that no longer
        describes the pair at its place is stale and skipped. Equal ranks merge from the left.
        """
        n = len(symbols)
        if n < 2:
            return symbols, 0
        rank_of, width = self.rank.get, self.width
        heap = []
        left = symbols[0]
        for i in range(1, n):
            right = symbols[i]
            if (r := rank_of(left * width + right)) is not None:
                heap.append(r + i - 1)
            left = right
        if not heap:
            return symbols, 0
        heapify(heap)
        symbols = list(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            entry = heappop(heap)
            place = entry % PLACES
            rank, right = entry - place, after[place]
            if right >= n or symbols[place] < 0 or rank_of(symbols[place] * width + symbols[right]) != rank:
                continue
            symbols[place], symbols[right] = self.product[rank], -1
            merges += 1
            follower = after[place] = after[right]
            if follower < n:
                before[follower] = place
                if (r := rank_of(symbols[place] * width + symbols[follower])) is not None:
                    heappush(heap, r + place)
            previous = before[place]
            if previous >= 0 and (r := rank_of(symbols[previous] * width + symbols[place])) is not None:
                heappush(heap, r + previous)
        return [s for s in symbols if s >= 0], merges
