"""Byte-pair merging with a heap of adjacent pairs over a linked list of symbols."""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heapify, heappop, heappush


def merge_pairs(start: Sequence[str], ranks: dict[tuple[str, str], int]) -> tuple[int, list[str | None]]:
    """Merge adjacent pairs, lowest rank first and leftmost among equals.

    Returns the number of merges, and the symbols with None where one was merged into the one before it.
    A heap entry is stale when the pair now at its place has another rank; it is passed over when popped.
    """
    symbols, n, get = list(start), len(start), ranks.get
    heap = [rank * n + i for i, pair in enumerate(zip(symbols, symbols[1:])) if (rank := get(pair)) is not None]
    if not heap:
        return 0, symbols
    heapify(heap)
    after, before, merges = list(range(1, n + 1)), list(range(-1, n - 1)), 0
    while heap:
        rank, i = divmod(heappop(heap), n)
        j = after[i]
        if j == n or symbols[i] is None or get((symbols[i], symbols[j])) != rank:
            continue
        merged = symbols[i] = symbols[i] + symbols[j]
        symbols[j] = None
        merges += 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (rank := get((merged, symbols[k]))) is not None:
                heappush(heap, rank * n + i)
        k = before[i]
        if k >= 0 and (rank := get((symbols[k], merged))) is not None:
            heappush(heap, rank * n + k)
    return merges, symbols
