"""Karmarkar-Karp differencing of whole numbers into any number of groups (numpy, no Spark)."""

from __future__ import annotations

import heapq

import numpy as np


def difference(sizes: np.ndarray, groups: int) -> np.ndarray:
    """Group of every number, such that the groups' sums come out nearly equal.

    Every number begins as a partial partition with one filled group. The two
    partial partitions with the widest gap between their largest and smallest
    group are merged again and again: the larger groups of one meet the smaller
    groups of the other, so their imbalances cancel. Only filled groups are kept,
    so all partial partitions together hold at most one entry per number. Ties
    are broken by the order in which partitions arose.
    """
    n = len(sizes)
    if groups <= 1 or n <= 1:
        return np.zeros(n, "int64")
    above = np.arange(n)  # numbers that met in a group point at one of them
    heap = [(-int(size), k, np.array([size], "int64"), np.array([k])) for k, size in enumerate(sizes)]
    heapq.heapify(heap)
    arisen = n
    while len(heap) > 1:
        _, _, left, left_of = heapq.heappop(heap)
        _, _, right, right_of = heapq.heappop(heap)
        # sums are in descending order; what exceeds the number of groups has to be added up
        shared = max(0, left.size + right.size - groups)
        if shared:
            met, met_of = left[left.size - shared:], left_of[left.size - shared:]
            other, other_of = right[right.size - shared:][::-1], right_of[right.size - shared:][::-1]
            above[other_of] = met_of
            sums = np.concatenate([left[:left.size - shared], right[:right.size - shared], met + other])
            owners = np.concatenate([left_of[:left.size - shared], right_of[:right.size - shared], met_of])
        else:
            sums, owners = np.concatenate([left, right]), np.concatenate([left_of, right_of])
        order = np.argsort(-sums, kind="stable")
        sums, owners = sums[order], owners[order]
        least = int(sums[-1]) if sums.size == groups else 0
        heapq.heappush(heap, (least - int(sums[0]), arisen, sums - least, owners))
        arisen += 1
    final = heap[0][3]
    while True:
        top = above[above]
        if (top == above).all():
            break
        above = top
    number = np.empty(n, "int64")
    number[final] = np.arange(final.size)
    return number[above]


def into_windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Group of every number, no group over ``capacity``; each number must fit.

    The count starts at the least possible and rises by what overflows.
    """
    sizes = np.asarray(sizes, "int64")
    if sizes.size and sizes.max() > capacity:
        raise ValueError("a number exceeds the capacity")
    groups = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        of = difference(sizes, groups)
        sums = np.bincount(of, weights=sizes, minlength=groups)
        over = float(np.maximum(sums - capacity, 0).sum())
        if over == 0:
            return of
        groups += max(1, int(over // capacity))
