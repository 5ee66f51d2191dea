"""A Hamming index over fingerprints in Gray order: shared bits move up into the nodes above.

Codes are rows of 64-bit words. Sorted by their rank in the Gray sequence, neighbours share most bits. Sixteen
neighbours make a node, sixteen nodes the node above, and so on. A node's mask has the bits in
which all its codes agree; what the node above fixes already is taken out, so every bit is compared once on the way
down. A search adds the differences from the top and drops a whole node once they exceed the
distance asked for.
"""

from __future__ import annotations

import numpy as np

FAN = 16
# Queries go down together; so many (query, node) pairs are held at most.
FRONTIER = 1 << 20


def gray_rank(words: np.ndarray) -> np.ndarray:
    """Where each 64-bit word stands in the Gray sequence."""
    rank = words.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_order(codes: np.ndarray) -> np.ndarray:
    """Row numbers of ``codes`` (n, words) in Gray order, the first word most significant."""
    return np.lexsort([gray_rank(codes[:, w]) for w in range(codes.shape[1] - 1, -1, -1)])


def differences(a: np.ndarray, b: np.ndarray, mask: np.ndarray | None = None) -> np.ndarray:
    both = a ^ b
    if mask is not None:
        both = both & mask
    return np.bitwise_count(both).sum(axis=1, dtype=np.int32)


class GrayIndex:
    """The tree over codes in Gray order; level 0 are the codes themselves."""

    def __init__(self, codes: np.ndarray):
        """``codes`` (n, words) uint64, already in Gray order."""
        full = np.uint64(0xFFFFFFFFFFFFFFFF)
        ands, ors = [codes], [codes]
        while len(ands[-1]) > FAN:
            cuts = np.arange(0, len(ands[-1]), FAN)
            ands.append(np.bitwise_and.reduceat(ands[-1], cuts, axis=0))
            ors.append(np.bitwise_or.reduceat(ors[-1], cuts, axis=0))
        self.patterns, self.masks = ands, []
        shared = [~(a ^ o) & full for a, o in zip(ands, ors, strict=True)]
        for level, mask in enumerate(shared):
            if level + 1 < len(shared):
                mask = mask & ~np.repeat(shared[level + 1], FAN, axis=0)[: len(mask)]
            self.masks.append(mask)

    def search(self, queries: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, code number) of all pairs that differ in at most ``most`` bits."""
        top = len(self.patterns) - 1
        step = max(1, FRONTIER // FAN // max(1, len(self.patterns[top])))
        found = [self._descend(queries, np.arange(b, min(b + step, len(queries))), most) for b in range(0, len(queries), step)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([q for q, _ in found]), np.concatenate([c for _, c in found])

    def _descend(self, queries: np.ndarray, which: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        top = len(self.patterns) - 1
        nodes = np.tile(np.arange(len(self.patterns[top])), len(which))
        asked = np.repeat(which, len(self.patterns[top]))
        sums = np.zeros(len(asked), np.int32)
        stack, out = [(top, asked, nodes, sums)], []
        while stack:
            level, asked, nodes, sums = stack.pop()
            if len(asked) > FRONTIER:
                half = len(asked) // 2
                stack += [(level, asked[:half], nodes[:half], sums[:half]), (level, asked[half:], nodes[half:], sums[half:])]
                continue
            sums = sums + differences(queries[asked], self.patterns[level][nodes], self.masks[level][nodes])
            near = sums <= most
            asked, nodes, sums = asked[near], nodes[near], sums[near]
            if level == 0 or not len(asked):
                out.append((asked, nodes))
                continue
            below = (nodes[:, None] * FAN + np.arange(FAN)).reshape(-1)
            asked, sums = np.repeat(asked, FAN), np.repeat(sums, FAN)
            real = below < len(self.patterns[level - 1])
            stack.append((level - 1, asked[real], below[real], sums[real]))
        return np.concatenate([a for a, _ in out]), np.concatenate([n for _, n in out])


def least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least node reachable over the links a-b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        wider = label.copy()
        np.minimum.at(wider, a, low)
        np.minimum.at(wider, b, low)
        wider = wider[wider]
        if (wider == label).all():
            return label
        label = wider


def links_in_groups(codes: np.ndarray, groups: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is near in each group: every row to the least row of its cluster.

    ``groups`` numbers the rows' groups, rows of a group standing together. Groups of up to ``FAN`` rows are single
    leaf nodes and are compared together; larger ones get an index each.
    """
    left, right = [], []
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(groups)])
    small = np.repeat(sizes <= FAN, sizes)
    for shift in range(1, min(FAN, int(sizes.max(initial=0)))):
        at = np.flatnonzero((groups[shift:] == groups[:-shift]) & small[shift:])
        near = differences(codes[at], codes[at + shift]) <= most
        left.append(at[near])
        right.append(at[near] + shift)
    for begin, size in zip(starts[sizes > FAN].tolist(), sizes[sizes > FAN].tolist(), strict=True):
        order = gray_order(codes[begin : begin + size])
        ordered = codes[begin : begin + size][order]
        asked, found = GrayIndex(ordered).search(ordered, most)
        later = asked < found
        label = least_reachable(size, asked[later], found[later])
        linked = np.flatnonzero(label != np.arange(size))
        left.append(begin + order[label[linked]])
        right.append(begin + order[linked])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)
