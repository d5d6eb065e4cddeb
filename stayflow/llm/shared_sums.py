"""Common parts of many sums: sets of terms that several items share are added up once."""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class Plan:
    """A graph of sums over ``n_leaves`` values.

    ``nodes[i]`` is the pair whose sum node ``n_leaves + i`` is, both made before it.
    ``sums`` are the nodes that make up each item; an item's sum adds these.
    """

    n_leaves: int
    nodes: list[tuple[int, int]]
    sums: list[list[int]]

    @property
    def additions(self) -> int:
        return len(self.nodes) + sum(max(0, len(s) - 1) for s in self.sums)


def plan_sums(sets: Sequence[Sequence[int]], n_leaves: int, reach: int = 24) -> Plan:
    """The sums of the given sets of leaves with shared parts worked out once.

    Mines pairs that several sets hold, the most frequent first, and puts a new node in their place,
    which can be part of further pairs; so sets shared by several items become nodes of a graph.
    In a set, leaves of more than one set are ordered by how many sets have them; pairs are
    looked for among those at most ``reach`` places apart, so work grows with the length of a
    set and not with its square.
    """
    holders: dict[int, set[int]] = defaultdict(set)
    for item, leaves in enumerate(sets):
        for leaf in leaves:
            holders[leaf].add(item)
    common = Counter()
    for leaves in sets:
        shared = sorted((x for x in set(leaves) if len(holders[x]) > 1), key=lambda x: (-len(holders[x]), x))
        for i, a in enumerate(shared):
            for b in shared[i + 1 : i + 1 + reach]:
                common[(a, b) if a < b else (b, a)] += 1
    queue = [(-n, pair) for pair, n in common.items() if n > 1]
    heapq.heapify(queue)
    nodes: list[tuple[int, int]] = []
    made: dict[int, list[int]] = defaultdict(list)  # nodes a set has got, the latest last
    while queue:
        count, (a, b) = heapq.heappop(queue)
        both = holders[a] & holders[b]
        if len(both) < 2:
            continue
        if len(both) < -count:  # fewer by now, as earlier pairs took them
            heapq.heappush(queue, (-len(both), (a, b)))
            continue
        node = n_leaves + len(nodes)
        nodes.append((a, b))
        holders[a] -= both
        holders[b] -= both
        holders[node] = both
        again = Counter()
        for item in both:
            for other in made[item][-reach:]:
                if item in holders[other]:
                    again[other] += 1
            made[item].append(node)
        for other, n in again.items():
            if n > 1:
                heapq.heappush(queue, (-n, (other, node)))
    sums: list[list[int]] = [[] for _ in sets]
    for node in sorted(holders):
        for item in holders[node]:
            sums[item].append(node)
    return Plan(n_leaves, nodes, sums)
