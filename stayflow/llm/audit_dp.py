"""Cheapest edits of a turn sequence. Edit strings are linked nodes that share their prefixes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

MODULUS = (1 << 61) - 1
BASE = 911_382_323

# What has come out so far: nothing, a system turn, a user turn, a whole user-assistant pair.
NOTHING, SYSTEM, USER, PAIR = range(4)
STATES = range(4)
ENDS = (NOTHING, PAIR)
# Where a turn of the role of that initial leads, and the one an added or renamed turn takes.
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": PAIR}, {"u": USER})
NEXT = ((USER, "u"), (USER, "u"), (PAIR, "a"), (USER, "u"))
FINE, MUST_GO, CUT_SHORT = range(3)  # faults of a turn as the edits see them
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
CUT_SHORT_COST = 1


class Node:
    """An edit string: the parent's string and one more piece.

    ``depth`` is the string's length and ``hash`` its rolling hash. ``up[k]`` is the
    2^k-th ancestor. ``path`` spells the piece with the role that each edit leaves behind it.
    ``twin`` leads to a node verified to spell the same string.
    """

    __slots__ = ("piece", "path", "depth", "hash", "up", "twin", "inner")

    def __init__(self, parent: Node | None = None, piece: str = "", path: str = "", inner: Sequence[int] | None = None):
        self.piece, self.path, self.twin, self.inner = piece, path, None, inner
        if parent is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = parent.depth + len(piece)
        ahead = inner[-1] if inner else ord(piece)
        self.hash = (parent.hash * pow(BASE, len(piece), MODULUS) + ahead) % MODULUS
        up, k = [parent], 0
        while len(up[k].up) > k:
            up.append(up[k].up[k])
            k += 1
        self.up = up

    def holder(self, length: int) -> Node:
        """The ancestor whose piece holds the character before position ``length``."""
        node = self
        while node.up and node.up[0].depth >= length:
            for above in reversed(node.up):
                if above.depth >= length:
                    node = above
                    break
        return node

    def hash_at(self, length: int) -> int:
        node = self.holder(length)
        if node.depth == length:
            return node.hash
        parent = node.up[0]
        within = length - parent.depth
        return (parent.hash * pow(BASE, within, MODULUS) + node.inner[within - 1]) % MODULUS

    def char_at(self, position: int) -> str:
        node = self.holder(position + 1)
        return node.piece[position - node.up[0].depth]

    def first(self) -> Node:
        node = self
        while node.twin is not None:
            node = node.twin
        return node

    def spelled(self) -> str:
        parts, node = [], self
        while node.up:
            parts.append(node.path)
            node = node.up[0]
        return "".join(reversed(parts))


def prefix_hashes(piece: str) -> list[int]:
    hashes, value = [], 0
    for c in piece:
        value = (value * BASE + ord(c)) % MODULUS
        hashes.append(value)
    return hashes


def first_difference(a: Node, b: Node, length: int) -> int:
    """The first of ``length`` positions at which the strings differ, ``length`` if none does.
    Goes back from there only to the nearest node both share or have shared before."""
    found, at = length, length
    x, y = a.holder(length), b.holder(length)
    start = (x, y) if x.depth == y.depth == length else None
    while at and not (x.depth == y.depth and x.first() is y.first()):
        low = max(x.up[0].depth, y.up[0].depth)
        p = x.piece[low - x.up[0].depth : at - x.up[0].depth]
        q = y.piece[low - y.up[0].depth : at - y.up[0].depth]
        if p != q:
            found = low + next(i for i, (c, d) in enumerate(zip(p, q)) if c != d)
        at = low
        x = x.up[0] if x.up[0].depth == low else x
        y = y.up[0] if y.up[0].depth == low else y
    if start and found == length and start[0].first() is not start[1].first():
        start[1].first().twin = start[0].first()
    return found


def common_prefix(a: Node, b: Node) -> int:
    """Length of the longest common prefix: searched by hashes, then verified."""
    low, high = 0, min(a.depth, b.depth)
    if a.hash_at(high) == b.hash_at(high):
        low = high
    while high - low > 1:
        middle = (low + high) // 2
        if a.hash_at(middle) == b.hash_at(middle):
            low = middle
        else:
            high = middle
    return first_difference(a, b, low)


def least(a: Node, b: Node) -> Node:
    """The node whose string comes first."""
    n = common_prefix(a, b)
    if n == min(a.depth, b.depth):
        return a if a.depth <= b.depth else b
    return a if a.char_at(n) < b.char_at(n) else b


Best = dict[int, tuple[int, Node]]


def offer(best: Best, state: int, cost: int, parent: Node, piece: str, path: str, inner: Sequence[int] | None = None) -> None:
    known = best.get(state)
    if known is not None and known[0] < cost:
        return
    node = Node(parent, piece, path, inner) if piece else parent
    if known is not None and known[0] == cost:
        node = least(known[1], node)
    best[state] = (cost, node)


def with_inserts(best: Best) -> Best:
    """Cheapest strings once turns may have been added; adding a pair leads back and never pays."""
    best, open_states = dict(best), set(best)
    while open_states:
        state = min(open_states, key=lambda s: best[s][0])
        open_states.discard(state)
        cost, node = best[state]
        target, role = NEXT[state]
        before = best.get(target)
        if before is None or before[0] >= cost + COSTS[INSERT]:
            offer(best, target, cost + COSTS[INSERT], node, INSERT, INSERT + role)
            if best[target] is not before and (before is None or best[target][0] < before[0]):
                open_states.add(target)
    return best


def with_turn(best: Best, initial: str, fault: int) -> Best:
    """Cheapest strings after a turn has been kept, renamed or deleted, by the state they lead to."""
    after: Best = {}
    extra = CUT_SHORT_COST if fault == CUT_SHORT else 0
    for state, (cost, node) in with_inserts(best).items():
        offer(after, state, cost + COSTS[DELETE], node, DELETE, DELETE + "-")
        if fault == MUST_GO:
            continue
        if initial in FOLLOWS[state]:
            offer(after, FOLLOWS[state][initial], cost + extra, node, KEEP, KEEP + initial)
        target, role = NEXT[state]
        offer(after, target, cost + COSTS[REROLE] + extra, node, REROLE, REROLE + role)
    return after


def part(turns: Iterable[tuple[str, int]], start: int) -> dict[int, tuple[int, str]]:
    """(cost, path) of the cheapest edits of these turns from a state to every state."""
    best: Best = {start: (0, Node())}
    for initial, fault in turns:
        best = with_turn(best, initial, fault)
    return {state: (cost, node.spelled()) for state, (cost, node) in best.items()}


def ending(best: Best) -> tuple[int, Node]:
    """The cheapest string that ends well, the first of several."""
    best = with_inserts(best)
    found: Best = {}
    for state in ENDS:
        if state in best:
            offer(found, 0, *best[state], "", "")
    return found[0]


def whole(turns: Iterable[tuple[str, int]]) -> tuple[int, str]:
    """(cost, path) of the cheapest edits of a whole conversation."""
    best: Best = {NOTHING: (0, Node())}
    for initial, fault in turns:
        best = with_turn(best, initial, fault)
    cost, node = ending(best)
    return cost, node.spelled()


def joined(parts: Sequence[dict[tuple[int, int], tuple[int, str]]]) -> tuple[int, list[str]]:
    """(cost, path per part) of a conversation whose parts are known from state to state.

    The same step as for single turns, with a part's whole edit string as the piece. Edit
    strings of one cost over the same turns are never prefixes of each other, as inserts cost,
    so the first of a state stays the first whatever follows.
    """
    best: Best = {NOTHING: (0, Node())}
    for known in parts:
        pieces = {way: (cost, path[::2], path) for way, (cost, path) in known.items()}
        hashes = {way: prefix_hashes(piece) for way, (_, piece, _) in pieces.items()}
        after: Best = {}
        for (start, end), (cost, piece, path) in pieces.items():
            if start in best:
                offer(after, end, best[start][0] + cost, best[start][1], piece, path, hashes[start, end])
        best = after
    cost, node = ending(best)
    paths, tail = [], ""
    while node.up:
        if node.inner is None:
            tail = node.path + tail
        else:
            paths.append(node.path)
        node = node.up[0]
    paths.reverse()
    paths[-1] += tail
    return cost, paths
