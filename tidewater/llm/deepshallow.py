"""Sorting byte strings with long common prefixes: multikey quicksort to a shallow depth, blind tries below it."""

from __future__ import annotations

SHALLOW = 12


def common(a: bytes, b: bytes, lo: int = 0) -> int:
    """Length of the longest common prefix, known to be ``lo`` at least."""
    hi = min(len(a), len(b))
    if a[lo:hi] == b[lo:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo if a[lo] != b[lo] else lo + 1


class Trie:
    """A blind trie: inner nodes know a depth and the branching bytes only; leaves know their strings."""

    __slots__ = ("depth", "kids", "ids")

    def __init__(self, depth: int, kids: dict[int, Trie] | None = None, ids: list[int] | None = None):
        self.depth, self.kids, self.ids = depth, kids, ids


def blind(strings: list[bytes], members: list[int], depth: int) -> tuple[list[int], list[int]]:
    """Order of ``members``, which share ``depth`` bytes, and the common prefix of each with the one before it (0 for the first)."""
    root = Trie(len(strings[members[0]]), None, [members[0]])
    for i in members[1:]:
        s, node = strings[i], root
        while node.kids is not None:  # blindly down: skipped bytes aren't looked at
            node = node.kids.get(s[node.depth] if node.depth < len(s) else -1) or next(iter(node.kids.values()))
        other = strings[node.ids[0]]
        k = common(s, other, depth)
        if k == len(s) == len(other):
            node.ids.append(i)
            continue
        at, above, by = root, None, -1
        while at.kids is not None and at.depth < k:
            above, by = at, s[at.depth] if at.depth < len(s) else -1
            at = at.kids[by]
        leaf = Trie(len(s), None, [i])
        mine = s[k] if k < len(s) else -1
        if at.kids is not None and at.depth == k:
            at.kids[mine] = leaf
            continue
        split = Trie(k, {other[k] if k < len(other) else -1: at, mine: leaf})
        if above is None:
            root = split
        else:
            above.kids[by] = split
    order: list[int] = []
    lcp: list[int] = []
    stack = [(root, 0)]
    while stack:
        node, shared = stack.pop()
        if node.kids is None:
            order += node.ids
            lcp += [shared] + [node.depth] * (len(node.ids) - 1)
        else:
            for n, key in enumerate(sorted(node.kids, reverse=True)):
                stack.append((node.kids[key], shared if n == len(node.kids) - 1 else node.depth))
    return order, lcp


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """The sorted order of ``strings``, which share ``depth`` bytes, and each one's common prefix with the one before (0 for the first)."""
    order: list[int] = []
    lcp: list[int] = []
    end = depth + shallow
    stack = [(list(range(len(strings))), depth, 0)]
    while stack:
        part, d, shared = stack.pop()
        if len(part) == 1:
            order += part
            lcp.append(shared)
        elif d >= end:
            own, known = blind(strings, part, d)
            order += own
            lcp += [shared, *known[1:]]
        else:
            at = [strings[i][d] if d < len(strings[i]) else -1 for i in part]
            pivot = sorted(at)[len(at) // 2]
            less = [i for i, c in zip(part, at, strict=True) if c < pivot]
            same = [i for i, c in zip(part, at, strict=True) if c == pivot]
            more = [i for i, c in zip(part, at, strict=True) if c > pivot]
            if pivot < 0:  # ended here: all alike
                first = [(same, -1)]
            else:
                first = [(same, d + 1)]
            parts = [(less, d)] + first + [(more, d)]
            parts = [p for p in parts if p[0]]
            for n in range(len(parts) - 1, -1, -1):
                own, nd = parts[n]
                up = shared if n == 0 else d
                if nd < 0:
                    stack.append((own, end, up))
                else:
                    stack.append((own, nd, up))
    return order, lcp
