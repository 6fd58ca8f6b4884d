"""Earley parsing under a weighted grammar whose preterminals may take a token at a cost, or none (an insertion).

Chart items (rule, dot, origin) keep the least (cost, audit), the audit being the letters of the edits taken so far.  Two
audits of one item at one cost never begin one another (more insertions would cost more), so that the lesser stays the
lesser whatever follows, and keeping one an item is enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from os.path import commonprefix

#: What a preterminal may do: the letter, and the cost of taking a token so (None: it can't); no function for an insertion.
Edit = tuple[str, Callable[[str], int | None] | None, int]
Value = tuple[int, str]


@dataclass
class Grammar:
    start: str
    rules: dict[str, list[tuple[str, ...]]]
    edits: dict[str, list[Edit]]
    flat: list[tuple[str, tuple[str, ...]]] = field(init=False)
    of: dict[str, list[int]] = field(init=False)

    def __post_init__(self):
        self.flat = [(left, right) for left, rights in self.rules.items() for right in rights]
        self.of = {left: [i for i, (x, _) in enumerate(self.flat) if x == left] for left in self.rules}


class Column:
    """The chart's set at one position: values of items, items by the symbol they wait for, and what began and ended here."""

    def __init__(self):
        self.items: dict[tuple[int, int, int], Value] = {}
        self.waiting: dict[str, list[tuple[int, int, int]]] = {}
        self.empty: dict[str, Value] = {}  # constituents from here to here


def plus(a: Value, b: Value) -> Value:
    return a[0] + b[0], a[1] + b[1]


def fill(g: Grammar, chart: dict[int, Column], at: int, taken: Iterable[tuple[str, int, Value]]) -> None:
    """Predicts and completes at position ``at`` until nothing gets better, from the constituents that a token has ended."""
    col, work = chart[at], []

    def put(item: tuple[int, int, int], value: Value) -> None:
        if item not in col.items:
            rule, dot, _ = item
            if dot < len(g.flat[rule][1]):
                col.waiting.setdefault(g.flat[rule][1][dot], []).append(item)
        elif col.items[item] <= value:
            return
        col.items[item] = value
        work.append(item)

    def complete(symbol: str, origin: int, value: Value) -> None:
        if origin == at:
            if symbol in col.empty and col.empty[symbol] <= value:
                return
            col.empty[symbol] = value
        for rule, dot, o in list(chart[origin].waiting.get(symbol, ())):
            put((rule, dot + 1, o), plus(chart[origin].items[rule, dot, o], value))

    if at == 0:
        for i in g.of[g.start]:
            put((i, 0, 0), (0, ""))
    for symbol, origin, value in taken:
        complete(symbol, origin, value)
    while work:
        item = work.pop()
        rule, dot, origin = item
        left, right = g.flat[rule]
        value = col.items[item]
        if dot == len(right):
            complete(left, origin, value)
            continue
        symbol = right[dot]
        if symbol in g.edits:
            for letter, takes, cost in g.edits[symbol]:
                if takes is None:
                    complete(symbol, at, (cost, letter))
        else:
            for i in g.of[symbol]:
                put((i, 0, at), (0, ""))
        if symbol in col.empty:
            put((rule, dot + 1, origin), plus(value, col.empty[symbol]))


#: Positions after which what all audits begin with is put aside, so that long inputs don't copy it again and again.
ASIDE = 64


def parse(g: Grammar, tokens: Iterable[str]) -> Value | None:
    """The least (cost, audit) that makes ``tokens`` a sentence; of the chart, only columns that items still refer to are kept."""
    chart, at, done = {0: Column()}, 0, []
    fill(g, chart, 0, ())
    for token in tokens:
        col = chart[at]
        taken = []
        for symbol in col.waiting:
            best = min(((cost, letter) for letter, takes, extra in g.edits.get(symbol, ()) if takes is not None and (c := takes(token)) is not None for cost in (extra + c,)), default=None)
            if best is not None:
                taken.append((symbol, at, best))
        at += 1
        chart[at] = Column()
        fill(g, chart, at, taken)
        col = chart[at]
        live = {o for _, _, o in col.items} | {0, at}
        chart = {k: v for k, v in chart.items() if k in live}
        if at % ASIDE == 0:
            from_start = [i for i in col.items if i[2] == 0]
            shared = len(commonprefix([col.items[i][1] for i in from_start]))
            if shared:
                done.append(col.items[from_start[0]][1][:shared])
                col.items.update({i: (col.items[i][0], col.items[i][1][shared:]) for i in from_start})
    found = [chart[at].items[i] for i in chart[at].items if g.flat[i[0]][0] == g.start and i[1] == len(g.flat[i[0]][1]) and i[2] == 0]
    if not found:
        return None
    cost, audit = min(found)
    return cost, "".join([*done, audit])
