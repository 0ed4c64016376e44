"""Generalised LR repair of a sequence of roles: a weighted parse over a graph-structured stack.

The grammar of a conversation, by initials of roles, with the empty conversation allowed:

    Conversation -> Talk        Talk -> Open a        Open -> u | s u | Talk u

Each row is kept, given another role or deleted, and empty rows may be put in between. Stacks share their lower parts as
linked nodes, so a stack is its top node. Equal tops that stand after the same row are merged: the least (cost, audit) stays.
"""

from __future__ import annotations

START, END = "", "$"
PRODUCTIONS = [("Talk", ("Open", "a")), ("Open", ("u",)), ("Open", ("s", "u")), ("Open", ("Talk", "u"))]
FINAL = "Talk"
COSTS = {"K": 0, "R": 2, "D": 3, "I": 2}
PUT_IN = "ua"
#: From any stack, some edits of at most this cost allow all that any other allows afterwards: put in u and a, delete an s.
WORST_DETOUR = 7


def _closure(items: frozenset) -> frozenset:
    """All items (production, place of the dot) that a set of items implies."""
    out = set(items)
    while True:
        heads = {symbol for p, dot in out for symbol in _rest(p, dot)[:1]}
        new = {(q, 0) for q, (head, _) in enumerate(PRODUCTIONS) if head in heads} - out
        if not new:
            return frozenset(out)
        out |= new


def _rest(production: int, dot: int) -> tuple[str, ...]:
    return (PRODUCTIONS[production][1] if production >= 0 else (FINAL,))[dot:]


def _go(items: frozenset, symbol: str) -> frozenset | None:
    moved = frozenset((p, dot + 1) for p, dot in items if _rest(p, dot)[:1] == (symbol,))
    return _closure(moved) if moved else None


class Node:
    """The top of a stack: an LR state over the node below. Nodes are made once, so equal stacks are one node."""

    __slots__ = ("items", "below", "_next", "_shifts")

    def __init__(self, items: frozenset, below: Node | None):
        self.items, self.below = items, below
        self._next: dict[str, Node | None] = {}
        self._shifts: dict[str, list[Node]] = {}

    def push(self, symbol: str) -> Node | None:
        if symbol not in self._next:
            items = _go(self.items, symbol)
            self._next[symbol] = Node(items, self) if items else None
        return self._next[symbol]

    def shift(self, terminal: str) -> list[Node]:
        """Every stack after one terminal and all reductions that can follow it; none if it cannot stand here."""
        if terminal not in self._shifts:
            found, open_stacks = [], [top for top in [self.push(terminal)] if top]
            while open_stacks:
                top = open_stacks.pop()
                reduced = [p for p, dot in top.items if p >= 0 and not _rest(p, dot)]
                if any(_rest(p, dot) for p, dot in top.items) or (-1, 1) in top.items:
                    found.append(top)  # something can follow, or the conversation can end
                for p in reduced:
                    head, body = PRODUCTIONS[p]
                    below = top
                    for _ in body:
                        below = below.below
                    over = below.push(head)
                    if over:
                        open_stacks.append(over)
            self._shifts[terminal] = found
        return self._shifts[terminal]

    @property
    def accepts(self) -> bool:
        return self.below is None or (-1, 1) in self.items


BOTTOM = Node(_closure(frozenset([(-1, 0)])), None)


class Repair:
    """Reads rows one by one and gives out edits as soon as all stacks that are left agree on them.

    ``row(initial, must_go, extra)`` takes the next row; ``finish()`` ends the conversation. Both return the new, final edits as letters:
    K keeps and R reroles a row, D deletes one, I puts one in. Only the edits still open are held.
    """

    def __init__(self):
        self.tops: dict[Node, tuple[int, str]] = {BOTTOM: (0, "")}

    def _merged(self, found: dict[Node, tuple[int, str]], top: Node, weight: tuple[int, str]) -> bool:
        if top not in found or weight < found[top]:
            found[top] = weight
            return True
        return False

    def _put_in(self, tops: dict[Node, tuple[int, str]]) -> dict[Node, tuple[int, str]]:
        """``tops`` and whatever empty rows lead to, the cheapest way to each."""
        out, todo = dict(tops), list(tops)
        while todo:
            top = todo.pop()
            cost, audit = out[top]
            for terminal in PUT_IN:
                for after in top.shift(terminal):
                    if self._merged(out, after, (cost + COSTS["I"], audit + "I")):
                        todo.append(after)
        return out

    def row(self, initial: str, must_go: bool, extra: int) -> str:
        found: dict[Node, tuple[int, str]] = {}
        for top, (cost, audit) in self._put_in(self.tops).items():
            self._merged(found, top, (cost + COSTS["D"], audit + "D"))
            if must_go:
                continue
            for after in top.shift(initial) if initial else ():
                self._merged(found, after, (cost + extra + COSTS["K"], audit + "K"))
            for terminal in PUT_IN:
                for after in top.shift(terminal):
                    self._merged(found, after, (cost + extra + COSTS["R"], audit + "R"))
        least = min(cost for cost, _ in found.values())
        self.tops = {top: w for top, w in found.items() if w[0] <= least + WORST_DETOUR}
        audits = [audit for _, audit in self.tops.values()]
        agreed = _common(audits)
        if agreed:
            self.tops = {top: (cost, audit[agreed:]) for top, (cost, audit) in self.tops.items()}
        return audits[0][:agreed]

    def finish(self) -> tuple[int, str]:
        """(cost of all, the last edits)."""
        cost, audit = min(w for top, w in self._put_in(self.tops).items() if top.accepts)
        return cost, audit


def _common(audits: list[str]) -> int:
    least, most = min(audits), max(audits)
    n = 0
    while n < len(least) and n < len(most) and least[n] == most[n]:
        n += 1
    return n
