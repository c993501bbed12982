"""Rules for byte texts, compiled into one deterministic automaton.

A rule is a regular expression over bytes: literals, escapes (``\\x20``,
``\\.``, ``\\d``, ``\\w``), classes, groups (also ``(?i:...)`` and ``(?:...)``),
alternation and the repeats ``? * + {m} {m,} {m,n}``. ``least`` asks for that
many repeats of the expression's last item, a ``+``, and is counted by the
automaton; ``shortest`` for that many bytes in all, counted afterwards (better
where an expression's beginning is rare). Shorter matches are found and use up
their bytes, but aren't reported.

Matches are those of a left-to-right search: the leftmost, of these the
longest, none overlapping another of its rule. Several rules are searched at
once: :func:`compile_rules` takes the subsets of positions that each rule's
expression can be in (those of an earlier start before those of later ones)
through every class of bytes, minimises the result by partition refinement and
gives transition arrays.

An expression must go on matching from its first match to its end, and an
earlier start must not be pending when a later one matches; else the end of a
match could not be told in one pass and ``ValueError`` is raised.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

#: No byte of UTF-8 text: it ends every text in a scanned buffer.
END = 0xFF


@dataclass(frozen=True)
class Rule:
    """``kind`` names the rule's spans; ``least`` repeats of the last item, and
    ``shortest`` bytes of the whole match, are what a reported match has."""

    kind: str
    pattern: str
    least: int = 1
    shortest: int = 0


# Expressions are trees: ("set", frozenset), ("cat", [..]), ("or", [..]),
# ("rep", tree, low, high) with high None for any number.

class _Parser:
    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def fail(self, why: str):
        raise ValueError(f"{why} at {self.at} of {self.text!r}")

    def more(self, *these: str) -> bool:
        return any(self.text.startswith(x, self.at) for x in these) if these else self.at < len(self.text)

    def take(self) -> str:
        if not self.more():
            self.fail("unexpected end")
        self.at += 1
        return self.text[self.at - 1]

    def either(self, fold: bool):
        ways = [self.chain(fold)]
        while self.more("|"):
            self.take()
            ways.append(self.chain(fold))
        return ways[0] if len(ways) == 1 else ("or", ways)

    def chain(self, fold: bool):
        items = []
        while self.more() and not self.more("|", ")"):
            items.append(self.repeat(self.item(fold)))
        return ("cat", items)

    def repeat(self, tree):
        while self.more("?", "*", "+", "{"):
            sign = self.take()
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None), "{": (0, 0)}[sign]
            if sign == "{":
                size, _, _ = self.text[self.at:].partition("}")
                self.at += len(size) + 1
                first, comma, last = size.partition(",")
                low = int(first)
                high = (int(last) if last else None) if comma else low
            tree = ("rep", tree, low, high)
        return tree

    def item(self, fold: bool):
        sign = self.take()
        if sign == "(":
            inner = fold
            if self.more("?i:", "?:"):
                inner = fold or self.more("?i:")
                self.at = self.text.index(":", self.at) + 1
            tree = self.either(inner)
            if not self.more(")"):
                self.fail("open group")
            self.take()
            return tree
        if sign == "[":
            return ("set", self.members(fold))
        if sign == "\\":
            return ("set", self.folded(self.escape(), fold))
        if sign == ".":
            return ("set", frozenset(range(END)) - {10})
        if sign in "*+?{^$":
            self.fail(f"unsupported {sign!r}")
        return ("set", self.folded({ord(sign)}, fold))

    def escape(self) -> set:
        sign = self.take()
        if sign == "x":
            self.at += 2
            return {int(self.text[self.at - 2:self.at], 16)}
        named = {"d": range(48, 58), "n": [10], "r": [13], "t": [9], "s": [9, 10, 11, 12, 13, 32],
                 "w": [*range(48, 58), *range(65, 91), 95, *range(97, 123)]}
        return set(named[sign]) if sign in named else {ord(sign)}

    def folded(self, found, fold: bool) -> frozenset:
        found = set(found)
        if max(found, default=0) >= 128:
            self.fail("rules are of ASCII signs")
        if fold:
            found |= {ord(chr(x).swapcase()) for x in found if chr(x).isalpha()}
        return frozenset(found)

    def members(self, fold: bool) -> frozenset:
        other = self.more("^")
        if other:
            self.take()
        found: set = set()
        first = True
        while first or not self.more("]"):
            first = False
            one = self.take()
            low = self.escape() if one == "\\" else {ord(one)}
            if self.more("-") and not self.text.startswith("-]", self.at) and len(low) == 1:
                self.take()
                end = self.take()
                (high,) = self.escape() if end == "\\" else {ord(end)}
                low = set(range(min(low), high + 1))
            found |= low
        self.take()
        found = self.folded(found, fold)
        return frozenset(range(END)) - found if other else found


def parse(pattern: str):
    """The tree of an expression."""
    p = _Parser(pattern)
    tree = p.either(False)
    if p.more():
        p.fail("unmatched )")
    return tree


def flipped(tree):
    """The tree of the reversed texts."""
    if tree[0] == "set":
        return tree
    if tree[0] == "rep":
        return ("rep", flipped(tree[1]), tree[2], tree[3])
    parts = [flipped(x) for x in tree[1]]
    return (tree[0], parts[::-1] if tree[0] == "cat" else parts)


class _Graph:
    """Positions of an expression: moves on sets of bytes, and free moves."""

    def __init__(self):
        self.moves: list = []       # per position: (set of bytes, or None for a free move; target)
        self.weak: set = set()      # positions of matches that are too short

    def node(self) -> int:
        self.moves.append([])
        return len(self.moves) - 1

    def add(self, tree, start: int) -> int:
        if tree[0] == "set":
            end = self.node()
            self.moves[start].append((tree[1], end))
            return end
        if tree[0] == "cat":
            for part in tree[1]:
                start = self.add(part, start)
            return start
        end = self.node()
        if tree[0] == "or":
            for part in tree[1]:
                self.moves[self.add(part, start)].append((None, end))
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.add(part, start)
        if high is None:
            loop = self.node()
            self.moves[start].append((None, loop))
            self.moves[self.add(part, loop)].append((None, loop))
            start = loop
        else:
            for _ in range(high - low):
                self.moves[start].append((None, end))
                start = self.add(part, start)
        self.moves[start].append((None, end))
        return end

    def closure(self, nodes) -> frozenset:
        seen, todo = set(nodes), list(nodes)
        while todo:
            for on, to in self.moves[todo.pop()]:
                if on is None and to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def step(self, nodes, byte: int) -> frozenset:
        return self.closure({to for n in nodes for on, to in self.moves[n] if on is not None and byte in on})


def _graph(rule: Rule) -> tuple[_Graph, frozenset, int]:
    """(graph, first positions, end position) of a rule, short repeats marked weak."""
    tree, graph = parse(rule.pattern), _Graph()
    first = end = graph.node()
    if rule.least > 1:
        if tree[0] != "cat" or not tree[1] or tree[1][-1][0] != "rep" or tree[1][-1][2:] != (1, None):
            raise ValueError(f"least needs a + at the end of {rule.pattern!r}")
        *head, (_, part, _, _) = tree[1]
        end = graph.add(("cat", head), first)
        for _ in range(rule.least - 1):
            end = graph.add(part, end)
            graph.weak.add(end)
        end = graph.add(("rep", part, 1, None), end)
    else:
        end = graph.add(tree, first)
    return graph, graph.closure({first}), end


def _classes(sets) -> np.ndarray:
    """Class of every byte: bytes that no set tells apart share one; END has its own."""
    marks = [tuple(b in s for s in sets) + (b == END,) for b in range(256)]
    names = {m: i for i, m in enumerate(sorted(set(marks)))}
    return np.array([names[m] for m in marks], dtype=np.uint8)


def _sets(tree) -> set:
    if tree[0] == "set":
        return {tree[1]}
    return set().union(*map(_sets, tree[1])) if tree[0] in ("cat", "or") else _sets(tree[1])


#: What a state says of a rule.
NONE, WEAK, MATCH = 0, 1, 2


def _search_step(graph: _Graph, first: frozenset, end: int, held: tuple, byte: int, rule: Rule) -> tuple:
    """The next (sets by age of start) of one rule; a single set that matches goes
    on alone until it dies, then the search begins anew with this byte."""
    says = lambda s: MATCH if end in s else WEAK if s & graph.weak else NONE
    if held and says(held[0]):
        on = graph.step(held[0], byte)
        if on:
            if not says(on):
                raise ValueError(f"a match of {rule.pattern!r} could be taken back")
            return (on,)
        held = ()
        fresh = True
    else:
        fresh = False
    kept, seen = [], set()
    for some in (*held, first):
        on = graph.step(some, byte) - seen
        if on:
            kept.append(on)
            seen |= on
    told = [i for i, s in enumerate(kept) if says(s)]
    if told and (told[0] > 0 or fresh):
        raise ValueError(f"matches of {rule.pattern!r} could overlap or meet")
    return (kept[0],) if told else tuple(kept)


@dataclass
class Automaton:
    """Transition array (state x class), class of each byte, and per rule what
    each state says (``NONE``, ``WEAK``, ``MATCH``); state 0 is the start."""

    rules: tuple
    moves: np.ndarray
    classes: np.ndarray
    says: np.ndarray
    backward: list      # per rule: (moves, accepting) of the reversed expression; state 0 is dead, 1 the start


def _minimised(moves: np.ndarray, says: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that say the same now and after any bytes (partition refinement)."""
    _, block = np.unique(says, axis=0, return_inverse=True)
    block = block.ravel()
    while True:
        sign = np.column_stack([block, block[moves]])
        _, finer = np.unique(sign, axis=0, return_inverse=True)
        finer = finer.ravel()
        if finer.max() == block.max():
            break
        block = finer
    # the start's block becomes 0
    names = block.copy()
    names[block == block[0]] = 0
    names[(block != block[0]) & (block < block[0])] += 1
    _, where = np.unique(names, return_index=True)
    return names[moves[where]], says[where]


def _explored(start, step, samples) -> tuple[list, np.ndarray]:
    """All states reachable from ``start``, and their moves on each sample byte."""
    number, states, rows = {start: 0}, [start], []
    for state in states:
        row = []
        for byte in samples:
            to = step(state, byte)
            if to not in number:
                number[to] = len(states)
                states.append(to)
            row.append(number[to])
        rows.append(row)
    return states, np.array(rows, dtype=np.int64)


@lru_cache(maxsize=8)
def compile_rules(rules: tuple) -> Automaton:
    """One automaton for all rules."""
    graphs = [_graph(r) for r in rules]
    classes = _classes(sorted(set().union(*(_sets(parse(r.pattern)) for r in rules)), key=sorted))
    samples = [int(np.flatnonzero(classes == c)[0]) for c in range(classes.max() + 1)]
    # subsets of single rules first: most states of the whole share them
    single = []
    for rule, (graph, first, end) in zip(rules, graphs):
        if end in first:
            raise ValueError(f"{rule.pattern!r} matches nothing at all")
        states, moves = _explored((), lambda s, b, g=graph, f=first, e=end, r=rule: () if b == END else _search_step(g, f, e, s, b, r),
                                  samples)
        told = [MATCH if s and end in s[0] else WEAK if s and s[0] & graph.weak else NONE for s in states]
        single.append((moves, np.array(told)))
    column = {b: c for c, b in enumerate(samples)}
    states, moves = _explored((0,) * len(rules), lambda s, b: tuple(m[x, column[b]].item() for x, (m, _) in zip(s, single)), samples)
    says = np.column_stack([told[[s[i] for s in states]] for i, (_, told) in enumerate(single)])
    moves, says = _minimised(moves, says)
    backward = []
    for rule in rules:
        graph = _Graph()
        first = graph.node()
        end = graph.add(flipped(parse(rule.pattern)), first)
        sets, back = _explored(graph.closure({first}), lambda s, b, g=graph: g.step(s, b) if b != END else frozenset(), samples)
        # state 0 is the dead one, the start is 1
        order = [i for i, s in enumerate(sets) if not s] + [i for i, s in enumerate(sets) if s]
        if sets[order[0]]:
            raise ValueError(f"{rule.pattern!r} matches without end")
        rank = np.argsort(order)
        backward.append((rank[back[order]].astype(np.int32), np.array([end in sets[i] for i in order])))
    return Automaton(rules, moves.astype(np.int32), classes, says.astype(np.uint8), backward)
