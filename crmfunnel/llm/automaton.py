"""Regular expressions as one deterministic automaton over bytes.

The dialect: literals, escapes (``\\xNN``, ``\\d``, ``\\w`` and escaped signs), classes with ranges,
groups, ``|``, ``?``, ``*``, ``+``, ``{m}``, ``{m,}`` and ``{m,n}``.  Classes and literals are ASCII;
a byte of a multi-byte character matches none of them.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

_CLASSES = {"d": frozenset(range(48, 58)),
            "w": frozenset([*range(48, 58), *range(65, 91), 95, *range(97, 123)])}


class _Parser:
    """Recursive descent to a tree of ('set', bytes) / ('cat', [..]) / ('alt', [..]) / ('rep', x, m, n)."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def parse(self):
        tree = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} of {self.text!r}")
        return tree

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def take(self) -> str:
        if self.at >= len(self.text):
            raise ValueError(f"unexpected end of {self.text!r}")
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        arms = [self.sequence()]
        while self.peek() == "|":
            self.take()
            arms.append(self.sequence())
        return arms[0] if len(arms) == 1 else ("alt", arms)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, atom):
        while self.peek() and self.peek() in "?*+{":
            sign = self.take()
            if sign == "{":
                body = ""
                while (c := self.take()) != "}":
                    body += c
                low, comma, high = body.partition(",")
                bounds = (int(low), int(high) if high else (None if comma else int(low)))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            atom = ("rep", atom, *bounds)
        return atom

    def atom(self):
        c = self.take()
        if c == "(":
            if self.text.startswith("?:", self.at):
                self.at += 2
            tree = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"missing ) in {self.text!r}")
            return tree
        if c == "[":
            return ("set", self.character_class())
        if c == "\\":
            return ("set", self.cased(self.escape()))
        if c == ".":
            return ("set", frozenset(range(256)) - {10})
        return ("set", self.cased(self.code(c)))

    def code(self, c: str) -> frozenset[int]:
        if ord(c) > 127:
            raise ValueError(f"{c!r}: only ASCII in patterns")
        return frozenset([ord(c)])

    def cased(self, codes: frozenset[int]) -> frozenset[int]:
        if not self.fold:
            return codes
        letters = {c for c in codes if 65 <= c <= 90 or 97 <= c <= 122}
        return codes | {c ^ 32 for c in letters}

    def escape(self) -> frozenset[int]:
        c = self.take()
        if c == "x":
            return frozenset([int(self.take() + self.take(), 16)])
        if c in "nrt":
            return frozenset([{"n": 10, "r": 13, "t": 9}[c]])
        return _CLASSES.get(c) or self.code(c)

    def character_class(self) -> frozenset[int]:
        negated = self.peek() == "^"
        if negated:
            self.take()
        codes: set[int] = set()
        while (c := self.take()) != "]":
            first = self.escape() if c == "\\" else self.code(c)
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] not in ("", "]"):
                self.take()
                d = self.take()
                last = self.escape() if d == "\\" else self.code(d)
                first = frozenset(range(min(first), max(last) + 1))
            codes |= first
        folded = self.cased(frozenset(codes))
        return frozenset(range(256)) - folded if negated else folded


def _reverse(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [_reverse(x) for x in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [_reverse(x) for x in tree[1]])
    if kind == "rep":
        return ("rep", _reverse(tree[1]), tree[2], tree[3])
    return tree


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def build(self, tree, start: int) -> int:
        """Add the tree from ``start`` on; the state after it."""
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.build(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for arm in tree[1]:
                entry = self.state()
                self.empty[start].append(entry)
                self.empty[self.build(arm, entry)].append(end)
            return end
        _, inner, low, high = tree
        for _ in range(low):
            start = self.build(inner, start)
        end = self.state()
        if high is None:
            loop = self.state()
            self.empty[start].append(loop)
            self.empty[self.build(inner, loop)].append(loop)
            self.empty[loop].append(end)
        else:
            self.empty[start].append(end)
            for _ in range(high - low):
                start = self.build(inner, start)
                self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in self.empty[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``next[s][b]`` is the state after byte b; ``accepts[s]`` is a bit mask of rules; 0 is the start."""

    next: list[list[int]]
    accepts: list[int]


def _byte_classes(nfa: _Nfa) -> tuple[list[int], list[int]]:
    """Bytes that no transition tells apart share a class: class of each byte, a byte of each class."""
    sets = {codes for moves in nfa.moves for codes, _ in moves}
    ordered = sorted(sets, key=sorted)
    ids: dict[tuple[bool, ...], int] = {}
    of, one = [], []
    for b in range(256):
        key = tuple(b in s for s in ordered)
        if key not in ids:
            ids[key] = len(ids)
            one.append(b)
        of.append(ids[key])
    return of, one


def _subsets(nfa: _Nfa, start: int, finals: dict[int, int], everywhere: bool) -> Automaton:
    """Subset construction; ``everywhere``: a match may begin at any byte."""
    of, one = _byte_classes(nfa)
    first = nfa.closure([start])
    ids, order, rows = {first: 0}, [first], []
    for states in order:
        row = []
        for b in one:
            after = {t for s in states for codes, t in nfa.moves[s] if b in codes}
            if everywhere:
                after.add(start)
            closed = nfa.closure(after)
            if closed not in ids:
                ids[closed] = len(order)
                order.append(closed)
            row.append(ids[closed])
        rows.append(row)
    accepts = [sum({finals[s] for s in states if s in finals}) for states in order]
    rows, accepts = _minimise(rows, accepts)
    return Automaton([[row[c] for c in of] for row in rows], accepts)


def _minimise(rows: list[list[int]], accepts: list[int]) -> tuple[list[list[int]], list[int]]:
    """Partition refinement: states stay apart if they accept other rules or move to other blocks."""
    block = [0] * len(rows)
    ids: dict = {}
    block = [ids.setdefault(a, len(ids)) for a in accepts]
    while True:
        ids = {}
        finer = [ids.setdefault((block[s], *(block[t] for t in row)), len(ids)) for s, row in enumerate(rows)]
        if len(ids) == len(set(block)):
            break
        block = finer
    small: dict[int, list[int]] = {}
    marks: dict[int, int] = {}
    for s, row in enumerate(rows):
        small.setdefault(block[s], [block[t] for t in row])
        marks.setdefault(block[s], accepts[s])
    # the start's block gets number 0
    swap = {block[0]: 0, 0: block[0]}
    of = lambda b: swap.get(b, b)
    out = [[of(t) for t in small[of(b)]] for b in range(len(small))]
    return out, [marks[of(b)] for b in range(len(small))]


def compile_rules(patterns: list[tuple[str, bool]]) -> tuple[Automaton, list[Automaton]]:
    """For (pattern, either case) rules: the combined automaton and one anchored automaton per rule.

    The combined one reads a text from its last byte to its first and accepts rule r (bit r)
    exactly where some match of r begins; the anchored ones find how far a match extends.
    """
    trees = [_Parser(p, fold).parse() for p, fold in patterns]
    nfa = _Nfa()
    start, finals = nfa.state(), {}
    for r, tree in enumerate(trees):
        entry = nfa.state()
        nfa.empty[start].append(entry)
        finals[nfa.build(_reverse(tree), entry)] = 1 << r
    combined = _subsets(nfa, start, finals, True)
    anchored = []
    for tree in trees:
        nfa = _Nfa()
        start = nfa.state()
        anchored.append(_subsets(nfa, start, {nfa.build(tree, start): 1}, False))
    return combined, anchored


def rows_of(a: Automaton) -> tuple:
    """The transition arrays as rows that hold the next rows themselves; entry 256 is the mask of rules.

    ``accumulate(data, getitem, initial=rows[0])`` then walks the automaton without a Python loop.
    """
    rows: list[list] = [[None] * 257 for _ in a.next]
    for s, targets in enumerate(a.next):
        rows[s][:256] = [rows[t] for t in targets]
        rows[s][256] = a.accepts[s]
    return rows[0]


def dead_states(a: Automaton) -> set[int]:
    """States from which no accepting state can be reached."""
    back = defaultdict(set)
    for s, targets in enumerate(a.next):
        for t in targets:
            back[t].add(s)
    alive = {s for s, m in enumerate(a.accepts) if m}
    todo = list(alive)
    while todo:
        for s in back[todo.pop()]:
            if s not in alive:
                alive.add(s)
                todo.append(s)
    return set(range(len(a.next))) - alive
