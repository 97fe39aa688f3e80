"""Generalised LR repair over the grammar of conversation roles.

    Chat  -> (nothing) | Turns | s Turns
    Turns -> u a | Turns u a

with ``s`` system, ``u`` user and ``a`` assistant. All stacks that the edits so far
may have led to are kept at once. Stacks share their lower nodes, and equal ones are merged to the one
with the smallest (cost, audit). Since ``Turns`` is left recursive a stack never has
more than four nodes, so a frontier is at most eight stacks, whatever the length.

Audits aren't compared letter by letter. The edits that belong to a row end in
keep, rerole or delete, after any inserts; so no audit of some rows is the beginning of
another audit of the same rows, and their order stays what it is whatever follows. A
frontier is listed in that order, and (cost, place in the list, next edits) decides.

For the same reason parts of a conversation can be parsed apart, from every stack they may start with, and
put together afterwards: ``Ways`` of neighbours chain to the ways of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"

# Costs of the edits; a truncated row that stays costs one more.
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
ROLES = {"u": "user", "a": "assistant"}

# Status of a row.
FINE, TRUNCATED, BLANK, DUPLICATE = 0, 1, 2, 3

# The LR tables. States 4 and 7 are complete right-hand sides of Turns, of two and three symbols.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 4, (3, "u"): 5, (6, "u"): 5, (5, "a"): 7}
REDUCE = {4: 2, 7: 3}
GOTO = {0: 3, 1: 6}
ACCEPT = {0, 3, 6}

# What any stack can do, any other can do for at most this much more: two inserts bring it to where it takes
# the same rows, but for one system row that may have to go. A stack that is dearer than another by more than this can't win.
SLACK = 2 * COSTS[INSERT] + COSTS[DELETE]

# A stack is its top state and the stack below.
BOTTOM = (0, None)

Edit = tuple[str, str]  # the edit and the symbol it puts into the result ("" for deletes)
Ways = dict[int, list[tuple[int, int]]]  # by stack at the start: (stack at the end, cost), in the order of the audits


def shifted(stack: tuple, symbol: str) -> tuple | None:
    """The stack after a symbol and the reductions it completes; None if the symbol doesn't fit."""
    state = SHIFT.get((stack[0], symbol))
    if state is None:
        return None
    stack = (state, stack)
    while stack[0] in REDUCE:
        for _ in range(REDUCE[stack[0]]):
            stack = stack[1]
        stack = (GOTO[stack[0]], stack)
    return stack


def _all_stacks() -> list[tuple]:
    found = [BOTTOM]
    for stack in found:
        found += [x for c in "sua" if (x := shifted(stack, c)) and x not in found]
    return found


STACKS = _all_stacks()
_NUMBER = {stack: i for i, stack in enumerate(STACKS)}
START = _NUMBER[BOTTOM]


@cache
def inserted(stack: int) -> list[tuple[tuple[Edit, ...], int]]:
    """Inserts that may follow, and the stack after them; none that come back to a stack seen on the way."""
    out, seen = [((), stack)], {stack}
    for edits, at in out:
        for symbol in ROLES:
            after = shifted(STACKS[at], symbol)
            if after and _NUMBER[after] not in seen:
                seen.add(_NUMBER[after])
                out.append(((*edits, (INSERT, symbol)), _NUMBER[after]))
    return out


def audit(edits: Sequence[Edit]) -> str:
    return "".join(e for e, _ in edits)


def cost(edits: Sequence[Edit], status: int) -> int:
    """Cost of the edits of one row."""
    stays = bool(edits) and edits[-1][0] in (KEEP, REROLE)
    return sum(COSTS[e] for e, _ in edits) + (status == TRUNCATED and stays)


def _row_edits(initial: str, status: int) -> list[Edit]:
    edits = [(DELETE, "")]
    if status < BLANK:
        edits += [(KEEP, initial), *((REROLE, symbol) for symbol in ROLES)]
    return edits


@cache
def step(frontier: tuple[tuple[int, int], ...], initial: str, status: int) -> tuple[tuple, int, tuple]:
    """The frontier after one more row, what all its costs have risen by, and for each stack (place before, edits).

    Costs of a frontier count from its cheapest stack, and none is above ``SLACK``: few frontiers exist, and each step is worked out once.
    """
    best: dict[int, tuple] = {}
    for place, (stack, before) in enumerate(frontier):
        for inserts, at in inserted(stack):
            for edit in _row_edits(initial, status):
                after = STACKS[at] if edit[0] == DELETE else shifted(STACKS[at], edit[1])
                if after is None:
                    continue
                edits = (*inserts, edit)
                found = (before + cost(edits, status), place, audit(edits), edits)
                end = _NUMBER[after]
                if end not in best or found[:3] < best[end][:3]:
                    best[end] = found
    least = min(found[0] for found in best.values())
    ordered = sorted(((end, found) for end, found in best.items() if found[0] <= least + SLACK), key=lambda x: x[1][1:3])
    return tuple((end, found[0] - least) for end, found in ordered), least, tuple((found[1], found[3]) for _, found in ordered)


def parsed(start: int, rows: Sequence[tuple[str, int]]) -> tuple[tuple, int, list[tuple]]:
    """Frontier, cost of its cheapest stack and the moves of all steps, for rows of (initial, status)."""
    frontier, total, moves = ((start, 0),), 0, []
    for initial, status in rows:
        frontier, more, move = step(frontier, initial, status)
        total += more
        moves.append(move)
    return frontier, total, moves


def ways(rows: Sequence[tuple[str, int]]) -> Ways:
    """The cheapest way from each stack to each other one over these rows."""
    out = {}
    for start in range(len(STACKS)):
        frontier, total, _ = parsed(start, rows)
        out[start] = [(end, total + rest) for end, rest in frontier]
    return out


def chained(start: int, parts: Sequence[Ways]) -> tuple[list[tuple[int, int]], list[list[tuple[int, int, int]]]]:
    """Frontier over neighbouring parts, and for each part and stack (place before, place in the part's ways, stack before)."""
    frontier, moves = [(start, 0)], []
    for part in parts:
        best: dict[int, tuple] = {}
        for place, (stack, before) in enumerate(frontier):
            for k, (end, more) in enumerate(part[stack]):
                found = (before + more, place, k, stack)
                if end not in best or found < best[end]:
                    best[end] = found
        ordered = sorted(best.items(), key=lambda x: x[1][1:])
        frontier = [(end, found[0]) for end, found in ordered]
        moves.append([found[1:] for _, found in ordered])
    return frontier, moves


def joined(parts: Sequence[Ways]) -> Ways:
    return {start: chained(start, parts)[0] for start in range(len(STACKS))}


def finished(frontier: Sequence[tuple[int, int]]) -> tuple[int, tuple[Edit, ...]]:
    """Place of the cheapest stack that can end here, and the inserts it takes."""
    found = [
        (before + cost(inserts, FINE), place, len(inserts), inserts)
        for place, (stack, before) in enumerate(frontier) for inserts, at in inserted(stack) if STACKS[at][0] in ACCEPT
    ]
    _, place, _, inserts = min(found)
    return place, inserts


def borders(start: int, end: int | None, parts: Sequence[Ways]) -> list[tuple[int, int | None]]:
    """Stacks at the start and end of each part on the cheapest way to ``end``; None ends the conversation, and its last part."""
    frontier, moves = chained(start, parts)
    place = finished(frontier)[0] if end is None else [e for e, _ in frontier].index(end)
    out: list[tuple[int, int | None]] = []
    for part, move in zip(reversed(parts), reversed(moves)):
        place, own, first = move[place]
        out.append((first, part[first][own][0]))
    out.reverse()
    return [*out[:-1], (out[-1][0], None)] if end is None else out


def edits(start: int, end: int | None, rows: Sequence[tuple[str, int]]) -> tuple[list[tuple[Edit, ...]], tuple[Edit, ...]]:
    """Edits of each row on the cheapest way to ``end``, and the inserts after the last row (only if ``end`` is None)."""
    frontier, _, moves = parsed(start, rows)
    place, tail = finished(frontier) if end is None else ([e for e, _ in frontier].index(end), ())
    out = []
    for move in reversed(moves):
        place, own = move[place]
        out.append(own)
    return out[::-1], tail
