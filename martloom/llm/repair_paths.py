"""Cheapest edits of role sequences, and of these the ones whose audit is ASCII-least.

Many conversations are solved at once as arrays. A node is a place before a row, or after the last
one, and a state of the grammar; an arc is one edit. Costs come from products of one small
matrix per row in (min, +), doubled until they reach the end. Arcs that keep to the cheapest cost
are left; on those, nodes are ranked by the first letter of their audit, then by 2, 4, 8, ...
letters: twice as many letters from a node are its own rank followed by the least rank where they
lead. Ranks then choose one arc for each node, and pointers along these arcs, doubled likewise,
list the path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Edits in ASCII order, and what they cost.
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
TRUNCATED_COST = 1
FAR = 1 << 40

# Initials of roles and faults of a row, as its code initial * 4 + fault.
INITIALS = "sua"
OTHER = 3
SOUND, MUST_GO, TRUNCATED = range(3)


@dataclass(frozen=True)
class Grammar:
    """Role sequences as a machine: (state, initial) leads to states; `made` are the initials that
    an edit may give a row."""

    states: int
    start: int
    accepted: frozenset[int]
    steps: dict[tuple[int, int], tuple[int, ...]]
    made: tuple[int, ...]


# (s?(ua)+)?: nothing yet, after s, after u, after a
CHAT = Grammar(4, 0, frozenset({0, 3}), {(0, 0): (1,), (0, 1): (2,), (1, 1): (2,), (2, 2): (3,), (3, 1): (2,)}, (1, 2))

Arc = tuple[int, int, int, int, int]


def _arcs(grammar: Grammar, code: int | None) -> list[Arc]:
    """(from state, to state, letter, initial made or -1, cost) at a row of this code, or without
    one at the end: inserts alone."""
    arcs = [
        (q, to, INSERT, made, COST[INSERT])
        for (q, made), after in grammar.steps.items()
        if made in grammar.made
        for to in after
    ]
    if code is None:
        return arcs
    initial, fault = divmod(code, 4)
    arcs += [(q, q, DELETE, -1, COST[DELETE]) for q in range(grammar.states)]
    if fault != MUST_GO:
        extra = TRUNCATED_COST if fault == TRUNCATED else 0
        for (q, made), after in grammar.steps.items():
            for to in after:
                if made == initial:
                    arcs.append((q, to, KEEP, -1, COST[KEEP] + extra))
                if made in grammar.made:
                    arcs.append((q, to, REROLE, made, COST[REROLE] + extra))
    return arcs


def _inserted(grammar: Grammar) -> np.ndarray:
    """Least cost of going from state to state by inserts alone."""
    cost = np.full((grammar.states, grammar.states), FAR, np.int64)
    np.fill_diagonal(cost, 0)
    for q, to, _, _, price in _arcs(grammar, None):
        cost[q, to] = min(cost[q, to], price)
    for via in range(grammar.states):
        cost = np.minimum(cost, cost[:, via : via + 1] + cost[via : via + 1, :])
    return cost


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(min, +) products of stacks of matrices."""
    shape = np.broadcast_shapes(a.shape[:-2], b.shape[:-2])
    out = np.full(shape + (a.shape[-2], b.shape[-1]), FAR, np.int64)
    for via in range(b.shape[-2]):
        np.minimum(out, a[..., via : via + 1] + b[..., via : via + 1, :], out=out)
    return out


class Repaired:
    """Results of `solve`, as lists with one entry for each conversation."""

    def __init__(self, costs: list[int], audits: list[str], made: list[str]) -> None:
        self.costs, self.audits, self.made = costs, audits, made


def solve(codes: np.ndarray, lengths: np.ndarray, grammar: Grammar = CHAT) -> Repaired:
    """Cheapest edits of conversations of `lengths` rows, whose codes stand one after the other.

    `made` gives, letter by letter of the audit, the initial that the edit makes: u or a for an
    inserted or re-roled row, - for others. Conversations of no rows are allowed.
    """
    states = grammar.states
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths + 1) - 1  # the place after the last row
    places = int(ends[-1]) + 1 if len(ends) else 0
    starts = ends - lengths
    if not places:
        return Repaired([], [], [])
    code = np.full(places, -1, np.int64)
    at_row = np.ones(places, bool)
    at_row[ends] = False
    code[at_row] = codes
    end_of = np.repeat(ends, lengths + 1)
    place = np.arange(places)

    # costs to the end: inserts and one row's matrix per place, doubled
    inserts = _inserted(grammar)
    row_matrix = np.full((17, states, states), FAR, np.int64)
    for c in range(16):
        for q, to, letter, _, price in _arcs(grammar, c):
            if letter != INSERT:
                row_matrix[c, q, to] = min(row_matrix[c, q, to], price)
    for q in grammar.accepted:
        row_matrix[16, q, :] = 0  # after the last row: end here
    product = _times(inserts[None], row_matrix)[np.where(at_row, code, 16)]
    reach = 1
    longest = int(lengths.max())
    while reach <= longest:
        more = place + reach <= end_of
        product[more] = _times(product[more], product[place[more] + reach])
        reach *= 2
    to_go = product.min(axis=2)  # all columns agree once the end is reached

    # arcs that keep to the cheapest cost, by letter: the states they may lead to, as bits
    nodes = places * states
    leads = np.zeros((len(LETTERS), nodes), np.uint8)
    kinds = {int(c): _arcs(grammar, int(c)) for c in np.unique(code[at_row])}
    for c, arcs in [(-1, _arcs(grammar, None)), *kinds.items()]:
        here = place[code == c]
        for q, to, letter, _, price in arcs:
            after = here if letter == INSERT else here + 1
            best = to_go[here, q] == price + to_go[after, to]
            leads[letter, here[best] * states + q] |= np.uint8(1 << to)

    # ranks by 1, 2, 4, ... letters
    letter_of = np.full(nodes, -1, np.int64)
    for letter in reversed(range(len(LETTERS))):
        letter_of[leads[letter] > 0] = letter
    node = np.arange(nodes)
    bits = np.where(letter_of >= 0, leads[np.maximum(letter_of, 0), node], 1 << (node % states)).astype(np.uint8)
    where = node // states + ((letter_of >= 0) & (letter_of != INSERT))
    first_bits = bits
    rank = letter_of + 1
    letters = 1
    while letters <= 5 * longest // 2 + 2:
        least = np.full(nodes, nodes + 1, np.int64)
        for q in range(states):
            held = (bits >> q & 1).astype(bool)
            least[held] = np.minimum(least[held], rank[where[held] * states + q])
        next_bits, next_where = np.zeros_like(bits), where.copy()
        for q in range(states):
            held = (bits >> q & 1).astype(bool)
            held[held] = rank[where[held] * states + q] == least[held]
            there = where[held] * states + q
            next_bits[held] |= bits[there]
            next_where[held] = where[there]
        _, rank = np.unique(rank * (nodes + 2) + least, return_inverse=True)
        bits, where = next_bits, next_where
        letters *= 2

    # one arc for each node: of the states its letter leads to, the one of least rank
    after = node // states + ((letter_of >= 0) & (letter_of != INSERT))
    chosen, least = node.copy(), np.full(nodes, nodes + 1, np.int64)
    for q in range(states):
        there = after * states + q
        better = (first_bits >> q & 1).astype(bool)
        better[better] = rank[there[better]] < least[better]
        least[better] = rank[there[better]]
        chosen[better] = there[better]
    moves = (letter_of >= 0).astype(np.int64)

    # the chosen paths, listed by doubled pointers
    jumps, counts = [chosen], moves
    while True:
        jump = jumps[-1]
        further = counts + counts[jump]
        if np.array_equal(further, counts):
            break
        counts = further
        jumps.append(jump[jump])
    first = starts * states + grammar.start
    sizes = counts[first]
    ends_of_paths = np.cumsum(sizes)
    total = int(ends_of_paths[-1]) if len(sizes) else 0
    step = np.arange(total) - np.repeat(ends_of_paths - sizes, sizes)
    path = np.repeat(first, sizes)
    for k, jump in enumerate(jumps):
        on = (step >> k & 1).astype(bool)
        path[on] = jump[path[on]]

    # what the edits make: found by (code, letter, states), as an arc is one of these
    made = np.full((17, len(LETTERS), states, states), ord("-"), np.uint8)
    for c in range(-1, 16):
        for q, to, letter, initial, _ in reversed(_arcs(grammar, None if c < 0 else c)):
            if initial >= 0:
                made[c, letter, q, to] = ord(INITIALS[initial])
    path_letters = letter_of[path]
    made_letters = made[code[path // states], path_letters, path % states, chosen[path] % states]
    audit = np.frombuffer(LETTERS.encode(), np.uint8)[path_letters].tobytes().decode()
    made_text = made_letters.tobytes().decode()
    cuts = list(zip((ends_of_paths - sizes).tolist(), ends_of_paths.tolist(), strict=True))
    return Repaired(
        to_go[starts, grammar.start].tolist(),
        [audit[a:b] for a, b in cuts],
        [made_text[a:b] for a, b in cuts],
    )
