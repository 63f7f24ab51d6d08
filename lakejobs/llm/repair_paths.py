"""Cheapest edits of turns to legal roles, and the least of them by prefix-doubling ranks.

A stretch of turns is a layered graph: a node is a place between turns and the state of the roles
so far, an arc is an edit. A cost DP from the end keeps the arcs of cheapest paths. Nodes are then
ranked by the least string of edits that starts there: first by one letter, then, as the
string of 2m letters is that of m letters followed by that of the node reached, by pairs of
ranks. The pointers that reach 1, 2, 4, ... letters ahead give the least path.

Stretches are independent, so many are done at once in numpy.
"""

from __future__ import annotations

import numpy as np

# Kinds of turns by the initial of their role.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
# States of the roles so far.
EMPTY, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = 4
# Edits in the order of their letters.
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = np.frombuffer(b"DIKR", np.uint8)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
NEVER = 1 << 50

# The state a kept turn leads to, by kind and state; -1 where it cannot be kept.
KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1]])
# The state an inserted or reroled turn leads to.
FILLED = np.array([AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER])
# At the end of a conversation: the cost and letters that complete its roles.
END_COST = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
END_LETTERS = ["", "II", "I", ""]

# Bits of a turn's code beside its kind.
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16


class Paths:
    """The cheapest paths of stretches of coded turns, from every state before the first.

    ``codes`` holds the turns of all stretches, ``sizes`` their numbers, ``exits`` the cost that
    follows each state behind a stretch. Inserts stand before a turn, never behind the last."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, exits: np.ndarray):
        self.sizes = sizes
        turns = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.base = turns + np.arange(len(sizes))
        places = int(sizes.sum()) + len(sizes)
        self.turn = np.arange(places) - np.repeat(np.arange(len(sizes)), sizes + 1)
        self.cost = np.full((places, STATES), NEVER, np.int64)
        self.cost[self.base + sizes] = exits
        self.best = np.zeros((places, STATES, 4), bool)
        # Arcs of the other edits lead to the state's own place, so that they are harmless.
        here = np.arange(places)[:, None] * STATES
        self.to = np.broadcast_to((here + np.arange(STATES))[:, :, None],
                                  (places, STATES, 4)).copy()
        self._fill(codes, turns)
        self._rank()

    def _fill(self, codes: np.ndarray, turns: np.ndarray) -> None:
        order = np.argsort(-self.sizes, kind="stable")
        longest = int(self.sizes.max(initial=0))
        active = np.searchsorted(-self.sizes[order], -np.arange(1, longest + 1), "right")
        for back in range(1, longest + 1):
            which = order[:active[back - 1]]
            code = codes[turns[which] + self.sizes[which] - back].astype(np.int64)
            place = self.base[which] + self.sizes[which] - back
            after = self.cost[place + 1]
            extra = np.where(code & TRUNCATED, TRUNCATED_COST, 0)[:, None]
            must_go = ((code & (BLANK | DUPLICATE)) != 0)[:, None]
            state = KEPT[code & 3]
            keep = np.where((state < 0) | must_go, NEVER, extra + np.take_along_axis(
                after, np.maximum(state, 0), 1))
            rerole = np.where(must_go, NEVER, REROLE_COST + extra + after[:, FILLED])
            delete = DELETE_COST + after
            row = np.minimum(np.minimum(keep, rerole), delete)
            cost = np.minimum(row, np.minimum(
                INSERT_COST + row[:, FILLED], 2 * INSERT_COST + row[:, FILLED[FILLED]]))
            self.cost[place] = cost
            best = self.best[place]
            best[:, :, DELETE] = delete == cost
            best[:, :, INSERT] = INSERT_COST + cost[:, FILLED] == cost
            best[:, :, KEEP] = keep == cost
            best[:, :, REROLE] = rerole == cost
            self.best[place] = best
            ahead, here = (place + 1)[:, None] * STATES, place[:, None] * STATES
            self.to[place, :, DELETE] = ahead + np.arange(STATES)
            self.to[place, :, INSERT] = here + FILLED
            self.to[place, :, KEEP] = ahead + np.maximum(state, 0)
            self.to[place, :, REROLE] = ahead + FILLED

    def _rank(self) -> None:
        """Order nodes by their least strings, doubling the letters looked at."""
        best, to = self.best.reshape(-1, 4), self.to.reshape(-1, 4)
        nodes = np.arange(len(best))
        ended = ~best.any(1)
        first = np.argmax(best, 1)
        rank = np.where(ended, 0, first + 1)
        ahead = np.where(ended, nodes, to[nodes, first])
        self.jumps = [ahead]
        letters, most = 1, 3 * int(self.sizes.max(initial=0))
        while letters < most:
            _, rank = np.unique(rank * (rank.max() + 1) + rank[ahead], return_inverse=True)
            ahead = ahead[ahead]
            self.jumps.append(ahead)
            letters *= 2
        # The arc of the least string: by letter, then by the rank of the node it reaches.
        order = np.where(best, np.arange(4) * (len(nodes) + 1) + rank[to], NEVER)
        self.letter = np.where(ended, -1, np.argmin(order, 1))
        self.ahead = np.where(ended, nodes, to[nodes, np.argmin(order, 1)])
        self.jumps[0] = self.ahead

    def cost_from(self, state: int) -> np.ndarray:
        return self.cost[self.base, state]

    def walk(self, stretch: np.ndarray, state: np.ndarray):
        """For each stretch and state before it: edits, turns (within all codes), states behind
        each edit, and the state behind the stretch."""
        at = (self.base[stretch] * STATES + state)[:, None]
        for jump in reversed(self.jumps):
            at = np.stack([at, jump[at]], 2).reshape(len(at), -1)
        last = self.ahead[at[:, -1]] if at.shape[1] else at[:, 0]
        for path, end in zip(at, last, strict=True):
            path = path[self.letter[path] >= 0]
            yield (self.letter[path], self.turn[path // STATES], self.ahead[path] % STATES,
                   int(end % STATES))


def audit(edits: np.ndarray) -> str:
    return LETTERS[edits].tobytes().decode()
