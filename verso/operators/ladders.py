"""Cheapest ways through the whitespace of many whole pages at once, without a search node by node.

A page's graph is a ladder: gutters are rails, and each slit is a rung between the two gutters beside its
line. Distances along a rail or rung are differences of places, so that a way is found from the few rungs
that it may take. Places are whole numbers in half units, counted so that links of at most 1 are free, as
graph.edges has them.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

#: Costs of ways that are equal differ by less than this in whatever order they are summed up.
EQUAL = 1e-7
#: Pairs of words whose rungs are looked at together.
CHUNK = 20_000


class Places:
    """Nodes in the order of their chains: of each its number and its place, which count through all chains; of each link in that order its chain and its length."""

    def __init__(self, chain: np.ndarray, at: np.ndarray, chains: int) -> None:
        n = len(chain)
        self.number, self.place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.order, self.chain, self.step, self.saved = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(chains, np.int64)
        if not n:
            return
        low, bits = int(at.min()), n.bit_length()
        span = int(at.max()) - low + 1
        key = chain * span + (at - low)
        if chains * span < 1 << (62 - bits):
            order = np.sort((key << bits) | np.arange(n)) & ((1 << bits) - 1)
        else:
            order = np.argsort(key, kind="stable")
        self.order = order
        own, step = chain[order], np.diff(at[order])
        step[own[1:] != own[:-1]] = 0
        free = np.where(step <= 2, step, 0)
        step -= free
        self.number[order] = np.arange(n)
        self.place[order] = np.concatenate(([0], np.cumsum(step)))
        self.chain, self.step = own[1:], step
        #: of each chain what its free links save in all
        self.saved = np.bincount(own[1:], weights=free, minlength=chains).astype(np.int64)


class Ladder:
    """Of whole pages; slits and gutters count over the batch, and so do ports, as in Pages.docked."""

    def __init__(self, p) -> None:
        self.p = p
        G, S = len(p.gp), len(p.sp)
        self.up, self.down = p.above[p.sl], p.below[p.sl]
        word, side, _ = p.docked
        page, level = p.p[word], side < 2
        chain = p.dock[word, side]
        gs, ss = np.cumsum(p.gutters) - p.gutters, np.cumsum(p.slits) - p.slits
        self.level = level
        #: of each port the gutter or slit that it leads to
        self.rail = np.where(level, gs[page] + chain, -1)
        self.rung = np.where(level, -1, ss[page] + chain - p.gutters[page])
        twice_x, twice_y = (p.x0 + p.x1)[word], (p.y0 + p.y1)[word]
        center = p.sx0 + p.sx1
        has_up, has_down = np.flatnonzero(self.up >= 0), np.flatnonzero(self.down >= 0)
        on_rail, on_rung = np.flatnonzero(level), np.flatnonzero(~level)
        # of equal places the first node comes first: ends, crossings by their slits, ports
        ends = np.repeat(np.arange(G), 2)
        rails = Places(np.concatenate((ends, self.down[has_down], self.up[has_up], self.rail[on_rail])), np.concatenate((2 * np.stack((p.gx0, p.gx1), 1).ravel(), center[has_down], center[has_up], twice_x[on_rail])), G)
        middle = p.gy0 + p.gy1
        edge = lambda gutter, own: np.where(gutter >= 0, middle[np.maximum(gutter, 0)] if G else 0, 2 * own)
        every = np.arange(S)
        rungs = Places(np.concatenate((every, every, self.rung[on_rung])), np.concatenate((edge(self.up, p.sy0), edge(self.down, p.sy1), twice_y[on_rung])), S)
        cuts = np.cumsum((2 * G, len(has_down), len(has_up)))
        self.left, self.right = rails.place[: 2 * G : 2], rails.place[1 : 2 * G : 2]
        #: of each slit place and number of its crossings on the rails above and below
        self.top, self.top_n, self.foot, self.foot_n = (np.zeros(S, np.int64) for _ in range(4))
        self.foot[has_down], self.foot_n[has_down] = rails.place[cuts[0] : cuts[1]], rails.number[cuts[0] : cuts[1]]
        self.top[has_up], self.top_n[has_up] = rails.place[cuts[1] : cuts[2]], rails.number[cuts[1] : cuts[2]]
        self.half = np.maximum(1.0, 8.0 / np.maximum(1.0, (p.sx1 - p.sx0).astype(float))) * (1.0 - 0.4 * p.river) / 2
        self.first, self.last = rungs.place[:S], rungs.place[S : 2 * S]
        self.first_n, self.last_n = rungs.number[:S], rungs.number[S : 2 * S]
        self.length = (self.last - self.first) * self.half
        self.links = self.last_n - self.first_n
        self.through = (self.up >= 0) & (self.down >= 0)
        #: of each port where its node is on its rail or rung
        self.place, self.number = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        for at, own, start in ((on_rail, rails, cuts[2]), (on_rung, rungs, 2 * S)):
            self.place[at], self.number[at] = own.place[start:], own.number[start:]
        #: costs of the links of rails and of rungs
        self.on_rungs = rungs.order
        self.rail_costs, self.rung_costs = rails.step / 2, rungs.step * self.half[rungs.chain]
        self.line = p.l[word]
        self.twice_x = np.where(level, twice_x, center[np.maximum(self.rung, 0)] if S else twice_x)
        #: of each page what free links save on a rail at most, and the least cost of a rung
        self.saved = np.zeros(p.n, np.int64)
        np.maximum.at(self.saved, p.gp, rails.saved)
        self.least = np.full(p.n, np.inf)
        np.minimum.at(self.least, p.sp[self.through], self.length[self.through])
        #: pages where a way that goes over a line and back again is never cheaper than one that stays
        self.plain = self.saved < 4 * self.least
        self.slit_first = np.searchsorted(p.sl, np.arange(len(p.lp)))
        self.slit_count = np.bincount(p.sl, minlength=len(p.lp))

    @cached_property
    def spur(self) -> np.ndarray:
        """Of each port how far its node is."""
        p = self.p
        word, side, _ = p.docked
        _, x, y = p.ports
        middle, center = (p.gy0 + p.gy1) / 2, (p.sx0 + p.sx1) / 2
        upright = np.abs(y[word, side] - middle[np.maximum(self.rail, 0)]) if len(middle) else 0.0
        return np.where(self.level, upright, np.abs(x[word, side] - center[np.maximum(self.rung, 0)]) if len(center) else 0.0)

    @cached_property
    def exits(self) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Of each port's node the way to the rails above and below its line: (cost, place and number there, links); the cost is infinite where there is none."""
        out = []
        rung = np.maximum(self.rung, 0)
        for k, (rail, place, number, edge, edge_n) in enumerate(((self.up, self.top, self.top_n, self.first, self.first_n), (self.down, self.foot, self.foot_n, self.last, self.last_n))):
            word, side, _ = self.p.docked
            if not len(rail):
                out.append((np.where(self.level & (side == k), 0.0, np.inf), self.place, self.number, np.zeros(len(side), np.int64)))
                continue
            own = np.where(self.level, np.where(side == k, 0.0, np.inf), np.where(rail[rung] >= 0, np.abs(self.place - edge[rung]) * self.half[rung], np.inf))
            pick = lambda a, b: np.where(self.level, a, b[rung])
            out.append((own, pick(self.place, place), pick(self.number, number), np.where(self.level, 0, np.abs(self.number - edge_n[rung]))))
        return out[0], out[1]

    def ways(self, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cost, points) of the cheapest ways from ports to ports of the same page, of the same or adjacent lines on plain pages; the cost is infinite where there is none."""
        swapped = self.line[s] > self.line[t]
        s, t = np.where(swapped, t, s), np.where(swapped, s, t)
        cost, links = np.full(len(s), np.inf), np.zeros(len(s), np.int64)
        level = self.line[s] == self.line[t]
        for same in (True, False):
            at = np.flatnonzero(level == same)
            cost[at], links[at] = self._near(s[at], t[at], same)
            least = self._bound(s[at], t[at], same)
            at = at[~(cost[at] + EQUAL < least)]
            for some in np.array_split(at, len(at) // CHUNK + 1):
                if len(some):
                    c, n = (self._over if same else self._beside)(s[some], t[some])
                    better = c < cost[some] - EQUAL
                    cost[some], links[some] = np.where(better, c, cost[some]), np.where(better, n, links[some])
        return cost + self.spur[s] + self.spur[t], links + 3

    def _near(self, s: np.ndarray, t: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ways that take no whole rung."""

        def along(a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray]:
            return a[0][s] + b[0][t] + np.abs(a[1][s] - b[1][t]) / 2, a[3][s] + b[3][t] + np.abs(a[2][s] - b[2][t])

        above, below = self.exits
        if not same:
            return along(below, above)
        (cost, links), (other, other_links) = along(above, above), along(below, below)
        lower = other < cost
        tied = np.flatnonzero((other <= cost + EQUAL) & (cost <= other + EQUAL) & np.isfinite(cost))
        if len(tied):
            lower[tied] = self._later(s[tied], t[tied])
        cost, links = np.where(lower, other, cost), np.where(lower, other_links, links)
        chained = (self.rung[s] >= 0) & (self.rung[s] == self.rung[t])
        if chained.any():
            cost = np.where(chained, np.abs(self.place[s] - self.place[t]) * self.half[np.maximum(self.rung[s], 0)], cost)
            links = np.where(chained, np.abs(self.number[s] - self.number[t]), links)
        return cost, links

    def _later(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Whether graph.dijkstra has the way below the line of two ways between slits that are as long but for the order of sums: the lesser sum, else the one whose last node but one is the nearer, else has the lesser number."""
        (up, up_last), (down, down_last) = self._summed(s, t, 0), self._summed(s, t, 1)
        near = np.where(up_last != down_last, down_last < up_last, self.on_rungs[self.number[t] + 1] < self.on_rungs[self.number[t] - 1])
        return np.where(up != down, down < up, near)

    def _summed(self, s: np.ndarray, t: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
        """Costs of ways between slits over the rail above or below, summed up link by link, to t's node and to the one before it."""
        _, _, rail, _ = self.exits[below]
        edge = self.last_n if below else self.first_n
        legs = []
        for costs, begin, end in ((self.rung_costs, self.number[s], edge[self.rung[s]]), (self.rail_costs, rail[s], rail[t]), (self.rung_costs, edge[self.rung[t]], self.number[t])):
            forth = end > begin
            legs.append((costs, np.where(forth, begin, begin - 1), np.where(forth, 1, -1), np.abs(end - begin)))
        cost = self.spur[s]
        last = cost
        for costs, first, way, many in legs:
            for k in range(int(many.max())):
                has = np.flatnonzero(many > k)
                last = np.where(many > k, cost, last)
                cost = cost.copy()
                cost[has] += costs[first[has] + way[has] * k]
        return cost, last

    def _bound(self, s: np.ndarray, t: np.ndarray, same: bool) -> np.ndarray:
        """What ways that take a whole rung cost at least."""
        page = self.p.p[self.p.docked[0][s]]
        (up, *_), (down, *_) = self.exits
        rung = self.least[page]
        far = (np.abs(self.twice_x[s] - self.twice_x[t]) - 3 * self.saved[page]) / 2
        if same:
            return np.minimum(up[s] + down[t], down[s] + up[t]) + rung + np.maximum(far, 0)
        return np.minimum(up[s] + rung + np.minimum(up[t], down[t] + rung), down[s] + rung + down[t]) + np.maximum(far, 0)

    def _slits(self, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slits of lines, a row each; their lengths, infinite where there is no rung)."""
        most = int(self.slit_count[line].max())
        own = self.slit_first[line][:, None] + np.arange(most)
        held = np.minimum(own, max(0, len(self.length) - 1))
        some = (np.arange(most) < self.slit_count[line][:, None]) & (self.through[held] if len(self.length) else False)
        return held, np.where(some, self.length[held] if len(self.length) else 0.0, np.inf)

    def _over(self, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ways between words of a line over one of its rungs."""
        slit, length = self._slits(self.line[s])
        if not slit.shape[1]:
            return np.full(len(s), np.inf), np.zeros(len(s), np.int64)
        above, below = self.exits
        cost, links = [], []
        for a, a_at, a_n, b, b_at, b_n in ((above, self.top, self.top_n, below, self.foot, self.foot_n), (below, self.foot, self.foot_n, above, self.top, self.top_n)):
            cost.append((a[0][s] + b[0][t])[:, None] + np.abs(a[1][s][:, None] - a_at[slit]) / 2 + length + np.abs(b[1][t][:, None] - b_at[slit]) / 2)
            links.append((a[3][s] + b[3][t])[:, None] + np.abs(a[2][s][:, None] - a_n[slit]) + self.links[slit] + np.abs(b[2][t][:, None] - b_n[slit]))
        cost, links = np.concatenate(cost, 1), np.concatenate(links, 1)
        best, row = cost.argmin(1), np.arange(len(s))
        return cost[row, best], links[row, best]

    def _beside(self, s: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ways between words of a line and the next one, with or without a rung of either."""
        above, below = self.exits

        def reach(port: np.ndarray, direct: tuple, far: tuple, far_at: np.ndarray, far_n: np.ndarray, near_at: np.ndarray, near_n: np.ndarray) -> tuple[np.ndarray, ...]:
            slit, length = self._slits(self.line[port])
            cost = far[0][port][:, None] + np.abs(far[1][port][:, None] - far_at[slit]) / 2 + length
            links = far[3][port][:, None] + np.abs(far[2][port][:, None] - far_n[slit]) + self.links[slit]
            return tuple(np.concatenate((direct[k][port][:, None], v), 1) for k, v in ((0, cost), (1, near_at[slit]), (2, near_n[slit]), (3, links)))

        if not len(self.length):
            return np.full(len(s), np.inf), np.zeros(len(s), np.int64)
        a = reach(s, below, above, self.top, self.top_n, self.foot, self.foot_n)
        b = reach(t, above, below, self.foot, self.foot_n, self.top, self.top_n)
        least, links = np.full(len(s), np.inf), np.zeros(len(s), np.int64)
        row = np.arange(len(s))
        for k in range(a[0].shape[1]):
            cost = a[0][:, k, None] + b[0] + np.abs(a[1][:, k, None] - b[1]) / 2
            best = cost.argmin(1)
            better = cost[row, best] < least
            n = a[3][:, k] + b[3][row, best] + np.abs(a[2][:, k] - b[2][row, best])
            least, links = np.where(better, cost[row, best], least), np.where(better, n, links)
        return least, links

    def across(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(page in the batch, its last node, cost) of the cheapest way from each page's first node to its last; the cost is infinite where there is none."""
        p = self.p
        L, S, G = len(p.lp), len(p.sp), len(p.gp)
        nodes = 2 * (p.gutters + p.slits) + 2 * np.bincount(p.p[p.docked[0]], minlength=p.n)
        asked = np.flatnonzero(nodes)
        m = max(1, int(self.slit_count.max(initial=0)))
        slot = np.arange(S) - self.slit_first[p.sl]
        # of each line its slits side by side: cost so far at their tops and feet, places there, lengths
        fill = lambda v, none: _filled((L, m), p.sl, slot, v, none)
        length = fill(self.length, np.inf)
        ends = fill(np.full(S, np.inf), np.inf), fill(np.full(S, np.inf), np.inf)
        gs, ss = np.cumsum(p.gutters) - p.gutters, np.cumsum(p.slits) - p.slits
        start = np.where(p.gutters > 0, gs, -1)
        begins = np.zeros(G, bool)
        begins[start[start >= 0]] = True
        for cost, rail, place in ((ends[0], self.up, self.top), (ends[1], self.down, self.foot)):
            at = np.flatnonzero((rail >= 0) & begins[rail]) if G else np.zeros(0, int)
            cost[p.sl[at], slot[at]] = np.abs(place[at] - self.left[rail[at]]) / 2
        lone = np.flatnonzero((p.gutters == 0) & (p.slits > 0))
        ends[0][p.sl[ss[lone]], slot[ss[lone]]] = 0.0
        # of each rail the feet of the line above it and the tops of the line below it, by their places
        both = np.full((G, 2 * m), _NONE)
        at = np.flatnonzero(self.down >= 0)
        both[self.down[at], slot[at]] = self.foot[at]
        at = np.flatnonzero(self.up >= 0)
        both[self.up[at], m + slot[at]] = self.top[at]
        order = np.argsort(both, 1, kind="stable")
        place = np.take_along_axis(both, order, 1)
        known = place < _NONE
        place = np.where(known, place - (self.left[:, None] if G else 0), 0) / 2
        first = np.searchsorted(p.lp, np.arange(p.n))
        lines = np.bincount(p.lp, minlength=p.n)

        def spread(rail: np.ndarray) -> None:
            """Along rails."""
            over, under = p.ga[rail], p.gb[rail]
            cost = np.concatenate((np.where((over >= 0)[:, None], ends[1][over], np.inf), np.where((under >= 0)[:, None], ends[0][under], np.inf)), 1)
            own, at, has = np.take_along_axis(cost, order[rail], 1), place[rail], known[rail]
            forth = np.minimum.accumulate(np.where(has, own - at, np.inf), 1) + at
            back = np.minimum.accumulate(np.where(has, own + at, np.inf)[:, ::-1], 1)[:, ::-1] - at
            np.put_along_axis(cost, order[rail], np.where(has, np.minimum(own, np.minimum(forth, back)), np.inf), 1)
            ends[1][over[over >= 0]] = cost[over >= 0, :m]
            ends[0][under[under >= 0]] = cost[under >= 0, m:]

        def climb(line: np.ndarray) -> None:
            """Over rungs."""
            top, foot = ends[0][line], ends[1][line]
            ends[0][line], ends[1][line] = np.minimum(top, foot + length[line]), np.minimum(foot, top + length[line])

        todo, down = asked, True
        while len(todo):
            asking = np.zeros(p.n, bool)
            asking[todo] = True
            rows = np.flatnonzero(asking[p.lp])
            before = ends[0][rows], ends[1][rows]
            steps, enter, leave = range(int(lines[todo].max())), p.above, p.below
            if not down:
                steps, enter, leave = reversed(steps), p.below, p.above
            for k in steps:
                line = first[todo[lines[todo] > k]] + k
                rail = enter[line]
                spread(rail[rail >= 0])
                climb(line)
            rail = leave[first[todo] + (lines[todo] - 1 if down else 0)]
            spread(rail[rail >= 0])
            # a sweep that betters nothing after one the other way ends the search
            changed = np.zeros(p.n, bool)
            for old, new in zip(before, ends, strict=True):
                changed[p.lp[rows[(new[rows] < old - EQUAL).any(1)]]] = True
            todo, down = todo[changed[todo]], not down

        page = p.p[p.docked[0]]
        port = np.searchsorted(page, asked, side="right") - 1
        docked = np.bincount(page, minlength=p.n)[asked] > 0
        held = np.maximum(port, 0)
        none = np.full(len(asked), -1)
        slit, gutter = (ss + p.slits - 1)[asked], (gs + p.gutters - 1)[asked]
        pick = lambda a, b, c: np.where(docked, a[held] if len(a) else none, np.where(p.slits[asked] > 0, b, c))
        rung, rail = pick(self.rung, slit, none), pick(self.rail, none, gutter)
        at = pick(self.place, self.last[slit] if S else none, self.right[gutter] if G else none)
        cost = np.full(len(asked), np.inf)
        some = np.flatnonzero(rung >= 0)
        r = rung[some]
        top, foot = ends[0][p.sl[r], slot[r]], ends[1][p.sl[r], slot[r]]
        cost[some] = np.minimum(top + (at[some] - self.first[r]) * self.half[r], foot + (self.last[r] - at[some]) * self.half[r])
        some = np.flatnonzero(rail >= 0)
        g = rail[some]
        over, under = p.ga[g], p.gb[g]
        reached = np.concatenate((np.where((over >= 0)[:, None], ends[1][over], np.inf), np.where((under >= 0)[:, None], ends[0][under], np.inf)), 1)
        reached = reached + np.where(both[g] < _NONE, np.abs(both[g] - at[some][:, None]), 0) / 2
        cost[some] = np.minimum(reached.min(1), np.where(begins[g], np.abs(at[some] - self.left[g]) / 2, np.inf))
        return asked, nodes[asked] - 1, cost


_NONE = np.iinfo(np.int64).max


def _filled(shape: tuple[int, int], row: np.ndarray, at: np.ndarray, values: np.ndarray, none: float) -> np.ndarray:
    out = np.full(shape, none)
    out[row, at] = values
    return out
