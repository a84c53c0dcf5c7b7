"""A hierarchical navigable small-world graph over unit vectors, built and searched for many queries at once in numpy."""

from __future__ import annotations

import numpy as np

#: Neighbours kept per node above and on the ground layer, nodes per layer below a node, beam while building.
NEIGHBOURS, GROUND, LAYER, BUILD_BEAM = 12, 24, 12, 48
#: Queries searched at once, nodes expanded per step, nodes inserted at once.
BLOCK, EXPAND, INSERT = 256, 4, 512
#: Width of beams from which blocks have fewer queries.
WIDE = 4096
#: Steps in which a beam wider than EXPAND times it is expanded at least; queries whose candidates are compared at once.
STEPS, GATHER = 12, 32
#: The entry of a beam that holds no node: the largest, and expanded. The bits of a node.
NONE, NODE = np.uint64(2**64 - 1), np.uint64(2**31 - 1)


class Graph:
    """``x``: unit vectors (float32). Layers are arrays of neighbours, -1 where there is none."""

    def __init__(self, x: np.ndarray, seed: int = 0):
        self.x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LAYER)).astype(int)
        self.order = np.argsort(-level, kind="stable")  # upper nodes first: each layer's nodes come before others
        self.layers = [np.full((n, GROUND if k == 0 else NEIGHBOURS), -1, np.int32) for k in range(int(level.max(initial=0)) + 1)]
        self.entry = self.order[:1]
        placed = self.order[:0]
        at = 0
        while at < n:
            new = self.order[at:at + max(32, min(INSERT, at // 2))]
            self._insert(new, placed, level)
            at += len(new)
            placed = self.order[:at]
        self.apart = self._unreached()

    def _insert(self, new: np.ndarray, placed: np.ndarray, level: np.ndarray) -> None:
        q = self.x[new]
        among = q @ q.T
        np.fill_diagonal(among, -2)
        start = np.repeat(self.entry[None, :1], len(new), axis=0)
        found = {}
        if len(placed):
            for k in range(len(self.layers) - 1, -1, -1):  # all layers are searched before any is changed
                ids, sims = self._beam(q, start, k, BUILD_BEAM)
                found[k], start = (ids, sims), ids[:, :EXPAND]
        for k, layer in enumerate(self.layers):
            own = np.flatnonzero(level[new] >= k)
            if not len(own):
                continue
            width = min(len(own), layer.shape[1] + 1)
            near = own[np.argsort(-among[np.ix_(own, own)], axis=1)[:, :width]]
            ids, sims = new[near], among[own[:, None], near]
            if len(placed):
                ids, sims = np.concatenate([ids, found[k][0][own]], 1), np.concatenate([sims, found[k][1][own]], 1)
            layer[new[own]] = self._spread(new[own], ids, np.where(sims < -1.5, -np.inf, sims), layer.shape[1])
            self._back(new[own], layer)

    def _spread(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each node up to ``most`` of its candidates: those nearer to it than to any kept one, then the nearest others."""
        out = np.full((len(nodes), most), -1, np.int32)
        for at in range(0, len(nodes), 256):
            i, s = ids[at:at + 256], sims[at:at + 256]
            o = np.argsort(-s, axis=1, kind="stable")
            o = o[:, :max(1, int((s > -np.inf).sum(1).max()))]  # without columns that hold no candidate
            i, s = np.take_along_axis(i, o, 1), np.take_along_axis(s, o, 1)
            v = self.x[np.maximum(i, 0)]
            between = np.matmul(v, v.transpose(0, 2, 1))
            kept, nearest = np.zeros(i.shape, bool), np.full(i.shape, -np.inf, np.float32)
            for c in range(i.shape[1]):
                kept[:, c] = (s[:, c] > -np.inf) & (nearest[:, c] < s[:, c]) & (kept.sum(1) < most)
                nearest = np.where(kept[:, c:c + 1], np.maximum(nearest, between[:, c]), nearest)
            rank = np.argsort(np.where(kept, 0, np.where(s > -np.inf, 1, 2)), axis=1, kind="stable")[:, :most]
            got = np.take_along_axis(np.where(s > -np.inf, i, -1), rank, 1)
            out[at:at + 256, :got.shape[1]] = got
        return out

    def _back(self, new: np.ndarray, layer: np.ndarray) -> None:
        """Edges in the other direction; a node with too many keeps those that spread best."""
        to = layer[new]
        source, target = np.repeat(new, to.shape[1]), to.ravel()
        source, target = source[target >= 0], target[target >= 0]
        if not len(target):
            return
        o = np.argsort(target, kind="stable")
        source, target = source[o], target[o]
        nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, counts)
        keep = place < 64  # the graph needs no more ways into one node from one batch
        extra = np.full((len(nodes), min(64, int(counts.max()))), -1, np.int64)
        extra[np.repeat(np.arange(len(nodes)), counts)[keep], place[keep]] = source[keep]
        ids = np.concatenate([layer[nodes].astype(np.int64), extra], 1)
        ids = np.sort(ids, axis=1)
        repeat = np.concatenate([np.zeros((len(ids), 1), bool), ids[:, 1:] == ids[:, :-1]], 1)
        by_count = np.argsort(counts, kind="stable")  # nodes with as many candidates are compared together
        nodes, ids, repeat = nodes[by_count], ids[by_count], repeat[by_count]
        sims = np.empty(ids.shape, np.float32)
        for at in range(0, len(nodes), 512):
            part = slice(at, at + 512)
            sims[part] = np.einsum("nd,nkd->nk", self.x[nodes[part]], self.x[np.maximum(ids[part], 0)])
        layer[nodes] = self._spread(nodes, ids, np.where((ids < 0) | repeat, -np.inf, sims), layer.shape[1])

    def _beam(self, q: np.ndarray, start: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` best nodes met for each query (similarity -2 where there is none), best first.

        An entry of a beam is one number: 1 - similarity as the bits of a positive float, the node, and whether it was expanded.
        Wider beams expand more nodes per step, so that the number of steps does not grow with them.
        """
        layer, m, n, most = self.layers[k], len(q), len(self.x), max(EXPAND, beam // STEPS)
        # "no node" is -1 in layers, n in here; it is always seen, in a row's last place, which stands before the next row's first
        seen = np.zeros((m, n + 1), bool)
        seen[:, n] = True
        seen, row0 = seen.ravel(), np.arange(m)[:, None] * (n + 1)
        beams = np.full((m, beam), NONE)
        near = np.where(start[:, :beam] < 0, n, start[:, :beam]).astype(np.int32)
        active = np.arange(m)
        while len(active):
            seen[near + row0[active]] = True
            a = np.concatenate([beams[active], self._entries(q[active], near)], 1)
            a.sort(axis=1)
            a = a[:, :beam]
            fresh = (a & 1) == 0
            place = np.cumsum(fresh, axis=1, dtype=np.int32)
            row, column = np.nonzero(fresh & (place <= most))  # beams are sorted: the best not yet expanded
            node = (a[row, column] >> 1 & NODE).astype(np.int64)
            a[row, column] |= 1
            beams[active] = a
            ways = np.full((len(active), most, layer.shape[1]), n, np.int32)
            ways[row, place[row, column] - 1] = layer[node]
            going = place[:, -1] > 0
            active, near = active[going], ways[going].reshape(-1, most * layer.shape[1])
            np.copyto(near, n, where=seen.take(near + row0[active]))
            near.sort(axis=1)
            np.copyto(near[:, 1:], n, where=near[:, 1:] == near[:, :-1])
            near = near[:, :np.flatnonzero((near < n).any(axis=0)).max(initial=-1) + 1]
        there = beams < NONE
        sims = 1 - (beams >> 32).astype(np.uint32).view(np.float32)
        return np.where(there, (beams >> 1 & NODE).astype(np.int64), -1), np.where(there, sims, np.float32(-2))

    def _entries(self, q: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Beam entries, not expanded, for a row of nodes per query; ``NONE`` for no node."""
        away = np.empty(near.shape, np.float32)
        for at in range(0, len(near), GATHER):  # few enough vectors at once for a processor's cache
            part = slice(at, at + GATHER)
            away[part] = 1 - np.matmul(np.take(self.x, near[part], axis=0, mode="clip"), q[part, :, None])[:, :, 0]
        entries = np.maximum(away, 0).view(np.uint32).astype(np.uint64) << 32 | near.astype(np.uint64) << 1
        np.copyto(entries, NONE, where=near == len(self.x))
        return entries

    def _unreached(self) -> np.ndarray:
        """Nodes to which no way leads on the ground; every query is compared with them as well."""
        reached = np.zeros(len(self.x), bool)
        front = np.asarray(self.entry, np.int64)
        while len(front):
            reached[front] = True
            front = np.unique(self.layers[0][front])
            front = front[front >= 0]
            front = front[~reached[front]]
        return np.flatnonzero(~reached)

    def search(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of the pairs found with similarity ``least`` or more.

        A beam that ends full of hits may have left some out: such queries are searched again with a beam four times
        as wide, up to all nodes.
        """
        q = np.ascontiguousarray(q, np.float32)
        out = [np.nonzero(q @ self.x[self.apart].T >= least)] if len(self.apart) else []
        out = [(a, self.apart[b]) for a, b in out]
        rest, width = np.arange(len(q)), min(beam, len(self.x))
        start = np.repeat(self.entry[None, :1], len(q), axis=0)
        for k in range(len(self.layers) - 1, 0, -1):
            start = np.concatenate([self._beam(q[at:at + BLOCK], start[at:at + BLOCK], k, min(EXPAND, len(self.x)))[0]
                                    for at in range(0, len(q), BLOCK)] or [start])
        while len(rest):
            block, wider = max(1, min(BLOCK, BLOCK * WIDE // width)), []
            for at in range(0, len(rest), block):
                some = rest[at:at + block]
                ids, sims = self._beam(q[some], start[some], 0, width)
                full = (sims[:, -1] >= least) & (width < len(self.x))
                a, b = np.nonzero((sims >= least) & (ids >= 0) & ~full[:, None])
                out.append((some[a], ids[a, b]))
                wider.append(some[full])
            rest, width = np.concatenate(wider), min(4 * width, len(self.x))
        if not out:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        a, b = (np.concatenate([o[j] for o in out]) for j in (0, 1))
        pairs = np.unique(a * len(self.x) + b)
        return pairs // len(self.x), pairs % len(self.x)
