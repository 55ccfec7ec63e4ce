"""Hierarchical navigable small-world graph over unit vectors, built and searched in numpy batches.

Nodes are ordered by falling level, so the members of a layer are its first nodes. Layers are built
from the top; a node enters a layer near where the layer above leads, and keeps diverse neighbours:
one that is closer to a kept neighbour than to the node is taken only to fill up.
"""

from __future__ import annotations

import numpy as np

LINKS = 16  # per node and layer; twice as many in the lowest
BUILD_BEAM = 48
SEEDS = 64
GROUP = 256
# A range search walks on through nodes that are this much below the threshold.
SLACK = 0.05


def levels_of(keys: np.ndarray) -> np.ndarray:
    """Geometric level of each node from a hash of its key: the same in any run."""
    x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    u = ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
    return np.floor(-np.log(u) / np.log(LINKS)).astype(np.int64)


def beam_search(units: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, similarities), unsorted, -1 for none: the best nodes found from one entry per query."""
    n = len(queries)
    seen = np.zeros((n, len(links)), bool)
    rows = np.arange(n)
    ids = np.full((n, beam), -1)
    near = np.full((n, beam), -2.0, np.float32)
    done = np.ones((n, beam), bool)
    ids[:, 0], done[:, 0] = entry, False
    near[:, 0] = np.einsum("ij,ij->i", units[entry], queries)
    seen[rows, entry] = True
    while True:
        waiting = np.where(done, -3.0, near)
        best = waiting.argmax(axis=1)
        a = np.flatnonzero(waiting[rows, best] > -3)
        if not len(a):
            return ids, near
        done[a, best[a]] = True
        reached = links[ids[a, best[a]]]
        fresh = reached >= 0
        reached = np.where(fresh, reached, 0)
        fresh &= ~seen[a[:, None], reached]
        r, c = np.nonzero(fresh)
        seen[a[r], reached[r, c]] = True
        close = np.full(reached.shape, -2.0, np.float32)
        close[r, c] = np.einsum("ij,ij->i", units[reached[r, c]], queries[a[r]])
        all_near = np.concatenate([near[a], close], axis=1)
        top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        near[a] = np.take_along_axis(all_near, top, 1)
        ids[a] = np.take_along_axis(np.concatenate([ids[a], np.where(fresh, reached, -1)], axis=1), top, 1)
        done[a] = np.take_along_axis(np.concatenate([done[a], ~fresh], axis=1), top, 1)


def diverse(units: np.ndarray, ids: np.ndarray, near: np.ndarray, keep: int) -> np.ndarray:
    """Per row up to ``keep`` of the candidates (-1: none), diverse ones first, then the closest of the rest."""
    order = np.argsort(-np.where(ids < 0, -9, near), axis=1, kind="stable")[:, : 3 * keep]
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    points = units[np.maximum(ids, 0)]
    between = np.einsum("rcd,rkd->rck", points, points)
    chosen = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        shadowed = (chosen & (between[:, c] > near[:, c, None])).any(axis=1)
        chosen[:, c] = (ids[:, c] >= 0) & ~shadowed & (chosen.sum(axis=1) < keep)
    rank = np.where(ids < 0, 9, np.where(chosen, 0, 1))
    picked = np.argsort(rank, axis=1, kind="stable")[:, :keep]
    out = np.full((len(ids), keep), -1)
    out[:, : picked.shape[1]] = np.take_along_axis(ids, picked, 1)
    return out


class Graph:
    """Nodes (ordered by falling level) with one link table per layer."""

    def __init__(self, units: np.ndarray, levels: np.ndarray, layers: list[np.ndarray]):
        self.units, self.levels, self.layers = units, levels, layers

    @classmethod
    def built(cls, units: np.ndarray, levels: np.ndarray) -> Graph:
        """Graph of unit vectors that are ordered by falling level."""
        graph = cls(units, levels, [])
        layers: list[np.ndarray] = []
        for level in range(int(levels[0]), -1, -1):
            layers.insert(0, graph._layer(int((levels >= level).sum()), LINKS * (1 if level else 2), layers))
        graph.layers = layers
        return graph

    def _layer(self, size: int, width: int, above: list[np.ndarray]) -> np.ndarray:
        links = np.full((size, width), -1)
        units = self.units
        first = min(size, SEEDS)
        near = units[:first] @ units[:first].T
        np.fill_diagonal(near, -9)
        ids = np.where(near > -9, np.arange(first)[None, :], -1)
        links[:first] = diverse(units, ids, near, width)
        at = first
        while at < size:
            end = min(size, at + min(at, GROUP))
            batch = np.arange(at, end)
            entry = self._descend(units[batch], above)
            entry = np.where(entry < at, entry, 0)  # a node of the layer above may not have entered this one yet
            ids, near = beam_search(units, links[:at], units[batch], entry, BUILD_BEAM)
            inner = units[batch] @ units[batch].T
            np.fill_diagonal(inner, -9)
            k = min(width, len(batch) - 1)
            if k > 0:
                top = np.argpartition(-inner, k - 1, axis=1)[:, :k]
                ids = np.concatenate([ids, batch[top]], axis=1)
                near = np.concatenate([near, np.take_along_axis(inner, top, 1)], axis=1)
            links[batch] = diverse(units, ids, near, width)
            self._link_back(links, batch)
            at = end
        return links

    def _link_back(self, links: np.ndarray, batch: np.ndarray) -> None:
        """Let the neighbours of new nodes point back; a full node keeps diverse neighbours."""
        width = links.shape[1]
        target = links[batch].ravel()
        source = np.repeat(batch, width)[target >= 0]
        target = target[target >= 0]
        near = np.einsum("ij,ij->i", self.units[target], self.units[source])
        order = np.lexsort((-near, target))
        target, source = target[order], source[order]
        nodes, start, count = np.unique(target, return_index=True, return_counts=True)
        rank = np.arange(len(target)) - np.repeat(start, count)
        inside = rank < width
        fresh = np.full((len(nodes), width), -1)
        fresh[np.repeat(np.arange(len(nodes)), count)[inside], rank[inside]] = source[inside]
        twice = (fresh[:, :, None] == links[nodes][:, None, :]).any(axis=2)
        ids = np.concatenate([links[nodes], np.where(twice, -1, fresh)], axis=1)
        near = np.einsum("rcd,rd->rc", self.units[np.maximum(ids, 0)], self.units[nodes])
        links[nodes] = diverse(self.units, ids, near, width)

    def _descend(self, queries: np.ndarray, layers: list[np.ndarray]) -> np.ndarray:
        entry = np.zeros(len(queries), np.int64)
        for links in reversed(layers):
            ids, near = beam_search(self.units, links, queries, entry, 4)
            entry = ids[np.arange(len(ids)), near.argmax(axis=1)]
        return entry

    def _both_ways(self) -> tuple[np.ndarray, np.ndarray]:
        """(starts, neighbours) of the lowest layer with links followed either way: no node is out of reach."""
        links = self.layers[0]
        held = links >= 0
        source, target = np.repeat(np.arange(len(links)), links.shape[1])[held.ravel()], links[held]
        tails, heads = np.concatenate([source, target]), np.concatenate([target, source])
        order = np.argsort(tails, kind="stable")
        return np.searchsorted(tails[order], np.arange(len(links) + 1)), heads[order]

    def within(self, query_units: np.ndarray, own: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
        """Per query the nodes found with a similarity of ``least`` or more: a beam, then a walk from its finds.

        ``own``: the node that is the query itself, where there is one (else -1); the walk starts there too.
        """
        out = []
        starts, heads = self._both_ways()
        for a in range(0, len(query_units), GROUP):
            queries = query_units[a : a + GROUP]
            ids, near = beam_search(self.units, self.layers[0], queries, self._descend(queries, self.layers[1:]), beam)
            for q, i, s, o in zip(queries, ids, near, own[a : a + GROUP], strict=True):
                begin = i[s >= least - SLACK]
                out.append(self._walk(q, np.union1d(begin, [o]) if o >= 0 else begin, least, starts, heads))
        return out

    def nearest(self, query_units: np.ndarray, own: np.ndarray, k: int, beam: int) -> np.ndarray:
        """Falling similarities of each query's ``k`` nearest nodes in a beam, ``own`` left out; -9 for none."""
        ids, near = beam_search(self.units, self.layers[0], query_units, self._descend(query_units, self.layers[1:]), beam)
        near = np.where((ids < 0) | (ids == own[:, None]), -9, near)
        return -np.sort(-near, axis=1)[:, :k]

    def true_nearest(self, query_units: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """What ``nearest`` finds with a beam over all nodes."""
        near = query_units @ self.units.T
        held = np.flatnonzero(own >= 0)
        near[held, own[held]] = -9
        k = min(k, near.shape[1])
        return -np.sort(-np.partition(near, near.shape[1] - k, axis=1)[:, near.shape[1] - k :], axis=1)

    def _walk(self, query: np.ndarray, begin: np.ndarray, least: float, starts: np.ndarray, heads: np.ndarray) -> np.ndarray:
        if len(begin) == 0:
            return begin
        seen = np.zeros(len(self.units), bool)
        seen[begin] = True
        found, frontier = [begin], begin
        while len(frontier):
            sizes = starts[frontier + 1] - starts[frontier]
            ends = np.cumsum(sizes)
            reached = heads[np.arange(ends[-1]) + np.repeat(starts[frontier] - ends + sizes, sizes)]
            reached = np.unique(reached[~seen[reached]])
            seen[reached] = True
            frontier = reached[self.units[reached] @ query >= least - SLACK]
            found.append(frontier)
        nodes = np.concatenate(found)
        return nodes[self.units[nodes] @ query >= least - 1e-4]

    def scan(self, query_units: np.ndarray, least: float) -> list[np.ndarray]:
        """What ``within`` finds with a beam over all nodes: every node compared, in blocks of queries."""
        return [
            np.flatnonzero(row >= least - 1e-4)
            for a in range(0, len(query_units), GROUP)
            for row in query_units[a : a + GROUP] @ self.units.T
        ]
