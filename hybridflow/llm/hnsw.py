"""Hierarchical navigable small-world graphs, built and searched for many vectors at once.

Searches run in lockstep: every step expands the best open candidate of each query, so that distances
of a step are one matrix product. Vectors are unit vectors, near means a large dot product.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DEGREE = 16
BUILD_BEAM = 48
BATCH = 256


def levels_of(n: int, degree: int, seed: int) -> np.ndarray:
    u = np.random.default_rng(seed).random(n)
    return np.minimum((-np.log(u) / np.log(degree)).astype(int), 6)


def search_layer(x, links, queries, starts, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest nodes found per query: ids (-1 where fewer) and similarities, best first.

    ``links``: a row of neighbours per node, -1 where fewer. ``starts``: entry nodes per query.
    """
    q, n, degree = len(queries), len(x), links.shape[1]
    rows = np.arange(q)
    seen = np.zeros((q, n), dtype=bool)
    width = max(beam, starts.shape[1])
    ids = np.full((q, width), -1, dtype=np.int64)
    sims = np.full((q, width), -np.inf, dtype=np.float32)
    done = np.ones((q, width), dtype=bool)
    k = starts.shape[1]
    ids[:, :k] = starts
    sims[:, :k] = np.where(starts >= 0, np.einsum("qd,qkd->qk", queries, x[starts]), -np.inf)
    done[:, :k] = starts < 0
    seen[rows[:, None], starts] = True
    live = rows
    while len(live):
        open_ = np.where(done[live], -np.inf, sims[live])
        best = open_.argmax(axis=1)
        go = open_[np.arange(len(live)), best] > -np.inf
        live, best = live[go], best[go]
        if not len(live):
            break
        node = ids[live, best]
        done[live, best] = True
        near = links[node]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(near >= 0, near, node[:, None])] = True
        near_sims = np.einsum("qd,qkd->qk", queries[live], x[near])
        near_sims[~fresh] = -np.inf
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_sims = np.concatenate([sims[live], near_sims], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width] if all_sims.shape[1] > width else np.argsort(-all_sims, axis=1)
        lane = np.arange(len(live))[:, None]
        ids[live], sims[live], done[live] = all_ids[lane, top], all_sims[lane, top], all_done[lane, top]
    order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
    ids, sims = ids[rows[:, None], order], sims[rows[:, None], order]
    ids[sims == -np.inf] = -1
    return ids, sims


def diverse(x, ids, sims, degree: int) -> np.ndarray:
    """Of candidates sorted by nearness, those nearer to the query than to any chosen before."""
    q, c = ids.shape
    between = np.einsum("qid,qjd->qij", x[ids], x[ids])
    chosen = np.zeros((q, c), dtype=bool)
    count = np.zeros(q, dtype=int)
    for i in range(c):
        closest = np.where(chosen, between[:, i, :], -np.inf).max(axis=1)
        ok = (ids[:, i] >= 0) & (sims[:, i] > closest) & (count < degree)
        chosen[:, i] = ok
        count += ok
    # Room that is left goes to the nearest of the others, so that dense groups stay linked.
    for i in range(c):
        ok = (ids[:, i] >= 0) & ~chosen[:, i] & (count < degree)
        chosen[:, i] |= ok
        count += ok
    out = np.full((q, degree), -1, dtype=np.int64)
    row, col = np.nonzero(chosen)
    place = np.arange(len(row)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    out[row, place] = ids[row, col]
    return out


@dataclass
class Graph:
    x: np.ndarray
    links: list[np.ndarray]
    entry: int

    @classmethod
    def build(cls, x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, seed: int = 5) -> Graph:
        """Insert in batches: each batch searches what is there, and itself."""
        n = len(x)
        x = np.ascontiguousarray(x, dtype=np.float32)
        level = levels_of(n, degree, seed)
        order = np.argsort(-level, kind="stable")  # higher nodes first: upper layers are there when needed
        top = int(level.max()) if n else 0
        links = [np.full((n, degree * (2 if k == 0 else 1)), -1, dtype=np.int64) for k in range(top + 1)]
        graph = cls(x, links, int(order[0]) if n else -1)
        at, size = 0, 1
        while at < n:
            batch = order[at : at + size]
            graph._insert(batch, order[:at], level, beam)
            at += len(batch)
            size = min(BATCH, max(1, at // 2))
        return graph

    def _insert(self, batch, before, level, beam) -> None:
        x = self.x
        queries = x[batch]
        starts = np.full((len(batch), 1), self.entry, dtype=np.int64)
        within = queries @ queries.T
        np.fill_diagonal(within, -np.inf)
        for k in range(len(self.links) - 1, -1, -1):
            here = level[batch] >= k
            if len(before):
                ids, sims = search_layer(x, self.links[k], queries, starts, beam if here.any() else 1)
                starts = ids[:, :1] if k else starts
            else:
                ids = np.full((len(batch), 1), -1, dtype=np.int64)
                sims = np.full((len(batch), 1), -np.inf, dtype=np.float32)
            if not here.any():
                continue
            mates = np.where(here[None, :], within, -np.inf)
            m = min(beam // 2, len(batch))
            pick = np.argsort(-mates, axis=1)[:, :m]
            mate_sims = np.take_along_axis(mates, pick, 1)
            ids = np.concatenate([ids, np.where(mate_sims > -np.inf, batch[pick], -1)], axis=1)
            sims = np.concatenate([sims, mate_sims], axis=1)
            own = np.flatnonzero(here)
            ids, sims = ids[own], sims[own]
            best = np.argsort(-sims, axis=1, kind="stable")[:, : beam + m]
            ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
            degree = self.links[k].shape[1]
            chosen = diverse(x, ids, sims, degree // 2 if k == 0 else degree)
            self.links[k][batch[own], : chosen.shape[1]] = chosen
            self._link_back(k, batch[own], chosen)

    def _link_back(self, k: int, nodes, chosen) -> None:
        """Neighbours learn of the new nodes; full ones keep a diverse choice."""
        links = self.links[k]
        degree = links.shape[1]
        row, col = np.nonzero(chosen >= 0)
        target, source = chosen[row, col], nodes[row]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        start = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.empty(0, int)
        ends = np.r_[start[1:], len(target)]
        if not len(start):
            return
        most = int((ends - start).max())
        owners = target[start]
        offered = np.full((len(owners), degree + most), -1, dtype=np.int64)
        offered[:, :degree] = links[owners]
        which = np.repeat(np.arange(len(owners)), ends - start)
        offered[which, degree + np.arange(len(target)) - np.repeat(start, ends - start)] = source
        offered.sort(axis=1)
        offered[:, 1:][offered[:, 1:] == offered[:, :-1]] = -1  # two of one batch may have chosen each other
        full = (offered >= 0).sum(axis=1) > degree
        easy = ~full
        packed = np.sort(np.where(offered < 0, np.iinfo(np.int64).max, offered), axis=1)[:, :degree]
        packed[packed == np.iinfo(np.int64).max] = -1
        links[owners[easy]] = packed[easy]
        if full.any():
            rows, ids = owners[full], offered[full]
            sims = np.where(ids >= 0, np.einsum("qd,qkd->qk", self.x[rows], self.x[ids]), -np.inf)
            best = np.argsort(-sims, axis=1, kind="stable")
            ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
            links[rows] = diverse(self.x, ids, sims, degree)

    def descend(self, queries: np.ndarray) -> np.ndarray:
        """Entry nodes of the lowest layer for each query."""
        at = np.full((len(queries), 1), self.entry, dtype=np.int64)
        for k in range(len(self.links) - 1, 0, -1):
            at = search_layer(self.x, self.links[k], queries, at, 1)[0]
        return at

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest nodes of each query, best first, as many as the beam holds."""
        queries = np.ascontiguousarray(queries, dtype=np.float32)
        return search_layer(self.x, self.links[0], queries, self.descend(queries), beam)

    def within(self, queries: np.ndarray, least: float, beam: int, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) of similarity ``least`` or more: a beam search, then everything linked to it.

        From the beam's nodes the search goes on through all nodes of at least ``least - margin``, so
        the number of answers has no bound.
        """
        queries = np.ascontiguousarray(queries, dtype=np.float32)
        ids, sims = self.search(queries, min(beam, max(len(self.x), 1)))
        seen = np.zeros((len(queries), len(self.x)), dtype=bool)
        row, col = np.nonzero(ids >= 0)
        node, sim = ids[row, col], sims[row, col]
        seen[row, node] = True
        rows, nodes = [row[sim >= least]], [node[sim >= least]]
        go = sim >= least - margin
        row, node = row[go], node[go]
        while len(row):
            near = self.links[0][node]
            row = np.repeat(row, near.shape[1])[near.ravel() >= 0]
            node = near.ravel()[near.ravel() >= 0]
            pair = np.unique(row * len(self.x) + node)
            row, node = np.divmod(pair, len(self.x))
            new = ~seen[row, node]
            row, node = row[new], node[new]
            seen[row, node] = True
            sim = np.einsum("pd,pd->p", queries[row], self.x[node])
            rows.append(row[sim >= least])
            nodes.append(node[sim >= least])
            go = sim >= least - margin
            row, node = row[go], node[go]
        return np.concatenate(rows), np.concatenate(nodes)
