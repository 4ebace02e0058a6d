"""A hierarchical navigable small-world graph over the unit vectors of one shard, built and searched in batches.

Searches advance many queries at once: each step expands the best open entries of every beam with one gather and
one product, so the work is numpy's. Layers hold a sixteenth of the layer below; the topmost is searched whole.
"""

from __future__ import annotations

import numpy as np

DEGREE = 16
SHRINK = 16
TOP = 64
CHUNK = 256
BUILD_BEAM = 64


def _select(vectors: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (best first, -1 for none) the neighbours to keep.

    A candidate nearer to a kept neighbour than to the node itself is left out unless room remains: so a tight cluster keeps
    links to what lies outside.
    """
    rows, width = cand.shape
    out = np.full((rows, degree), -1, np.int32)
    for a in range(0, rows, CHUNK):
        c, s = cand[a : a + CHUNK], sims[a : a + CHUNK]
        v = vectors[np.maximum(c, 0)]
        among = np.matmul(v, v.transpose(0, 2, 1))
        kept = np.zeros(c.shape, bool)
        for j in range(width):
            near = np.where(kept, among[:, j], -2.0).max(axis=1)
            kept[:, j] = (c[:, j] >= 0) & (near < s[:, j]) & (kept.sum(axis=1) < degree)
        # Kept ones first, then the nearest of the rest.
        rank = np.argsort(np.where(c < 0, 2, np.where(kept, 0, 1)) * width + np.arange(width), axis=1)[:, :degree]
        out[a : a + CHUNK, : rank.shape[1]] = np.take_along_axis(c, rank, axis=1)
    return out


def _merge(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1), order


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, width: int, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes found for each query from its entries; -1 where fewer."""
    all_ids, all_sims = [], []
    for a in range(0, len(queries), CHUNK):
        q, start = queries[a : a + CHUNK], entries[a : a + CHUNK]
        n = len(q)
        seen = np.zeros((n, len(links) + 1), bool)
        seen[:, -1] = True
        row = np.arange(n)[:, None]
        seen[row, start] = True
        sims = np.where(start >= 0, np.einsum("qkd,qd->qk", vectors[start], q), -np.inf)
        pad = max(0, width - start.shape[1])
        ids = np.pad(start, ((0, 0), (0, pad)), constant_values=-1)
        ids, sims, _ = _merge(ids, np.pad(sims, ((0, 0), (0, pad)), constant_values=-np.inf), width)
        open_ = ids >= 0
        while open_.any():
            pick = np.argsort(np.where(open_, -sims, np.inf), axis=1, kind="stable")[:, :step]
            live = np.take_along_axis(open_, pick, axis=1)
            nodes = np.where(live, np.take_along_axis(ids, pick, axis=1), -1)
            np.put_along_axis(open_, pick, False, axis=1)
            near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(n, -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            near[seen[row, near]] = -1
            seen[row, near] = True
            busy = np.flatnonzero((near >= 0).any(axis=1))
            if not len(busy):
                continue
            fresh = near[busy]
            got = np.where(fresh >= 0, np.einsum("qkd,qd->qk", vectors[fresh], q[busy]), -np.inf)
            i, s, order = _merge(np.concatenate([ids[busy], fresh], axis=1), np.concatenate([sims[busy], got], axis=1), width)
            flags = np.concatenate([open_[busy], fresh >= 0], axis=1)
            ids[busy], sims[busy] = i, s
            open_[busy] = np.take_along_axis(flags, order, axis=1) & (i >= 0)
        all_ids.append(ids)
        all_sims.append(sims)
    return np.concatenate(all_ids), np.concatenate(all_sims)


def _nearest(vectors: np.ndarray, among: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact nearest of few nodes, for layers and batches small enough."""
    sims = queries @ vectors[among].T
    order = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    return among[order].astype(np.int32), np.take_along_axis(sims, order, axis=1)


def _connect(vectors: np.ndarray, links: np.ndarray, nodes: np.ndarray, cand: np.ndarray, sims: np.ndarray) -> None:
    """Link new nodes to their selected candidates, both ways; full nodes select anew."""
    degree = links.shape[1]
    links[nodes] = _select(vectors, cand, sims, degree)
    to = links[nodes]
    src = np.repeat(nodes, degree)[to.ravel() >= 0]
    dst = to.ravel()[to.ravel() >= 0]
    touched = np.unique(dst)
    old = links[touched]
    a = np.concatenate([dst, np.repeat(touched, degree)[old.ravel() >= 0]])
    b = np.concatenate([src, old.ravel()[old.ravel() >= 0]])
    a, b = np.unique(np.stack([a, b]), axis=1)
    s = np.einsum("ed,ed->e", vectors[a], vectors[b])
    order = np.lexsort((b, -s, a))
    a, b, s = a[order], b[order], s[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
    width = 3 * degree
    keep = place < width
    rows = np.searchsorted(touched, a[keep])
    c = np.full((len(touched), width), -1, np.int32)
    d = np.full((len(touched), width), -np.inf, vectors.dtype)
    c[rows, place[keep]], d[rows, place[keep]] = b[keep], s[keep]
    links[touched] = _select(vectors, c, d, degree)


class Graph:
    """``layers``: from the top down, the nodes of each layer and their links (rows of all nodes, -1 for none)."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray] | None = None):
        self.vectors = vectors
        self.order = np.random.default_rng(5).permutation(len(vectors))
        self.sizes = [len(vectors)]
        while self.sizes[0] > TOP:
            self.sizes.insert(0, -(-self.sizes[0] // SHRINK))
        self.layers = layers if layers is not None else []
        if layers is None:
            self._build()

    def _build(self) -> None:
        for depth, size in enumerate(self.sizes[1:], 1):
            degree = DEGREE * (2 if depth == len(self.sizes) - 1 else 1)
            links = np.full((len(self.vectors), degree), -1, np.int32)
            base = self.order[: self.sizes[depth - 1]]
            self.layers.append(links)
            for a in range(0, len(base), 1024):  # the nodes of the layer above, a sixteenth, know each other
                some = base[a : a + 1024]
                cand, sims = _nearest(self.vectors, base, self.vectors[some], min(len(base), 2 * degree + 1))
                self_ = cand == some[:, None]
                _connect(self.vectors, links, some, np.where(self_, -1, cand), np.where(self_, -np.inf, sims))
            done = len(base)
            while done < size:
                stop = min(size, done + min(done, 1024))
                new = self.order[done:stop]
                q = self.vectors[new]
                found, sims = self._descend(q, depth, BUILD_BEAM)
                mates, near = _nearest(self.vectors, new, q, min(len(new), degree + 1))
                near = np.where(mates == new[:, None], -np.inf, near)
                mates = np.where(mates == new[:, None], -1, mates)
                cand, sims, _ = _merge(np.concatenate([found, mates], axis=1), np.concatenate([sims, near], axis=1), BUILD_BEAM)
                _connect(self.vectors, links, new, cand, sims)
                done = stop

    def _descend(self, queries: np.ndarray, depth: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        ids, sims = _nearest(self.vectors, self.order[: self.sizes[0]], queries, min(8, self.sizes[0]))
        for d in range(1, depth + 1):
            ids, sims = beam(self.vectors, self.layers[d - 1], queries, ids, width if d == depth else 16)
            if d < depth:
                ids = ids[:, :8]
        return ids, sims

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.sizes) == 1 or width >= len(self.vectors):
            return _nearest(self.vectors, np.arange(len(self.vectors)), queries, len(self.vectors))
        return self._descend(queries, len(self.sizes) - 1, width)
