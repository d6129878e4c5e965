"""Hierarchical navigable small-world graphs in numpy; queries walk in lockstep, a block at a time.

Nodes are in random order and level ``l`` is the first ``n / m**l`` of them, so a node has one number on
all its levels. A level is filled in batches: a batch finds its neighbours among the nodes before it (a
walk down from the top) and in itself, keeps a varied choice of them and is linked back.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

#: Links of a node above the bottom level, where there are twice as many; beam while building.
LINKS, BUILD_BEAM = 16, 64
BATCH, BLOCK = 512, 256
#: Best nodes of each beam that are expanded at once.
STEP = 4
#: Float32 products may be off by this much; hits are verified in double precision.
SLACK = 1e-5


@dataclass
class Graph:
    """Unit vectors (float32) and the links of each level, -1 where there is none."""

    x: np.ndarray
    levels: list[np.ndarray]


def beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities), best first, that a walk with a beam of ``width`` ends with; -1 where it found fewer."""
    rows = np.arange(len(q))
    seen = np.zeros((len(q), len(links)), bool)
    ids = np.full((len(q), width), -1, np.int32)
    sims = np.full((len(q), width), -np.inf, np.float32)
    open_ = np.zeros((len(q), width), bool)
    n = min(width, entry.shape[1])
    entry = entry[:, :n]
    there = entry >= 0
    seen[np.repeat(rows, n), np.where(there, entry, entry[:, :1]).ravel()] = True
    ids[:, :n], open_[:, :n] = entry, there
    sims[:, :n] = np.where(there, np.einsum("bmd,bd->bm", x[entry], q), -np.inf)
    active = rows
    while len(active):
        step = min(STEP, width)
        waiting = np.where(open_[active], sims[active], -np.inf)
        pick = np.argpartition(-waiting, step - 1, axis=1)[:, :step] if step < width else np.tile(np.arange(width), (len(active), 1))
        value = np.take_along_axis(waiting, pick, 1)
        going = value.max(axis=1) > -np.inf
        active, pick, value = active[going], pick[going], value[going]
        if not len(active):
            break
        open_[active[:, None], pick] = False
        near = links[np.where(value > -np.inf, ids[active[:, None], pick], 0)]
        near = np.where(value[:, :, None] > -np.inf, near, -1).reshape(len(active), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        at, place = np.nonzero(fresh)
        new = ~seen[active[at], near[at, place]]
        fresh[at[~new], place[~new]] = False
        at, place = at[new], place[new]
        seen[active[at], near[at, place]] = True
        found = np.full(near.shape, -np.inf, np.float32)
        found[at, place] = np.einsum("nd,nd->n", x[near[at, place]], q[active[at]])
        # Only the best of the old beam and the new nodes stay; closed ones are marked as such.
        all_sims = np.concatenate([sims[active], found], axis=1)
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[active] = np.take_along_axis(all_sims, best, 1)
        ids[active] = np.take_along_axis(np.concatenate([ids[active], near], axis=1), best, 1)
        open_[active] = np.take_along_axis(np.concatenate([open_[active], fresh], axis=1), best, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    return np.where(sims > -np.inf, ids, -1), sims


def descend(graph: Graph, q: np.ndarray, level: int) -> np.ndarray:
    """Where a walk down from the top enters ``level``."""
    entry = np.zeros((len(q), 1), np.int32)
    for links in graph.levels[:level:-1]:
        entry = beam(graph.x[: len(links)], links, q, entry, STEP)[0]
    return entry


def varied(x: np.ndarray, ids: np.ndarray, sims: np.ndarray, limit: int) -> np.ndarray:
    """At most ``limit`` of each row's candidates (best first): those nearer to the row than to any taken before, then
    the nearest of the rest."""
    among = x[np.maximum(ids, 0)]
    pair = np.matmul(among, among.transpose(0, 2, 1))
    taken = np.zeros(ids.shape, bool)
    closest = np.full(ids.shape, -np.inf, np.float32)
    count = np.zeros(len(ids), np.int64)
    for c in range(ids.shape[1]):
        good = (ids[:, c] >= 0) & (sims[:, c] > closest[:, c]) & (count < limit)
        taken[:, c] = good
        count += good
        closest = np.where(good[:, None], np.maximum(closest, pair[:, c]), closest)
    order = np.argsort(~taken + 2 * (ids < 0), axis=1, kind="stable")[:, :limit]
    return np.take_along_axis(ids, order, 1)


def _sorted(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _link_back(x: np.ndarray, links: np.ndarray, batch: np.ndarray, chosen: np.ndarray) -> None:
    """Add a batch's nodes to the links of those they chose."""
    room = links.shape[1]
    target = chosen.ravel()
    source = np.repeat(batch, chosen.shape[1])[target >= 0]
    target = target[target >= 0]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    nodes, first, n = np.unique(target, return_index=True, return_counts=True)
    # In blocks of like numbers of new links, so that a much chosen node does not widen all rows.
    by_count = np.argsort(n, kind="stable")
    for block in np.array_split(by_count, max(1, len(nodes) // BLOCK)):
        if not len(block):
            continue
        wide = int(n[block].max())
        place = first[block][:, None] + np.arange(wide)
        added = np.where(np.arange(wide) < n[block][:, None], source[np.minimum(place, len(source) - 1)], -1)
        old = links[nodes[block]]
        added = np.where((added[:, :, None] == old[:, None, :]).any(axis=2), -1, added)
        ids = np.concatenate([old, added], axis=1).astype(np.int32)
        sims = np.einsum("bmd,bd->bm", x[np.maximum(ids, 0)], x[nodes[block]])
        sims = np.where(ids >= 0, sims, -np.inf)
        full = (ids >= 0).sum(axis=1) > room
        ids, sims = _sorted(ids, sims, max(room, min(ids.shape[1], 4 * room)))
        out = ids[:, :room].copy()
        if full.any():
            out[full] = varied(x, ids[full], sims[full], room)
        links[nodes[block]] = out


def build(vectors: np.ndarray, m: int = LINKS, width: int = BUILD_BEAM) -> Graph:
    """The graph of unit vectors, which should be in random order."""
    x = np.ascontiguousarray(vectors, np.float32)
    sizes = [len(x)]
    while sizes[-1] > m:
        sizes.append(-(-sizes[-1] // m))
    graph = Graph(x, [np.zeros((s, m), np.int32) for s in sizes])
    for level in range(len(sizes) - 1, -1, -1):
        size, room = sizes[level], 2 * m if level == 0 else m
        above = sizes[level + 1] if level + 1 < len(sizes) else size
        links = graph.levels[level] = np.full((size, room), -1, np.int32)
        at = 0
        while at < size:
            stop = min(size, at + min(BATCH, max(at, 64)))
            batch = np.arange(at, stop, dtype=np.int32)
            q = x[batch]
            inner = q @ q.T
            np.fill_diagonal(inner, -np.inf)
            ids = np.broadcast_to(batch, inner.shape)
            ids, sims = _sorted(ids, inner, room)
            ids = np.where(sims > -np.inf, ids, -1)
            if at:
                entry = descend(graph, q, level) if at >= above else np.zeros((len(q), 1), np.int32)
                far, far_sims = beam(x[:size], links, q, entry, width)
                ids, sims = _sorted(np.concatenate([far, ids], axis=1), np.concatenate([far_sims, sims], axis=1), width + room)
            chosen = varied(x, ids, sims, m)
            links[batch, : chosen.shape[1]] = chosen
            _link_back(x, links, batch, chosen)
            at = stop
    return graph


def hits(graph: Graph, q: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, node) of the pairs of similarity ``least`` or more that walks find.

    A beam that ends full of hits may have missed some: its query walks again with one four times as wide. A beam
    that would hold a quarter of the nodes holds all of them, that is a scan.
    """
    rows, cols = [], []
    waiting = np.arange(len(q))
    while len(waiting):
        again = []
        for part in np.array_split(waiting, -(-len(waiting) // BLOCK)):
            if 4 * width >= len(graph.x):
                near = q[part] @ graph.x.T >= least - SLACK
                r, c = np.nonzero(near)
                rows.append(part[r])
                cols.append(c)
                continue
            ids, sims = beam(graph.x, graph.levels[0], q[part], descend(graph, q[part], 0), width)
            full = sims[:, -1] >= least - SLACK
            again.append(part[full])
            r, c = np.nonzero((sims >= least - SLACK) & ~full[:, None])
            rows.append(part[r])
            cols.append(ids[r, c])
        waiting = np.concatenate(again) if again else waiting[:0]
        width *= 4
    return np.concatenate(rows) if rows else np.zeros(0, np.int64), np.concatenate(cols) if cols else np.zeros(0, np.int64)


def audited(graph: Graph, q: np.ndarray, least: float, width: int, recall: float) -> int:
    """The first beam, from ``width`` on and doubled each time, that finds a share ``recall`` of all hits of ``q`` (a scan tells)."""
    true = int((q @ graph.x.T >= least).sum())
    while 4 * width < len(graph.x) and len(hits(graph, q, least, width)[0]) < recall * true:
        width *= 2
    return width


def dump(graph: Graph, **more: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, x=graph.x, **{f"level{i}": links for i, links in enumerate(graph.levels)}, **more)
    return out.getvalue()


def load(data: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
    held = dict(np.load(io.BytesIO(data)))
    levels = [held.pop(f"level{i}") for i in range(sum(k.startswith("level") for k in held))]
    return Graph(held.pop("x"), levels), held
