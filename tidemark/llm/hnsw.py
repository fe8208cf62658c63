"""A hierarchical navigable small-world graph in flat numpy arrays, built and searched for many vectors at a time.

Nodes are numbered by falling level, so level l holds the nodes below counts[l], and links[l] is one array with a row of
neighbours for each of them, filled up with -1. All searches of a batch walk in lockstep: in each step every search opens the
best node of its beam that is not open yet.
"""

from __future__ import annotations

import numpy as np

#: Neighbours of a node above level 0; level 0 has twice as many.
M = 16
#: Width of the beam while building.
EF_BUILD = 64
#: Candidates among which a node's neighbours are chosen.
CHOICE = 64
#: Vectors that enter the graph, or search it, together; fewer in a large graph, since each marks the nodes it saw.
BATCH, MARKS_MB = 512, 32


def batch_of(n: int) -> int:
    return max(32, min(BATCH, MARKS_MB * 1_000_000 // (n + 1)))


def level_counts(levels: np.ndarray) -> list[int]:
    """Nodes on each level, from level 0, for levels sorted downwards."""
    return [int(np.searchsorted(-levels, -k, "right")) for k in range(int(levels[0]) + 1)]


def walk(vec: np.ndarray, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities), best first, of each query's beam on one level, from one entry node each; -1 fills up."""
    rows = np.arange(len(q))
    beam = np.full((len(q), width), -1, np.int64)
    sim = np.full((len(q), width), -np.inf, np.float32)
    opened = np.ones((len(q), width), bool)
    seen = np.zeros((len(q), len(links) + 1), bool)  # the last column stands for -1
    seen[:, -1] = True
    beam[:, 0], opened[:, 0] = entry, False
    sim[:, 0] = np.einsum("bd,bd->b", q, vec[entry])
    seen[rows, entry] = True
    while True:
        left = np.where(opened, -np.inf, sim)
        best = left.argmax(axis=1)
        go = np.flatnonzero(left[rows, best] > -np.inf)
        if not len(go):
            break
        opened[go, best[go]] = True
        near = links[beam[go, best[go]]]
        at, slot = np.nonzero(~seen[go[:, None], near])
        node, who = near[at, slot], go[at]
        seen[who, node] = True
        found = np.full(near.shape, -np.inf, np.float32)
        found[at, slot] = np.einsum("kd,kd->k", q[who], vec[node])
        better = found > sim[go].min(axis=1, keepdims=True)  # an unfilled beam has -inf
        some = np.flatnonzero(better.any(axis=1))
        if not len(some):
            continue
        go, found, near, better = go[some], found[some], near[some], better[some]
        all_sim = np.concatenate([sim[go], np.where(better, found, -np.inf)], axis=1)
        keep = np.argpartition(-all_sim, width - 1, axis=1)[:, :width]
        here = np.arange(len(go))[:, None]
        sim[go] = all_sim[here, keep]
        beam[go] = np.concatenate([beam[go], np.where(better, near, -1)], axis=1)[here, keep]
        opened[go] = np.concatenate([opened[go], ~better], axis=1)[here, keep]
    order = np.argsort(-sim, axis=1, kind="stable")
    return beam[rows[:, None], order], sim[rows[:, None], order]


def choose(vec: np.ndarray, cand: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
    """At most `most` neighbours of each row's candidates (best first, -1 fills up): first those that no chosen one is
    nearer to than the node itself, so that neighbours lie in all directions, then the best of the others."""
    valid = cand >= 0
    v = vec[cand]
    among = v @ v.transpose(0, 2, 1)
    kept = np.zeros(cand.shape, bool)
    for j in range(cand.shape[1]):
        hidden = (kept & (among[:, j] > sim[:, j, None])).any(axis=1)
        kept[:, j] = valid[:, j] & ~hidden & (kept.sum(axis=1) < most)
    order = np.argsort(np.where(kept, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(cand, order, axis=1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def _link_back(vec: np.ndarray, links: np.ndarray, new: np.ndarray, chosen: np.ndarray) -> None:
    """Give every chosen neighbour a link back to the new node; a full row is chosen anew."""
    width = links.shape[1]
    at, slot = np.nonzero(chosen >= 0)
    to, node = chosen[at, slot], new[at]
    fresh = ~(links[to] == node[:, None]).any(axis=1)
    to, node = to[fresh], node[fresh]
    if not len(to):
        return
    near = np.einsum("kd,kd->k", vec[to], vec[node])
    order = np.lexsort((-near, to))
    to, node = to[order], node[order]
    own, begin, count = np.unique(to, return_index=True, return_counts=True)
    place = np.arange(len(to)) - np.repeat(begin, count)  # 0 for the nearest
    have = (links[own] >= 0).sum(axis=1)
    fits = np.repeat(have + count <= width, count)
    links[to[fits], np.repeat(have, count)[fits] + place[fits]] = node[fits]
    full = np.flatnonzero(have + count > width)
    for lo in range(0, len(full), BATCH):
        mine = full[lo : lo + BATCH]
        cand = np.concatenate([links[own[mine]], np.full((len(mine), width), -1, links.dtype)], axis=1)
        row = np.full(len(own), -1)
        row[mine] = np.arange(len(mine))
        of = np.repeat(row, count)
        take = (of >= 0) & (place < width)
        cand[of[take], width + place[take]] = node[take]
        sim = np.where(cand >= 0, np.einsum("kd,kcd->kc", vec[own[mine]], vec[cand]), -np.inf)
        best = np.argsort(-sim, axis=1, kind="stable")
        links[own[mine]] = choose(vec, np.take_along_axis(cand, best, 1), np.take_along_axis(sim, best, 1), width)


def build(vec: np.ndarray, levels: np.ndarray) -> list[np.ndarray]:
    """links of each level for unit vectors whose levels fall."""
    counts = level_counts(levels)
    links = [np.full((n, M if k else 2 * M), -1, np.int32) for k, n in enumerate(counts)]
    done, step = 0, batch_of(len(vec))
    while done < len(vec):
        new = np.arange(done, min(len(vec), done + max(32, min(step, done)) if done else 64))
        q, entry = vec[new], np.zeros(len(new), np.int64)
        for k in range(len(counts) - 1, -1, -1):
            n = int(np.clip(counts[k] - done, 0, len(new)))  # new nodes of this level come first
            ids, sims = np.empty((n, 0), np.int64), np.empty((n, 0), np.float32)
            if done:
                if n < len(new):
                    entry[n:] = walk(vec, links[k][:done], q[n:], entry[n:], 1)[0][:, 0]
                if n:
                    ids, sims = walk(vec, links[k][:done], q[:n], entry[:n], EF_BUILD)
                    entry[:n] = ids[:, 0]
            if n:
                mates = q[:n] @ q[:n].T
                np.fill_diagonal(mates, -np.inf)
                ids = np.concatenate([ids, np.where(np.isfinite(mates), new[None, :n], -1)], axis=1)
                sims = np.concatenate([sims, mates], axis=1)
                best = np.argsort(-sims, axis=1, kind="stable")[:, :CHOICE]
                chosen = choose(vec, np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1), M)
                links[k][new[:n], :M] = chosen
                _link_back(vec, links[k], new[:n], chosen)
        done = int(new[-1]) + 1
    return links


def search(vec: np.ndarray, links: list[np.ndarray], q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, similarities) of each query's `width` nearest nodes found, best first; -1 fills up."""
    entry = np.zeros(len(q), np.int64)
    for k in range(len(links) - 1, 0, -1):
        entry = walk(vec, links[k], q, entry, 1)[0][:, 0]
    return walk(vec, links[0], q, entry, width)
