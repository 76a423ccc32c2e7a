"""Flow to its end by array kernels: columns of several components, as sorted arrays of entries.

A round squares the columns piece by piece, prunes each piece and keeps what is left, so that a task
holds the pruned columns, twice, and one piece of products. Nodes are numbered component by component;
a component leaves when it has settled. Its square is a product of dense matrices where that is less
work, a piece of its columns at a time. A component that outgrows ENTRIES is given up, for the distributed loop of ``flow``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from kinweave.config import FlowConfig

#: Products of a piece, entries of the pruned columns of a task, nodes of a dense matrix.
PATHS, ENTRIES, DENSE = 2_000_000, 32_000_000, 6000
#: Products of a round above which a component that is no dense matrix is given up, to be dealt out to tasks.
WORK = 2_000_000_000
#: Products of sparse columns in the time of so many multiplications of dense matrices.
PER_PATH = 200


def prune_column(v: np.ndarray, cfg: FlowConfig) -> np.ndarray:
    """A column with its small entries removed: those below the cutoff go, the largest come back
    if little mass is left, the smallest go if too many are left."""
    keep = v >= 0.99999 / cfg.prune
    if keep.sum() < cfg.recover and v[keep].sum() < cfg.mass:
        keep = v >= max(np.partition(v, -cfg.recover)[-cfg.recover] if len(v) > cfg.recover else 0.0, np.finfo(float).tiny)
    elif keep.sum() > cfg.select:
        bar = np.partition(v, -cfg.select)[-cfg.select]
        chosen = v >= bar
        if chosen.sum() > cfg.select and (v > bar).any():
            chosen = v > bar
        if chosen.sum() < cfg.recover and v[chosen].sum() < cfg.mass:
            pool = np.where(keep, v, 0.0)
            chosen = keep if keep.sum() <= cfg.recover else pool >= np.partition(pool, -cfg.recover)[-cfg.recover]
        keep = chosen
    return np.where(keep, v, 0.0)


def _pieces(at: np.ndarray, v: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, tuple[int, int] | None]]:
    """(first column, column after the last, the component's bounds if dense) of pieces of about PATHS products, or cells if dense."""
    size = np.diff(at)
    paths = np.concatenate([[0], np.cumsum(size[v])])[at]
    own = np.diff(bounds)
    dense = (own <= DENSE) & (np.diff(paths[bounds]) * PER_PATH > own.astype(float) ** 3)
    turns = np.flatnonzero(np.diff(dense)) + 1
    for i, j in zip([0, *turns], [*turns, len(own)], strict=True):
        if dense[i]:
            for k in range(i, j):
                first, last = int(bounds[k]), int(bounds[k + 1])
                step = max(1, PATHS // (last - first))
                yield from ((a, min(a + step, last), (first, last)) for a in range(first, last, step))
        else:
            low, high = bounds[i], bounds[j]
            cuts = np.searchsorted(paths, np.arange(paths[low], paths[high], PATHS), "right") - 1
            cuts = np.unique([low, *cuts[cuts > low], high])
            yield from ((int(a), int(b), None) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if at[b] > at[a])


def ranges(at: np.ndarray, v: np.ndarray, low: int, high: int) -> Iterator[tuple[int, int]]:
    """The columns from ``low`` to before ``high`` in pieces of about PATHS products."""
    part = v[at[low] : at[high]]
    paths = np.concatenate([[0], np.cumsum(at[part + 1] - at[part])])[at[low : high + 1] - at[low]]
    cuts = np.unique([0, *np.searchsorted(paths, np.arange(PATHS, paths[-1], PATHS)), high - low]) + low
    yield from zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _square(at: np.ndarray, v: np.ndarray, w: np.ndarray, low: int, high: int, dense: tuple[int, int] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column - low, row, value) of the square's columns from ``low`` to before ``high``, sorted."""
    own = slice(at[low], at[high])
    src = np.repeat(np.arange(high - low), np.diff(at[low : high + 1]))
    if dense:
        first, last = dense
        every = slice(at[first], at[last])
        m = np.zeros((last - first, last - first))
        m[np.repeat(np.arange(last - first), np.diff(at[first : last + 1])), v[every] - first] = w[every]
        m = m[low - first : high - first] @ m
        src, dst = np.nonzero(m)
        return src, dst + first, m[src, dst]
    k, n = v[own], len(at) - 1
    size = at[k + 1] - at[k]
    place = np.repeat(at[k] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
    key, value = np.repeat(src, size) * n + v[place], np.repeat(w[own], size) * w[place]
    if (high - low) * n <= 4 * len(key):
        found = np.bincount(key, value, (high - low) * n)
        key = np.flatnonzero(found)
        return *np.divmod(key, n), found[key]
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    src, dst = np.divmod(key[first], n)
    return src, dst, np.add.reduceat(value[order], first)


def _pruned(src: np.ndarray, e: np.ndarray, n: int, cfg: FlowConfig) -> np.ndarray:
    """Which entries of n columns ``prune_column`` keeps."""
    keep = e >= 0.99999 / cfg.prune
    count, mass = np.bincount(src[keep], minlength=n), np.bincount(src[keep], e[keep], n)
    at = np.concatenate([[0], np.cumsum(np.bincount(src, minlength=n))])
    for i in np.flatnonzero((count > cfg.select) | ((count < cfg.recover) & (mass < cfg.mass))):
        own = slice(at[i], at[i + 1])
        keep[own] = prune_column(e[own], cfg) > 0
    return keep


def _starts(u: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(u, minlength=n))])


def expanded(at: np.ndarray, v: np.ndarray, w: np.ndarray, low: int, high: int, dense: tuple[int, int] | None, cfg: FlowConfig, power: float) -> tuple[np.ndarray, ...]:
    """(u, v, w, chaos of each column) of the columns from ``low`` to before ``high`` after one round."""
    src, dst, e = _square(at, v, w, low, high, dense)
    c = high - low
    most, own = np.zeros(c), np.flatnonzero(np.diff(src, prepend=-1))
    most[src[own]] = np.maximum.reduceat(e, own) if len(own) else 0.0
    centre = np.bincount(src, e * e, c)
    keep = _pruned(src, e, c, cfg)
    src, dst, e = src[keep], dst[keep], e[keep]
    chaos = (most - centre) * np.bincount(src, minlength=c)
    e = (e / np.bincount(src, e, c)[src]) ** power
    return (src + low).astype(np.int32), dst.astype(np.int32), e / np.bincount(src, e, c)[src], chaos


def settle(bounds: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray, cfg: FlowConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, w, open): the entries of the limit, sorted by column, and which components were given up.

    u, v, w: entries sorted by column u, columns summing to 1. bounds: the first node of each component,
    and their number; every node has an entry."""
    n, done = int(bounds[-1]), []
    part = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    running = np.ones(len(bounds) - 1, bool)
    given_up = np.zeros(len(bounds) - 1, bool)
    v = v.astype(np.int32)
    at = _starts(u, n)
    for rounds in range(cfg.most_rounds):
        if n > DENSE and len(bounds) == 2 and int(np.diff(at)[v].sum()) > WORK:
            given_up |= running
            break
        chaos, found, held = np.zeros(n), [], 0
        for low, high, dense in _pieces(at, v, bounds):
            *columns, chaos[low:high] = expanded(at, v, w, low, high, dense, cfg, cfg.power(rounds))
            found.append(columns)
            held += len(columns[0])
            if held > ENTRIES:
                given_up |= running
                break
        if given_up.any():
            break
        u, v, w = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        if rounds >= cfg.initial_rounds:
            ended = running & (np.maximum.reduceat(chaos, bounds[:-1]) < cfg.chaos)
            if ended.any():
                out = ended[part[u]]
                done.append((u[out], v[out], w[out]))
                u, v, w = u[~out], v[~out], w[~out]
                running &= ~ended
        if not running.any():
            break
        at = _starts(u, n)
    if not given_up.any():
        done.append((u, v, w))
    u, v, w = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (u[:0], v[:0], w[:0])
    order = np.argsort(u, kind="stable")
    return u[order], v[order], w[order], given_up


def settle_all(bounds: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray, cfg: FlowConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same, with no more components at a time than fit ENTRIES however full their columns get, so
    that only one that is alone can be given up."""
    at, own = _starts(u, int(bounds[-1])), np.diff(bounds).astype(np.int64) ** 2
    found, first, cells = [], 0, 0
    for k in range(len(own)):
        cells += own[k]
        if k + 1 < len(own) and cells + own[k + 1] <= ENTRIES:
            continue
        low, part = bounds[first], slice(at[bounds[first]], at[bounds[k + 1]])
        a, b, x, open_ = settle(bounds[first : k + 2] - low, u[part] - low, v[part] - low, w[part], cfg)
        found.append((a + low, b + low, x, open_))
        first, cells = k + 1, 0
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def interpret(n: int, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Cluster number of each node, from the entries of the limit."""
    own, most = np.zeros(n), np.zeros(n)
    own[u[u == v]] = w[u == v]
    np.maximum.at(most, u, w)
    bar = np.where(own >= most, own / 1.01, 0.999 * own + 0.001 * most)
    keep = w >= bar[u]
    u, v = u[keep], v[keep]
    attractor = np.zeros(n, bool)
    attractor[u[u == v]] = True
    label = np.where(attractor, np.arange(n), n)
    both = attractor[u] & attractor[v]
    a, b = np.concatenate([u[both], v[both]]), np.concatenate([v[both], u[both]])
    out, to = u[~attractor[u]], v[~attractor[u]]
    for x, y in ((a, b), (out, to)):  # attractors that feed each other are one cluster; the others follow their arcs
        while True:
            new = label.copy()
            np.minimum.at(new, x, label[y])
            if (new == label).all():
                break
            label = new
    return np.where(label == n, np.arange(n), label)


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of the component of each node."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, u, label[v])
        np.minimum.at(new, v, label[u])
        new = new[new]
        if (new == label).all():
            return label
        label = new
