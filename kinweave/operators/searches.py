"""Searches from many sources by array kernels, for graphs that fit a task.

The ends of the arcs, as numbers, are broadcast; tasks take the sources in batches of at most 64,
a bit of a word each, and go forward level by level. What a batch holds is bounded by CELLS, what
is broadcast by MOST. Larger graphs take the joins of ``network``, by the same rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinweave.operators import graph as gr
from kinweave.session import checkpointed, numbered_rows

#: Arcs and nodes of a graph that is broadcast (8 bytes an arc), and cells of (source, node) of a batch.
MOST, CELLS = 16_000_000, 20_000_000
#: Rows of a batch that is handed on; arcs that a search looks at together.
ROWS, ARCS = 50_000, 1_000_000


class Ends(NamedTuple):
    """Arcs sorted by where they lead to, as numbers below n."""

    n: int
    u: np.ndarray
    v: np.ndarray


class Index:
    """Arcs of ``Ends`` by either end."""

    def __init__(self, ends: Ends) -> None:
        self.n, self.into = ends.n, ends.u
        self.into_at = np.concatenate([[0], np.cumsum(np.bincount(ends.v, minlength=ends.n))])
        order = np.argsort(ends.u, kind="stable")
        self.src, self.dst = ends.u[order], ends.v[order]
        self.out_at = np.concatenate([[0], np.cumsum(np.bincount(ends.u, minlength=ends.n))])

    def reached(self, front: np.ndarray, at: np.ndarray, into: np.ndarray, out_at: np.ndarray, dst: np.ndarray) -> np.ndarray:
        """Bits that arrive over one arc from ``front``: sent on from few nodes, or collected by all."""
        found = np.zeros(self.n, np.uint64)
        active = np.flatnonzero(front)
        size = out_at[active + 1] - out_at[active]
        total = int(size.sum())
        if total < len(dst) // 8:
            place = np.repeat(out_at[active] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total) if total else np.zeros(0, np.int64)
            np.bitwise_or.at(found, dst[place], np.repeat(front[active], size))
        elif len(into):
            heads = np.flatnonzero(at[1:] > at[:-1])
            found[heads] = np.bitwise_or.reduceat(front[into], at[heads])
        return found

    def levels(self, starts: np.ndarray, most: int | None, back: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(depth, number of start, node) of each level, from each of at most 64 starts on; backwards if asked."""
        way = (self.out_at, self.dst, self.into_at, self.into) if back else (self.into_at, self.into, self.out_at, self.dst)
        seen = np.zeros(self.n, np.uint64)
        np.bitwise_or.at(seen, starts, np.left_shift(np.uint64(1), np.arange(len(starts), dtype=np.uint64)))
        front, depth = seen.copy(), 0
        while True:
            nodes = np.flatnonzero(front)
            if not len(nodes):
                return
            bits = np.unpackbits(front[nodes].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            place, which = np.nonzero(bits)  # by node: its name is written once for the starts that follow each other
            yield depth, which, nodes[place]
            if most is not None and depth >= most:
                return
            front = self.reached(front, *way) & ~seen
            seen |= front
            depth += 1

    def arcs_of(self, nodes: np.ndarray, back: bool = False) -> np.ndarray:
        """Places of the arcs that leave ``nodes``, or of those that arrive."""
        at = self.into_at if back else self.out_at
        size = at[nodes + 1] - at[nodes]
        past = np.cumsum(size)
        return np.repeat(at[nodes] - past + size, size) + np.arange(past[-1] if len(past) else 0)

    @cached_property
    def outward(self) -> np.ndarray:
        """Place among the arcs by where they leave from, of the arcs by where they lead to."""
        found = np.empty(len(self.into), np.int32)
        found[np.argsort(self.into, kind="stable")] = np.arange(len(found), dtype=np.int32)
        return found

    def pieces(self, nodes: np.ndarray, back: bool = False) -> list[np.ndarray]:
        """``nodes`` in pieces of about ARCS arcs that leave them, or arrive."""
        at = self.into_at if back else self.out_at
        past = np.cumsum(at[nodes + 1] - at[nodes])
        return np.split(nodes, np.unique(np.searchsorted(past, np.arange(ARCS, past[-1], ARCS)) + 1)) if past[-1] > ARCS else [nodes]

    def flows(self, start: int, most: int | None, depth: np.ndarray, paths: np.ndarray, total: np.ndarray | None) -> np.ndarray:
        """How much of one unit for each node reached passes on from each node on shortest paths; what
        goes over each arc is added to ``total``. ``depth`` and ``paths``: room for a cell a node."""
        depth.fill(-1)
        paths.fill(0.0)
        depth[start], paths[start] = 0, 1.0
        share, unseen = np.zeros(self.n), np.ones(self.n, bool)
        unseen[start] = False
        out_size, in_size = np.diff(self.out_at), np.diff(self.into_at)

        def add(to: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            if len(at) < self.n // 16:
                np.add.at(to, at, value)
            else:
                to += np.bincount(at, value, self.n)

        steps, front, far = [], np.array([start]), 0
        while len(front) and (most is None or far < most):
            own = int(out_size.take(front).sum())
            left = np.flatnonzero(unseen) if own > len(self.dst) // 16 else front[:0]
            pull = len(left) and int(in_size.take(left).sum()) < own  # few are left: what leads to them, instead of all that leaves
            found = []
            for part in self.pieces(left if pull else front, pull):
                place = self.arcs_of(part, pull)
                if pull:
                    origin = self.into.take(place)
                    new = np.flatnonzero(depth.take(origin) == far)
                    place, origin = place.take(new), origin.take(new)
                    to = np.repeat(part, in_size.take(part)).take(new).astype(np.int32)
                    place = place.astype(np.int32) if total is None else self.outward.take(place)
                else:
                    to = self.dst.take(place)
                    new = np.flatnonzero(unseen.take(to))
                    place, to = place.take(new).astype(np.int32), to.take(new)
                    origin = self.src.take(place)
                found.append((place, origin, to))
            place, origin, to = found[0] if len(found) == 1 else (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(to):
                break
            far += 1
            carried = paths.take(origin)
            add(paths, to, carried)
            depth[to] = far
            unseen[to] = False
            front = np.unique(to) if len(to) < self.n // 64 else np.flatnonzero(depth == far)
            steps.append((place, origin, to, carried))
        while steps:
            place, origin, to, carried = steps.pop()
            if len(to) > self.n:
                with np.errstate(divide="ignore"):  # of nodes not reached, which are not taken
                    carried *= ((1 + share) / paths).take(to)
            else:
                carried *= (1 + share.take(to)) / paths.take(to)
            add(share, origin, carried)
            if total is not None:
                total[place] += carried
        return share

    def between(self, start: int, end: int, most: int | None, out: np.ndarray, back: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, depths) of the nodes on any shortest path; none where ``end`` is not reached.

        Both ends are searched in turns, the one with fewer arcs ahead first, until they meet; from
        there the paths are followed to either end. ``out`` and ``back``: -1 for each node, and left so."""
        seen, levels = (out, back), ([np.array([start])], [np.array([end])])
        out[start] = back[end] = 0
        met = levels[0][0] if start == end else levels[0][0][:0]

        def cost(side: int) -> int:
            at, front = (self.into_at if side else self.out_at), levels[side][-1]
            return int((at[front + 1] - at[front]).sum())

        ahead = [cost(0), cost(1)]
        while not len(met) and min(ahead) and (most is None or len(levels[0]) + len(levels[1]) - 2 < most):
            side = int(ahead[1] < ahead[0])
            place = self.arcs_of(levels[side][-1], bool(side))
            to = (self.into if side else self.dst)[place]
            fresh = np.unique(to[seen[side][to] < 0])
            seen[side][fresh] = len(levels[side])
            levels[side].append(fresh)
            met = fresh[seen[1 - side][fresh] >= 0]
            ahead[side] = cost(side)
        nodes, far = [], []
        if len(met):
            a, b = len(levels[0]) - 1, len(levels[1]) - 1
            nodes, far = [met], [np.full(len(met), a)]
            for side, first in ((0, a), (1, b)):
                now = met
                for k in range(first - 1, -1, -1):
                    to = (self.dst if side else self.into)[self.arcs_of(now, not side)]
                    now = np.unique(to[seen[side][to] == k])
                    nodes.append(now)
                    far.append(np.full(len(now), a + b - k if side else k))
        for side in (0, 1):
            for level in levels[side]:
                seen[side][level] = -1
        return (np.concatenate(nodes), np.concatenate(far).astype(np.int32)) if nodes else (met, met.astype(np.int32))


class Packed(NamedTuple):
    """A graph for kernels: its numbered nodes (node, k), their names in order and its arcs."""

    numbered: DataFrame
    names: pa.Array
    ends: Ends

    @property
    def kind(self) -> str:
        return dict(self.numbered.dtypes)["node"]

    def ks(self, rows: DataFrame, *columns: str) -> list[np.ndarray]:
        """Numbers of the nodes in ``columns``, row by row; rows with a node that is none are left out."""
        for c in columns:
            rows = rows.join(self.numbered.select(F.col("node").alias(c), F.col("k").alias(f"_{c}")).hint("merge"), c)
        found = rows.select(*[f"_{c}" for c in columns]).toArrow()
        return [x.to_numpy() for x in found.columns]

    def named(self, rows: DataFrame, k: str, name: str) -> DataFrame:
        return rows.join(self.numbered.select(F.col("k").alias(k), F.col("node").alias(name)).hint("merge"), k).drop(k)

    def run(self, starts: list[np.ndarray], task: Callable[[Index, pa.Array, Iterator[list[np.ndarray]]], Iterator[dict]], schema: str, pieces: int = 1) -> DataFrame:
        """What ``task`` makes of the batches of ``starts`` that it is dealt, column by column."""
        sc = self.numbered.sparkSession.sparkContext
        size = max(1, min(64, CELLS // max(1, self.ends.n)))
        busy = np.argsort(np.bincount(self.ends.u, minlength=self.ends.n)[starts[0]] == 0, kind="stable")  # those that lead somewhere first
        starts = [x[busy] for x in starts]
        tasks = max(1, min(sc.defaultParallelism * pieces, -(-len(starts[0]) // size)))
        shared = sc.broadcast((self.ends, self.names, starts))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in batch["id"].to_pylist():
                    ends, names, starts = shared.value
                    dealt = ([x[k : k + size] for x in starts] for k in range(i * size, len(starts[0]), tasks * size))
                    for columns in task(Index(ends), names, dealt):
                        yield from _handed(columns)

        return self.numbered.sparkSession.range(0, tasks, 1, tasks).mapInArrow(work, schema)


def _handed(columns: dict) -> Iterator[pa.RecordBatch]:
    """Rows in batches; a pair (array, places) is looked up batch by batch."""
    first = next(iter(columns.values()))
    for k in range(0, len(first[1] if isinstance(first, tuple) else first), ROWS):
        part = slice(k, k + ROWS)
        yield pa.RecordBatch.from_pydict({c: x[0].take(pa.array(x[1][part])) if isinstance(x, tuple) else pa.array(x[part]) for c, x in columns.items()})


def packed(g: DataFrame) -> Packed | None:
    """The graph for kernels, loops left out; None if it has more arcs and nodes than MOST."""
    arcs = checkpointed(g.where("src <> dst").select("src", "dst").distinct())
    every = checkpointed(gr.nodes(g))
    if arcs.count() + every.count() > MOST:
        return None
    numbered = checkpointed(numbered_rows(every, ["node"], "k").select("node", F.col("k").cast("int").alias("k")), every)
    own = lambda end, k: numbered.select(F.col("node").alias(end), F.col("k").alias(k)).hint("merge")  # noqa: E731  small as a file, not as a broadcast
    found = arcs.join(own("src", "u"), "src").join(own("dst", "v"), "dst").select("u", "v").toArrow()
    u, v = found["u"].to_numpy(), found["v"].to_numpy()
    order = np.argsort(v, kind="stable")
    names = numbered.orderBy("k").select("node").toArrow()["node"].combine_chunks()
    return Packed(numbered, names, Ends(len(names), u[order], v[order]))


def depths(p: Packed, sources: DataFrame, most: int | None) -> DataFrame:
    """(source, node, depth)."""
    def task(index: Index, names: pa.Array, dealt: Iterator[list[np.ndarray]]) -> Iterator[dict]:
        for (starts,) in dealt:
            for depth, which, node in index.levels(starts, most):
                yield {"source": (names, starts[which]), "node": (names, node), "depth": np.full(len(node), depth, np.int32)}

    return p.run(p.ks(sources.select("node").distinct(), "node"), task, f"source {p.kind}, node {p.kind}, depth int", 8)


def eccentricity(p: Packed, sources: DataFrame, most: int | None) -> DataFrame:
    """(node, eccentricity, reached)."""
    def task(index: Index, names: pa.Array, dealt: Iterator[list[np.ndarray]]) -> Iterator[dict]:
        for (starts,) in dealt:
            far, reached = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.int64)
            for depth, which, _ in index.levels(starts, most):
                here = np.bincount(which, minlength=len(starts))
                far[here > 0] = depth
                reached += here
            yield {"node": (names, starts), "eccentricity": far, "reached": reached}

    return p.run(p.ks(sources.select("node").distinct(), "node"), task, f"node {p.kind}, eccentricity int, reached long")


def _summed(p: Packed, sources: DataFrame, most: int | None, arcs: bool) -> DataFrame:
    def task(index: Index, names: pa.Array, dealt: Iterator[list[np.ndarray]]) -> Iterator[dict]:
        total, score = np.zeros(len(index.src)) if arcs else None, np.zeros(index.n)
        depth, paths = np.empty(index.n, np.int32), np.empty(index.n)
        for (starts,) in dealt:
            for start in starts:
                if index.out_at[start] < index.out_at[start + 1]:
                    share = index.flows(start, most, depth, paths, total)
                    share[start] = 0.0
                    score += share
        some = np.flatnonzero(total if arcs else score)
        yield {"a": index.src[some], "b": index.dst[some], "x": total[some]} if arcs else {"a": some.astype(np.int32), "x": score[some]}

    ends = ["a", "b"] if arcs else ["a"]
    parts = p.run(p.ks(sources.select("node").distinct(), "node"), task, ", ".join(f"{c} int" for c in ends) + ", x double")
    return parts.groupBy(*ends).agg(F.sum("x").alias("x"))


def betweenness(p: Packed, sources: DataFrame, most: int | None) -> DataFrame:
    """(node, score)."""
    return p.named(_summed(p, sources, most, False), "a", "node").select("node", F.col("x").alias("score"))


def edge_betweenness(p: Packed, sources: DataFrame, most: int | None) -> DataFrame:
    """(src, dst, weight)."""
    found = _summed(p, sources, most, True)
    return p.named(p.named(found, "a", "src"), "b", "dst").select("src", "dst", F.col("x").alias("weight"))


def shortest_path_nodes(p: Packed, pairs: DataFrame, most: int | None) -> DataFrame:
    """(source, target, node, depth)."""
    def task(index: Index, names: pa.Array, dealt: Iterator[list[np.ndarray]]) -> Iterator[dict]:
        out, back = np.full(index.n, -1, np.int32), np.full(index.n, -1, np.int32)
        for starts, targets in dealt:
            found = [index.between(s, t, most, out, back) for s, t in zip(starts, targets, strict=True)]
            size = [len(nodes) for nodes, _ in found]
            node, depth = (np.concatenate(x) for x in zip(*found, strict=True))
            yield {"source": (names, np.repeat(starts, size)), "target": (names, np.repeat(targets, size)), "node": (names, node), "depth": depth}

    kind = p.kind
    return p.run(p.ks(pairs.select("source", "target"), "source", "target"), task, f"source {kind}, target {kind}, node {kind}, depth int")
