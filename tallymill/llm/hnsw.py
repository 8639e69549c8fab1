"""Hierarchical navigable small-world graph over one shard of vectors, searched for many queries at once."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np

DEGREE = 16
BUILD_BEAM = 48
BATCH = 256
# Beam entries that are expanded in one step, and cosines that a scan computes at once.
STEP = 4
SCANNED = 1 << 22


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


class Forest:
    """Connected nodes and queries, the smaller number standing for both; queries come after the nodes."""

    def __init__(self, nodes: int, queries: int):
        self.nodes, self.root = nodes, np.arange(nodes + queries)

    def add(self, query: np.ndarray, node: np.ndarray) -> None:
        left, right = query + self.nodes, node
        while len(left):
            low = np.minimum(self.root[left], self.root[right])
            for side in (self.root[left], self.root[right]):
                np.minimum.at(self.root, side, low)
            while True:
                following = self.root[self.root]
                if (following == self.root).all():
                    break
                self.root = following
            apart = self.root[left] != self.root[right]
            left, right = left[apart], right[apart]

    def add_marked(self, query: np.ndarray, marked: np.ndarray) -> None:
        """Links given by a row of marks for each query: a few of them connect nearly all, the rest is few."""
        rows, columns = np.flatnonzero(marked.any(1)), np.flatnonzero(marked.any(0))
        self.add(query[rows], marked[rows].argmax(1))
        self.add(query[marked[:, columns].argmax(0)], columns)
        row, column = np.nonzero(marked & (self.root[query + self.nodes][:, None] != self.root[: self.nodes]))
        self.add(query[row], column)


class Graph:
    """Layers of neighbour lists over vectors, compared as unit vectors; layer 0 holds all of them, each next one a 16th."""

    def __init__(self, given: np.ndarray, levels: np.ndarray, layers: list[np.ndarray], entry: int):
        self.given, self.levels, self.layers, self.entry = given, levels, layers, entry
        self.vectors = unit(given.astype(np.float64)) if len(given) else given.astype(np.float64)
        self.quick = self.vectors.astype(np.float32)

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 0) -> Graph:
        count = len(vectors)
        random = np.random.default_rng(seed)
        levels = np.minimum(-np.log(1 - random.random(count)) / np.log(DEGREE), 8).astype(np.int64)
        top = int(levels.max()) if count else 0
        layers = [np.full((count, 2 * DEGREE if layer == 0 else DEGREE), -1, np.int32) for layer in range(top + 1)]
        graph = cls(vectors, levels, layers, -1)
        order = random.permutation(count)
        done = 0
        while done < count:
            # Batches grow with the graph, so that most neighbours are in it already.
            size = min(BATCH, max(16, done // 2))
            graph._insert(order[done : done + size])
            done += size
        return graph

    def _insert(self, batch: np.ndarray) -> None:
        queries = self.quick[batch]
        mutual = queries @ queries.T
        np.fill_diagonal(mutual, -2)
        starts = np.full((len(batch), 1), self.entry, np.int64)
        top = int(self.levels[self.entry]) if self.entry >= 0 else -1
        for layer in range(len(self.layers) - 1, -1, -1):
            here = np.flatnonzero(self.levels[batch] >= layer)
            if layer <= top:
                ids, sims = self._beam(queries, starts, layer, BUILD_BEAM if len(here) else 1)
                starts = ids[:, :8]
            else:
                ids, sims = np.full((len(batch), 0), -1, np.int64), np.zeros((len(batch), 0), np.float32)
            if not len(here):
                continue
            near = np.argsort(-mutual[np.ix_(here, here)], axis=1)[:, : min(len(here) - 1, BUILD_BEAM)]
            ids = np.concatenate([ids[here], batch[here][near]], axis=1)
            sims = np.concatenate([sims[here], np.take_along_axis(mutual[np.ix_(here, here)], near, 1)], axis=1)
            if ids.shape[1]:
                self._connect(batch[here], ids, sims, layer)
        best = batch[np.argmax(self.levels[batch])]
        if self.entry < 0 or self.levels[best] > top:
            self.entry = int(best)

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row of candidates the ones that no chosen one is closer to than the node is, then the closest."""
        rows, width = ids.shape
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * most]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        usable = ids >= 0
        vectors = self.quick[np.where(usable, ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        chosen = np.zeros_like(usable)
        for at in range(ids.shape[1]):
            shadowed = (chosen[:, :at] & (between[:, at, :at] > sims[:, at : at + 1])).any(1)
            chosen[:, at] = usable[:, at] & ~shadowed & (chosen[:, :at].sum(1) < most)
        # Places that are left go to the closest of the rest.
        rank = np.where(chosen, 0, np.where(usable, 1, 2)) * ids.shape[1] + np.arange(ids.shape[1])
        order = np.argsort(rank, axis=1)[:, :most]
        result = np.take_along_axis(np.where(usable, ids, -1), order, 1)
        return np.pad(result, ((0, 0), (0, most - result.shape[1])), constant_values=-1)

    def _connect(self, nodes: np.ndarray, ids: np.ndarray, sims: np.ndarray, layer: int) -> None:
        table = self.layers[layer]
        most = table.shape[1]
        picked = self._diverse(ids, sims, DEGREE)
        # Ids of a row are distinct: the beam holds older nodes only, the batch the others.
        table[nodes, :DEGREE] = picked
        sources = np.repeat(nodes, picked.shape[1])
        targets = picked.ravel()
        sources, targets = sources[targets >= 0], targets[targets >= 0]
        order = np.argsort(targets, kind="stable")
        sources, targets = sources[order], targets[order]
        firsts = np.flatnonzero(np.r_[True, targets[1:] != targets[:-1]]) if len(targets) else np.empty(0, int)
        crowded = []
        for begin, end in zip(firsts, np.r_[firsts[1:], len(targets)], strict=True):
            target = targets[begin]
            row = table[target]
            own = row[row >= 0]
            merged = np.unique(np.concatenate([own, sources[begin:end]]))
            if len(merged) <= most:
                row[: len(merged)] = merged
                row[len(merged) :] = -1
            else:
                crowded.append((target, merged))
        if crowded:
            width = max(len(merged) for _, merged in crowded)
            candidates = np.full((len(crowded), width), -1, np.int64)
            for at, (_, merged) in enumerate(crowded):
                candidates[at, : len(merged)] = merged
            owners = np.array([target for target, _ in crowded])
            for begin in range(0, len(owners), BATCH):
                part = slice(begin, begin + BATCH)
                near = np.einsum("ijk,ik->ij", self.quick[np.maximum(candidates[part], 0)], self.quick[owners[part]])
                near[candidates[part] < 0] = -3
                table[owners[part]] = self._diverse(candidates[part], near, most)

    def _beam(self, queries: np.ndarray, starts: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` closest nodes found for each query, closest first; -1 where there are fewer."""
        count, rows = len(self.quick), len(queries)
        table = self.layers[layer]
        seen = np.zeros((rows, count), bool)
        ids = np.full((rows, width), -1, np.int64)
        sims = np.full((rows, width), -3, np.float32)
        expanded = np.ones((rows, width), bool)
        fresh_rows = np.repeat(np.arange(rows), starts.shape[1])
        fresh = starts.ravel()
        while True:
            real = fresh >= 0
            flat = np.unique(fresh_rows[real] * count + fresh[real])
            flat = flat[~seen.ravel()[flat]]
            if not len(flat):
                moved = np.empty(0, np.int64)
            else:
                seen.ravel()[flat] = True
                at, node = flat // count, flat % count
                near = np.einsum("ij,ij->i", self.quick[node], queries[at])
                firsts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
                sizes = np.diff(np.r_[firsts, len(at)])
                moved = at[firsts]
                place = np.arange(len(at)) - np.repeat(firsts, sizes)
                group = np.repeat(np.arange(len(moved)), sizes)
                wide = int(sizes.max())
                new_ids = np.full((len(moved), wide), -1, np.int64)
                new_sims = np.full((len(moved), wide), -3, np.float32)
                new_ids[group, place], new_sims[group, place] = node, near
                all_ids = np.concatenate([ids[moved], new_ids], axis=1)
                all_sims = np.concatenate([sims[moved], new_sims], axis=1)
                all_done = np.concatenate([expanded[moved], new_ids < 0], axis=1)
                order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
                ids[moved] = np.take_along_axis(all_ids, order, 1)
                sims[moved] = np.take_along_axis(all_sims, order, 1)
                expanded[moved] = np.take_along_axis(all_done, order, 1)
            todo = ~expanded
            active = np.flatnonzero(todo.any(1))
            if not len(active):
                return ids, sims
            first = np.argsort(~todo[active], axis=1, kind="stable")[:, :STEP]
            open_ = np.take_along_axis(todo[active], first, 1)
            nodes = np.where(open_, np.take_along_axis(ids[active], first, 1), -1)
            expanded[active[:, None], first] = True
            fresh = np.where(nodes[:, :, None] >= 0, table[np.maximum(nodes, 0)], -1).reshape(len(active), -1)
            fresh_rows = np.repeat(active, fresh.shape[1])
            fresh = fresh.ravel()

    def _rows(self) -> int:
        """Queries at once, so that what has been seen takes a bounded amount of memory."""
        return max(16, min(1024, (1 << 26) // max(1, len(self.quick))))

    def matches(self, queries: np.ndarray, least: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Nodes of a cosine of ``least`` or more to the queries, verified in double precision, in parts of bounded size.

        A part is ``(query, node)`` pairs or, where the second array has two axes, some queries and for each of them a row
        that marks their nodes. The parts of a query do not overlap. A beam that is full of such nodes is doubled once for the
        queries it concerns; a query whose beam is full again is compared with all nodes, which is cheaper than
        walking among so many.
        """
        count = len(self.quick)
        if not count or not len(queries):
            return
        exact = unit(queries.astype(np.float64))
        for begin in range(0, len(queries), self._rows()):
            part = np.arange(begin, min(begin + self._rows(), len(queries)))
            if width >= count:
                yield from self._scan(exact, part, least)
                continue
            quick = exact[part].astype(np.float32)
            starts = np.full((len(part), 1), self.entry, np.int64)
            for layer in range(int(self.levels[self.entry]), 0, -1):
                starts = self._beam(quick, starts, layer, 4)[0]
            for beam in (width, 2 * width):
                if not len(part) or beam >= count:
                    break
                ids, sims = self._beam(quick, starts, 0, beam)
                full = sims[:, -1] >= least - 0.01
                at, place = np.nonzero((sims >= least - 0.001) & ~full[:, None])
                query, node = part[at], ids[at, place]
                close = np.einsum("ij,ij->i", exact[query], self.vectors[node]) >= least
                yield query[close], node[close]
                part, quick, starts = part[full], quick[full], ids[full][:, :64]
            yield from self._scan(exact, part, least)

    def _scan(self, exact: np.ndarray, part: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, SCANNED // len(self.vectors))
        for begin in range(0, len(part), step):
            some = part[begin : begin + step]
            near = exact[some] @ self.vectors.T
            close = near >= least
            # Matrix products round differently from one shape to the next.
            row, node = np.nonzero(np.abs(near - least) < 1e-9)
            close[row, node] = np.einsum("ij,ij->i", exact[some[row]], self.vectors[node]) >= least
            yield some, close

    def to_bytes(self, **more: np.ndarray) -> bytes:
        out = io.BytesIO()
        layers = {f"layer{at}": table for at, table in enumerate(self.layers)}
        np.savez(out, given=self.given, levels=self.levels, entry=np.array(self.entry), **layers, **more)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
        with np.load(io.BytesIO(data)) as file:
            arrays = {name: file[name] for name in file.files}
        layers = [arrays.pop(f"layer{at}") for at in range(sum(name.startswith("layer") for name in arrays))]
        return cls(arrays.pop("given"), arrays.pop("levels"), layers, int(arrays.pop("entry"))), arrays
