"""Segmentation that is sequential by nature: grouped-map functions, one bounded episode at a time."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


class PrefixMaxima:
    """The greatest entry among places 0 to p, by a Fenwick tree: entries only grow."""

    def __init__(self, size: int):
        self.tree = [(0.0, 1)] * (size + 1)

    def upto(self, place: int) -> tuple[float, int]:
        best, i = (0.0, 1), place + 1
        while i:
            best = max(best, self.tree[i])
            i &= i - 1
        return best

    def put(self, place: int, entry: tuple[float, int]) -> None:
        i = place + 1
        while i < len(self.tree):
            self.tree[i] = max(self.tree[i], entry)
            i += i & -i


def heaviest_ascent(places: Sequence[int], weights: Sequence[float]) -> list[int]:
    """Positions of the heaviest subsequence of places that never falls; -1 (unknown) never takes part, weights are positive.

    Of equal weights the earliest predecessor and the earliest end count. n log n.
    """
    links: dict[int, int] = {}
    maxima = PrefixMaxima(max(places, default=-1) + 1)
    for i, (place, weight) in enumerate(zip(places, weights, strict=True)):
        if place >= 0:
            # an entry is a weight and the position that ends with it, negative so that the earliest is greatest
            so_far, end = maxima.upto(place)
            links[i] = -end
            maxima.put(place, (so_far + weight, -i))
    if not links:
        return []
    at, chain = -maxima.upto(max(places))[1], []
    while at >= 0:
        chain.append(at)
        at = links[at]
    return chain[::-1]


def repaired(places: Sequence[int], weights: Sequence[float]) -> list[int]:
    """Plan places with those off the heaviest ascent taken from the one before on it; leading ones from its first."""
    on = heaviest_ascent(places, weights)
    if not on:
        return list(places)
    known = np.full(len(places), -1)
    known[on] = on
    known = np.maximum.accumulate(known)
    return np.asarray(places)[np.where(known < 0, on[0], known)].tolist()


def ordered_labels(segments: DataFrame, plan: Sequence[str]) -> DataFrame:
    """ep, segment, label and ordered (label after the repair). ``segments``: ep, segment, label, weight (frames)."""
    place = {x: i for i, x in reversed(list(enumerate(plan)))}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("segment")
        fixed = repaired([place.get(x, -1) for x in pdf["label"]], [max(1, w) for w in pdf["weight"]])
        return pd.DataFrame({"ep": pdf["ep"], "segment": pdf["segment"], "label": pdf["label"], "ordered": [plan[i] if i >= 0 else x for i, x in zip(fixed, pdf["label"], strict=True)]})

    return segments.groupBy("ep").applyInPandas(run, "ep long, segment long, label string, ordered string")


class Frames:
    """States of one episode in order of time: the distance of two is that of their states plus that of their times.

    No matrix is kept: a row of distances is made when it is asked for.
    """

    def __init__(self, states: np.ndarray, times: np.ndarray):
        self.states, self.times = states, times

    def __len__(self) -> int:
        return len(self.times)

    def row(self, i: int, a: int = 0, b: int | None = None) -> np.ndarray:
        """Distances of frame i from frames a to b."""
        apart = self.states[a:b] - self.states[i]
        return np.sqrt(np.einsum("ij,ij->i", apart, apart)) + np.abs(self.times[a:b] - self.times[i])

    def core(self, k: int) -> np.ndarray:
        """The distance of each frame's k-th nearest (itself the first): sought in a window of time that doubles until what is outside is farther."""
        n = len(self)
        out = np.empty(n)
        for i in range(n):
            width = 2 * k
            while True:
                a, b = max(0, i - width), min(n, i + width + 1)
                found = np.partition(self.row(i, a, b), min(k, b - a) - 1)[min(k, b - a) - 1]
                outside = min(self.times[i] - self.times[a - 1] if a else np.inf, self.times[b] - self.times[i] if b < n else np.inf)
                if (a == 0 and b == n) or (b - a >= k and found <= outside):
                    break
                width *= 2
            out[i] = found
        return out


def _spanning_tree(frames: Frames, core: np.ndarray) -> list[tuple[float, int, int]]:
    """The edges of the least spanning tree of mutual reachability, by Prim, a row of distances at a time."""
    n = len(frames)
    near, link, out = np.full(n, np.inf), np.zeros(n, int), np.zeros(n, bool)
    edges, at = [], 0
    for _ in range(n - 1):
        out[at] = True
        reach = np.maximum(np.maximum(core, core[at]), frames.row(at))
        closer = (reach < near) & ~out
        near[closer], link[closer] = reach[closer], at
        at = int(np.argmin(np.where(out, np.inf, near)))
        edges.append((near[at], link[at], at))
    return sorted(edges)


def hdbscan(frames: Frames, least: int) -> np.ndarray:
    """Cluster numbers of frames, -1 for noise.

    Mutual reachability, its minimum spanning tree, the tree condensed to clusters of at least
    ``least`` points, and of these the ones with the greatest excess of mass. Memory grows with
    the frames, time with their square.
    """
    n = len(frames)
    if n < 2 * least or n < 3:
        return np.full(n, -1)
    edges = _spanning_tree(frames, frames.core(min(least, n)))
    # single-linkage dendrogram
    parent, size, children = list(range(2 * n - 1)), [1] * n + [0] * (n - 1), {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, (w, a, b) in enumerate(edges):
        a, b, new = root(int(a)), root(int(b)), n + i
        parent[a] = parent[b] = new
        size[new] = size[a] + size[b]
        children[new] = (a, b, 1 / w if w > 0 else np.inf)

    def points(x: int) -> list[int]:
        stack, found = [x], []
        while stack:
            y = stack.pop()
            if y < n:
                found.append(y)
            else:
                stack += children[y][:2]
        return found

    # condensed tree: cluster -> birth, stability, child clusters, members with their death
    clusters = [{"birth": 0.0, "mass": 0.0, "kids": [], "top": 2 * n - 2}]
    todo = [(2 * n - 2, 0)]
    while todo:
        node, c = todo.pop()
        if node < n:
            continue
        a, b, lam = children[node]
        lam = min(lam, 1e12)
        big = [x for x in (a, b) if size[x] >= least]
        clusters[c]["mass"] += sum(size[x] for x in (a, b) if size[x] < least) * (lam - clusters[c]["birth"])
        if len(big) == 2:
            clusters[c]["mass"] += (size[a] + size[b]) * (lam - clusters[c]["birth"])
            for x in big:
                clusters.append({"birth": lam, "mass": 0.0, "kids": [], "top": x})
                clusters[c]["kids"].append(len(clusters) - 1)
                todo.append((x, len(clusters) - 1))
        elif big:
            todo.append((big[0], c))
    chosen, value = set(), [0.0] * len(clusters)
    for c in range(len(clusters) - 1, -1, -1):
        below = sum(value[k] for k in clusters[c]["kids"])
        if c and (not clusters[c]["kids"] or clusters[c]["mass"] >= below):
            value[c] = clusters[c]["mass"]
            stack = list(clusters[c]["kids"])
            while stack:
                k = stack.pop()
                chosen.discard(k)
                stack += clusters[k]["kids"]
            chosen.add(c)
        else:
            value[c] = below
    labels = np.full(n, -1)
    for number, c in enumerate(sorted(chosen)):
        labels[points(clusters[c]["top"])] = number
    return labels


def hdbscan_segments(frames: DataFrame, fps: float, time_weight: float, least: int = 5, expected: int | None = None) -> DataFrame:
    """ep, frame and segment: clusters of states and times (distances added), in order of first frames, noise filled from its neighbours.

    With ``expected`` the least cluster size is searched for that many segments, the nearest found otherwise.
    ``frames``: ep, frame, v (array). An episode is one task's, in memory that grows with its frames.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame")
        x = np.stack(pdf["v"].to_numpy()).astype(float)
        t = pdf["frame"].to_numpy() / fps
        own = Frames(x, time_weight * t)
        sizes = [least] if expected is None else range(2, max(3, len(pdf) // 2))
        found = min((hdbscan(own, s) for s in sizes), key=lambda z: abs(len(set(z[z >= 0].tolist())) - (expected or 0)) if expected else 0)
        filled = pd.Series(found).where(lambda s: s >= 0).ffill().bfill().fillna(0).astype(int)
        order = {c: i for i, c in enumerate(dict.fromkeys(filled))}
        return pd.DataFrame({"ep": pdf["ep"].to_numpy(), "frame": pdf["frame"].to_numpy(), "segment": filled.map(order).to_numpy()})

    return frames.groupBy("ep").applyInPandas(run, "ep long, frame long, segment long")
