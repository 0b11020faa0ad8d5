"""Great-circle distances and a vantage-point tree for radius joins inside one cell."""

from __future__ import annotations

import numpy as np

RADIUS_KM = 6371.0
LEAF = 48


def unit_vectors(lon: np.ndarray, lat: np.ndarray) -> np.ndarray:
    x, y = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(y) * np.cos(x), np.cos(y) * np.sin(x), np.sin(y)], axis=1)


def distance_km(lon1, lat1, lon2, lat2):  # noqa: ANN001, ANN201
    """Haversine distance on a sphere of 6,371 km."""
    a, b = np.radians(lat1), np.radians(lat2)
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(lon2 - lon1) / 2) ** 2
    return 2 * RADIUS_KM * np.arcsin(np.minimum(1.0, np.sqrt(h)))


class VantageTree:
    """A vantage-point tree over (lon, lat); `pairs` joins a set of probes with all points within a radius."""

    def __init__(self, lon: np.ndarray, lat: np.ndarray) -> None:
        self.lon, self.lat = lon, lat
        self.root = self._build(np.arange(len(lon)))

    def _build(self, at: np.ndarray):  # noqa: ANN202
        nodes: dict = {}
        todo = [(at, nodes, "root")]
        while todo:
            rows, parent, side = todo.pop()
            if len(rows) <= LEAF:
                parent[side] = rows
                continue
            v = rows[0]
            d = distance_km(self.lon[v], self.lat[v], self.lon[rows], self.lat[rows])
            mid = float(np.median(d))
            near = d <= mid
            if near.all():  # more than half of the points lie equally far away
                near = d < mid
            if not near.any() or near.all():
                parent[side] = rows
                continue
            parent[side] = node = {"v": v, "mid": float(d[near].max())}
            todo += [(rows[near], node, "near"), (rows[~near], node, "far")]
        return nodes["root"]

    def pairs(self, probes: np.ndarray, radius: float, block: int = 1 << 20):  # noqa: ANN201
        """Yields arrays (probe, point) of points within `radius` km of the probes, themselves included."""
        todo = [(self.root, probes)]
        while todo:
            node, q = todo.pop()
            if not len(q):
                continue
            if isinstance(node, dict):
                d = distance_km(self.lon[node["v"]], self.lat[node["v"]], self.lon[q], self.lat[q])
                slack = radius * (1 + 1e-9) + 1e-6
                todo += [(node["near"], q[d <= node["mid"] + slack]), (node["far"], q[d >= node["mid"] - slack])]
                continue
            step = max(1, block // max(1, len(node)))
            for i in range(0, len(q), step):
                p = q[i : i + step]
                a, b = np.nonzero(distance_km(self.lon[p][:, None], self.lat[p][:, None], self.lon[node], self.lat[node]) <= radius)
                if len(a):
                    yield p[a], node[b]
