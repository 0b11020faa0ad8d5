"""Maximum-weight bipartite matching and the likeness of column names."""

from __future__ import annotations

import re
from difflib import SequenceMatcher

# Names under which the fields are known, and endings that only tell a unit.
ALIASES = {
    "longitude": ("longitude", "long", "lon", "lng", "x"),
    "latitude": ("latitude", "lat", "y"),
    "elevation": ("elevation", "elev", "altitude", "alt", "height", "hgt", "z"),
}
UNIT_ENDINGS = {"deg", "degrees", "dd", "decimal", "m", "metres", "meters", "ft", "feet", "msl", "asl"}
RANGES = {"longitude": (-180.0, 360.0), "latitude": (-90.0, 90.0), "elevation": (-500.0, 9000.0)}


def _stem(path: str) -> str:
    """The last key of a path without case, signs and unit endings."""
    words = [w for w in re.split(r"[^a-z]+", path.rpartition(".")[2].casefold()) if w]
    return "".join(w for i, w in enumerate(words) if i == 0 or w not in UNIT_ENDINGS)


def resemblance(a: str, b: str) -> float:
    """How alike two paths are: 1 for names of one stem or one field, a fuzzy ratio of 0.8 or more, else 0."""
    x, y = _stem(a), _stem(b)
    if x == y or any(x in names and y in names for names in ALIASES.values()):
        return 1.0
    ratio = SequenceMatcher(None, x, y).ratio() if min(len(x), len(y)) > 4 else 0.0
    return ratio if ratio >= 0.8 else 0.0


def likeness(field: str, path: str) -> float:
    """1 for a known name of the field, a fuzzy ratio of 0.8 or more for one near to it, else 0. Case and unit endings don't count."""
    stem = _stem(path)
    if stem in ALIASES[field]:
        return 1.0
    best = max((SequenceMatcher(None, stem, a).ratio() for a in ALIASES[field] if len(a) > 4), default=0.0)
    return best if best >= 0.8 else 0.0


def assign(weights: list[list[float]]) -> list[int]:
    """For each row the column of a matching of greatest total weight (Hungarian method); columns are at least as many as rows."""
    n, m = len(weights), len(weights[0]) if weights else 0
    inf = float("inf")
    u, v, owner, way = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        owner[0], j0 = i, 0
        low, used = [inf] * (m + 1), [False] * (m + 1)
        while True:
            used[j0] = True
            i0, delta, j1 = owner[j0], inf, 0
            for j in range(1, m + 1):
                if not used[j]:
                    cost = -weights[i0 - 1][j - 1] - u[i0] - v[j]
                    if cost < low[j]:
                        low[j], way[j] = cost, j0
                    if low[j] < delta:
                        delta, j1 = low[j], j
            for j in range(m + 1):
                if used[j]:
                    u[owner[j]] += delta
                    v[j] -= delta
                else:
                    low[j] -= delta
            j0 = j1
            if not owner[j0]:
                break
        while j0:
            owner[j0] = owner[way[j0]]
            j0 = way[j0]
    out = [-1] * n
    for j in range(1, m + 1):
        if owner[j]:
            out[owner[j] - 1] = j - 1
    return out
