"""Helpers of the nearest-neighbour search inside tasks: a tree of chunks and the search in one chunk.

Both work on NumPy columns of a batch or a group that Spark has dealt out; neither sees a whole table.
"""

from __future__ import annotations

import numpy as np

#: Left rows that meet their candidates as one block.
BLOCK = 32
#: Distances held at once.
HELD = 2_000_000
#: Bounds are widened by so much, so that rounding loses no row.
SLACK, TINY = 1.0 + 1e-9, 1e-12
#: Pairs a row, on average, up to which a raster is used.
CROWD = 400
NONE = -1


def norm(parts: list[np.ndarray]) -> np.ndarray:
    """Root of the sum of squares, added in the order the columns have."""
    total = parts[0] * parts[0]
    for p in parts[1:]:
        total = total + p * p
    return np.sqrt(total)


class Tree:
    """Cells of the large groups. A cell with too many rows is split; neighbouring small cells of one parent are a chunk.

    ``slot[node, cell]`` is the child a cell belongs to: a node (0 and up), a chunk c as -2 - c, or ``NONE``.
    """

    def __init__(self, d: int, most: int, need: int) -> None:
        self.d, self.most, self.need = d, most, need
        self.bits = max(1, 6 // d)
        self.fan = 1 << (self.bits * d)
        side = np.arange(1 << self.bits)
        self.spread = sum(((side >> b) & 1) << (b * d) for b in range(self.bits))
        self.origin, self.width, self.depth = np.zeros((0, d)), np.zeros(0), np.zeros(0, np.int64)
        self.slot = np.full((0, self.fan), NONE, np.int64)
        self.kids: list[list[tuple]] = []
        self.chunks = 0

    def add(self, origin: np.ndarray, width: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """New nodes, not split yet."""
        first, n = len(self.width), len(width)
        self.origin, self.width, self.depth = np.concatenate([self.origin, origin]), np.concatenate([self.width, width]), np.concatenate([self.depth, depth])
        self.slot = np.concatenate([self.slot, np.full((n, self.fan), NONE, np.int64)])
        self.kids += [[] for _ in range(n)]
        return np.arange(first, first + n)

    def cell(self, node: np.ndarray, at: np.ndarray) -> np.ndarray:
        side = 1 << self.bits
        place = np.floor((at - self.origin[node]) * (side / self.width[node])[:, None])
        return (self.spread[np.clip(place, 0, side - 1).astype(np.int64)] << np.arange(self.d)).sum(axis=1)

    def located(self, root: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where right rows are: (chunk or ``NONE``, cell of the node that is still to be split)."""
        node, chunk, cell = root.copy(), np.full(len(root), NONE, np.int64), np.full(len(root), NONE, np.int64)
        live = np.arange(len(root))
        while len(live):
            here = self.cell(node[live], at[live])
            to = self.slot[node[live], here]
            cell[live] = node[live] * self.fan + here
            chunk[live[to < NONE]] = -2 - to[to < NONE]
            live, to = live[to >= 0], to[to >= 0]
            node[live] = to
        return chunk, cell

    def split(self, cells: np.ndarray, rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, deepest: int) -> bool:
        """Children of the nodes whose cells are counted; whether some of them are to be split as well."""
        more = False
        order = np.argsort(cells)
        run: list[int] = []

        def close() -> None:
            if run:
                node = int(cells[run[0]] // self.fan)
                self.slot[node, cells[run] % self.fan] = -2 - self.chunks
                self.kids[node].append((*lo[run].min(axis=0), *hi[run].max(axis=0), rows[run].sum(), -2 - self.chunks))
                self.chunks += 1
                run.clear()

        for i in order:
            node = int(cells[i] // self.fan)
            if run and (cells[run[0]] // self.fan != node or rows[run].sum() + rows[i] > self.most):
                close()
            if rows[i] > self.most and self.depth[node] < deepest and (hi[i] > lo[i]).any():
                close()
                child = int(self.add(lo[i][None], np.array([(hi[i] - lo[i]).max()]), self.depth[node : node + 1] + 1)[0])
                self.slot[node, cells[i] % self.fan] = child
                self.kids[node].append((*lo[i], *hi[i], rows[i], child))
                more = True
            else:
                run.append(int(i))
        close()
        return more

    def close(self) -> Tree:
        """The children as columns."""
        flat = np.array([k for kids in self.kids for k in kids], dtype=np.float64).reshape(-1, 2 * self.d + 2)
        self.lo, self.hi, self.rows, self.to = flat[:, : self.d], flat[:, self.d : 2 * self.d], flat[:, -2], flat[:, -1].astype(np.int64)
        self.size = np.array([len(kids) for kids in self.kids], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.kids = []
        return self

    def children(self, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``node``, child) of all children."""
        size = self.size[node]
        place = np.repeat(np.arange(len(node)), size)
        return place, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.first[node], size)

    def home(self, root: np.ndarray, at: np.ndarray) -> np.ndarray:
        """A chunk with enough right rows near every left row: the child that is nearest by its farthest corner, on every step."""
        chunk, live, node = np.full(len(root), NONE, np.int64), np.arange(len(root)), root
        while len(live):
            place, child = self.children(node)
            x = at[live][place]
            far = norm([np.maximum(self.hi[child, i] - x[:, i], x[:, i] - self.lo[child, i]) for i in range(self.d)])
            far[self.rows[child] < self.need] = np.inf
            best = np.minimum.reduceat(far, np.cumsum(self.size[node]) - self.size[node])
            hit = np.flatnonzero(far == best[place])
            to = self.to[child[hit[np.unique(place[hit], return_index=True)[1]]]]
            chunk[live[to < 0]] = -2 - to[to < 0]
            live, node = live[to >= 0], to[to >= 0]
        return chunk

    def others(self, root: np.ndarray, at: np.ndarray, reach: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, chunk) of all chunks but the own one that have a corner or side within reach, by row."""
        live, node, out = np.arange(len(root)), root, []
        bound = reach * SLACK + TINY
        while len(live):
            place, child = self.children(node)
            row = live[place]
            x = at[row]
            least = norm([np.maximum(np.maximum(self.lo[child, i] - x[:, i], x[:, i] - self.hi[child, i]), 0.0) for i in range(self.d)])
            near = least <= bound[row]
            row, to = row[near], self.to[child[near]]
            leaf = (to < 0) & (-2 - to != home[row])
            out.append((row[leaf], -2 - to[leaf]))
            live, node = row[to >= 0], to[to >= 0]
        rows, chunks = (np.concatenate([o[j] for o in out]) if out else np.zeros(0, np.int64) for j in (0, 1))
        order = np.argsort(rows, kind="stable")
        return rows[order], chunks[order]


def search(left: np.ndarray, right: np.ndarray, k: int, limit: np.ndarray, own: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(left row, right row, distance) of the k nearest right rows within the limit and of all as near as the k-th, by left row; and the bound each left row ends with.

    Blocks of left rows are halved; a block keeps the right rows that its box cannot rule out. Rows with equal ``own`` keys do not meet.
    """
    wanted = k if own is None else k + int(np.unique(own[1], return_counts=True)[1].max())
    bound = limit.copy()
    found = []
    stack = [(np.arange(len(left)), np.arange(len(right)))]
    while stack:
        a, b = stack.pop()
        lo, hi = left[a].min(axis=0), left[a].max(axis=0)
        if len(b) > wanted:
            r = right[b]
            far = norm([np.maximum(r[:, i] - lo[i], hi[i] - r[:, i]) for i in range(r.shape[1])])
            reach = min(np.partition(far, wanted - 1)[wanted - 1], limit[a].max()) * SLACK + TINY
            b = b[norm([np.maximum(np.maximum(lo[i] - r[:, i], r[:, i] - hi[i]), 0.0) for i in range(r.shape[1])]) <= reach]
        wide = int(np.argmax(hi - lo))
        if len(a) > BLOCK and hi[wide] > lo[wide]:
            order = a[np.argpartition(left[a, wide], len(a) // 2)]
            stack += [(order[: len(a) // 2], b), (order[len(a) // 2 :], b)]
            continue
        if not len(b):
            continue
        step = max(1, HELD // len(b))
        for part in (a[at : at + step] for at in range(0, len(a), step)):
            dist = norm([left[part, i][:, None] - right[b, i][None, :] for i in range(left.shape[1])])
            if own is not None:
                dist[own[0][part][:, None] == own[1][b][None, :]] = np.inf
            if len(b) >= k:
                bound[part] = np.minimum(limit[part], np.partition(dist, k - 1, axis=1)[:, k - 1])
            i, j = np.nonzero((dist <= bound[part][:, None]) & (dist < np.inf))
            found.append((part[i], b[j], dist[i, j]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), bound
    a, b, dist = (np.concatenate([f[j] for f in found]) for j in range(3))
    order = np.argsort(a, kind="stable")
    return a[order], b[order], dist[order], bound


def within(at: np.ndarray, mine: np.ndarray, limit: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(row of ``mine``, other row, distance) of all rows nearer than the row's limit, which is at most ``reach``, by a raster of that width.

    None when the raster would make more than ``CROWD`` pairs a row, or has too many cells to be numbered.
    """
    width = reach * (1.0 + 1e-9)
    place = np.floor((at - at.min(axis=0)) / width) + 1.0
    cells = place.max(axis=0) + 2.0
    if np.prod(cells) >= 2.0**62:
        return None
    place, (_, ny, nz) = place.astype(np.int64), cells.astype(np.int64)
    key = (place[:, 0] * ny + place[:, 1]) * nz + place[:, 2]
    order = np.argsort(key, kind="stable")
    ordered, own = key[order], key[mine]
    sides = [(dx * ny + dy) * nz for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    starts = [np.searchsorted(ordered, own + side - 1, "left") for side in sides]
    sizes = [np.searchsorted(ordered, own + side + 1, "right") - start for side, start in zip(sides, starts)]
    if sum(int(size.sum()) for size in sizes) > CROWD * len(at):
        return None
    found = []
    for start, size in zip(starts, sizes):
        ends = np.cumsum(size)
        first = 0
        while first < len(mine):
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + HELD, "right")))
            n = size[first:last]
            i = np.repeat(mine[first:last], n)
            j = order[np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[first:last], n)]
            dist = norm([at[i, c] - at[j, c] for c in range(at.shape[1])])
            near = (dist < limit[i]) & (i != j)
            found.append((i[near], j[near], dist[near]))
            first = last
    return tuple(np.concatenate([f[c] for f in found]) for c in range(3))
