"""Operator 5: exact top-k inner products by dual-tree search over cover trees.

A set of data points (by smallest id hash; more of them the more vectors there
are, from ``PIVOTS`` to ``MOST_PIVOTS``) forms the top level: every vector
belongs to its nearest pivot, whose covering radius is the largest distance to
a member. Runs of neighbouring pivots make up a part, a crowded pivot several;
the number of parts follows the cores and a worker's memory, so queries are
copied some dozens of times at most, and vectors once for each ``QUERY_BLOCK``
queries. A query's k-th best score against the pivots, which are candidates
themselves, is a first lower bound, and the query goes only to the parts that
have a pivot whose bound ``q.p + |q| r`` reaches it: first to its nearest ones
(one in ``NEAR``), then, with the k-th best score found there, to the others.

Inside a part both sides are cover trees: a node's children lie further apart
than half its radius and cover its points within that (or, if that takes more
than ``fan_of`` its size, within their own covering radius). The two trees are
descended together, level by level, the one with the larger nodes first, and a
pair of nodes is dropped when

    a.b + ra |b| + rb |a| + ra rb  <  the worst k-th score of the query node,

a and b being the centres and ra and rb the covering radii (the bound of
Curtin and Ram's dual-tree max-kernel search); a query leaf's members are
leaves of radius 0 at last. Pairs of leaves meet in matrix products of
integers, so scores are exact, and raise the k-th scores that later pairs are
held against. A run of queries that, judged by every 32nd of them, has to meet
most leaves of a tree meets all of it, by a second bound (``Lanes``): the
product in the principal directions plus the product of the lengths of what is
left, rounded up, three pairs to a floating-point number; only pairs whose bound
reaches the query's k-th score are scored. Each part returns at most k rows a
query, and a window merges them. No matrix of all gaps is made.

How much is dropped depends on the vectors: points in clusters let most pairs
go, directions without clusters in many dimensions hardly any (see README):
then every pair is bounded, and seconds grow as queries times vectors.

Defined results: vectors that are null, empty, or hold a null or non-finite
component take no part, nor do rows with a null id; only vectors of one length
are compared (the ``LENGTHS`` most frequent lengths have pivots, others are
dealt by id alone); a row is known by its id, so repeated rows count once (of
different vectors under one id the best score counts); ties go to the smaller
id; an empty table gives an empty result. Scores are exact while inner
products stay below 2**53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window, functions as F

from roadlens.session import materialize

K, QUERY_STEP, SCALE = 5, 50, 256
PIVOTS, MOST_PIVOTS, PER_PIVOT = 32, 4096, 8192
LENGTHS = 8
BLOCK, QUERY_BLOCK = 2048, 1 << 19
PART_NUMBERS, QUERY_NUMBERS = 1 << 23, 1 << 24  # of a part and of its queries at once: what two workers of an executor hold
PARTS_A_CORE, MOST_PARTS = 5, 48
NEAR = 16  # a query meets its nearest parts first, one in so many
TREE, BATCH = 8192, 32768  # points of a data tree and of a query tree
LEAF, FAN = 32, 64
WIDE_LEAF = 64  # of the search's trees
SOME_POINTS, NEARER = 32, 0.75  # points that are looked at for neighbours within this share of a node's radius
DENSE, EVERY = 0.5, 32  # a run of queries meets all of a tree if every 32nd of them has to meet this share of it
TILE_ROWS, TILE_POINTS = 256, 2048
LANES, LANE, LANE_TOP, MANTISSA = 3, 2.0**16, 181, 1.5 * 2.0**52  # 181 * 181 < 2**15
TILE_COLUMNS = 512  # of LANES points each
VERIFIED_NUMBERS, MOST_TURNED = 1 << 21, 2048  # components looked at together; longer vectors are not turned
# nanoseconds of a pair: for each direction, to verify it, to look through a row with hits
DIRECTION_NS, VERIFY_NS, ROW_NS = 0.016, 100.0, 0.4
SHORT, EXACT_SINGLE = 32767, 1 << 22  # two-byte components; squared length up to which single precision is exact
FOUND_AT_ONCE = 1_000_000  # scores kept before only each query's best are
SLACK = 1e-6  # of rounding in the bounds, which are real numbers


def fan_of(size: int) -> int:
    """Children at most of a node of ``size`` points, so that points which all lie apart end in leaves of some size."""
    return min(FAN, max(2, size // LEAF)) if size > LEAF else size


class CoverTree:
    """Nodes as arrays: ``centre`` (a point), ``radius``, ``kids``, and the points ``order[low:high]`` below.

    With ``leaf``, nodes of at most so many points are not split, nor those whose points all lie about as far
    apart as the node is wide: their children would be no smaller.
    """

    def __init__(self, points: np.ndarray, leaf: int = 1):
        self.points, self.squares, self.leaf = points, np.einsum("ij,ij->i", points, points), leaf
        self.order = np.zeros(len(points), np.int64)
        self.centre, self.radius, self.kids, self.low, self.high = [], [], [], [], []
        todo = [(self._node(0, 0, len(points)), np.arange(len(points)))]
        while todo:
            node, members = todo.pop()
            todo += self._split(node, members)
        self.centre, self.radius = np.array(self.centre), np.array(self.radius)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _node(self, point: int, low: int, high: int) -> int:
        for values, value in ((self.centre, point), (self.radius, 0.0), (self.kids, []), (self.low, low), (self.high, high)):
            values.append(value)
        return len(self.centre) - 1

    def _split(self, node: int, members: np.ndarray):
        """Give ``node`` its children: a net of half its radius, found farthest point first."""
        low = self.low[node]
        self.order[low:low + len(members)] = members
        points, squares = self.points[members], self.squares[members]

        def gaps(point: int) -> np.ndarray:
            # squared; whole numbers, so that copies are at distance 0
            return np.maximum(np.rint(squares + self.squares[point] - 2 * (points @ self.points[point])), 0)

        near = gaps(self.centre[node])
        self.radius[node] = float(near.max()) ** 0.5
        if self.radius[node] <= SLACK or len(members) <= self.leaf or self.leaf > 1 and not self._clusters(node, points, squares):
            return []
        owner, nets, fan = np.zeros(len(members), np.int64), [self.centre[node]], fan_of(len(members))
        while near.max() > self.radius[node] ** 2 / 4 and len(nets) < fan:
            point = int(members[near.argmax()])
            gap = gaps(point)
            closer = gap < near
            owner[closer], near[closer] = len(nets), gap[closer]
            nets.append(point)
        if len(members) <= LEAF and 2 * len(nets) > len(members):  # few points that lie apart are met together
            return []
        out, by_owner = [], np.argsort(owner, kind="stable")
        for point, own in zip(nets, np.split(members[by_owner], np.searchsorted(owner[by_owner], np.arange(1, len(nets))))):
            child = self._node(point, low, low + len(own))
            self.kids[node].append(child)
            out.append((child, own))
            low += len(own)
        return out

    def _clusters(self, node: int, points: np.ndarray, squares: np.ndarray) -> bool:
        """Whether some of the points have neighbours much nearer than the node's radius."""
        some = np.linspace(0, len(points) - 1, SOME_POINTS).astype(int)
        gaps = squares[some, None] + squares[None, :] - 2 * (points[some] @ points.T)
        place = min(self.leaf // 2, len(points) // 8)
        near = np.partition(gaps, place, axis=1)[:, place]
        return 8 * np.count_nonzero(near < (NEARER * self.radius[node]) ** 2) >= len(some)

    def members(self, node: int) -> np.ndarray:
        """The points below a node."""
        return self.order[self.low[node]:self.high[node]]

    def settle(self, first: int) -> CoverTree:
        """For the search: the points in the order of the tree, ``first`` being the first one's number; centres aside."""
        self.first, self.centres = first, self.points[self.centre].astype(float)
        self.centre_norms = np.sqrt((self.centres * self.centres).sum(axis=1))
        self.open = np.array([bool(k) for k in self.kids])
        self.points = self.points[self.order]
        self.squares, self.lanes, self.middle = None, None, self.points.mean(axis=0, dtype=float)
        return self

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nodes with those that have children replaced by them, the place of each one's origin)."""
        parts = [self.kids[n] or [int(n)] for n in nodes]
        return np.array([k for p in parts for k in p]), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def _best(r: np.ndarray, c: np.ndarray, v: np.ndarray, ids: np.ndarray, queries: int, k: int):
    """Of (query, point, score) each query's ``k`` best, ties to the smaller id."""
    order = np.lexsort((ids[c], -v, r))
    r, c, v = r[order], c[order], v[order]
    keep = np.arange(len(r)) - np.searchsorted(r, np.arange(queries))[r] < k
    return r[keep], c[keep], v[keep]


class Lanes:
    """Upper bounds of inner products, three points to a matrix element.

    What a point has beyond the mean of its tree and the queries are turned to the points' principal directions.
    The first ``kept`` components are rounded to small whole numbers, the lengths of the others are one more
    component (Cauchy and Schwarz's bound of what those add to a product). A column holds three points, 2**16 apart
    in one double: a product of whole numbers with it is three products, each in 16 bits of the mantissa, which are
    read as such. What rounding may have taken and the mean's product go into the score that a query has to reach.
    """

    def __init__(self, bases: list[CoverTree], queries: np.ndarray, floors: np.ndarray):
        bases = [bases[i] for i in np.unique(np.linspace(0, len(bases) - 1, min(len(bases), 16)).astype(int))]
        some = [b.points[np.linspace(0, len(b.points) - 1, min(len(b.points), 512)).astype(int)] - b.middle for b in bases]
        x = np.concatenate(some).astype(float)
        d = self.kept = x.shape[1]
        self.turn = np.linalg.eigh(x.T @ x / max(1.0, float((x * x).sum())))[1][:, ::-1] if d <= MOST_TURNED else None
        at = np.flatnonzero(floors > -np.inf)
        at = at[np.linspace(0, len(at) - 1, min(len(at), 128)).astype(int)]
        if not len(at):
            return
        q = queries[at].astype(float)
        floor = np.concatenate([np.tile(floors[at, None] - (q @ b.middle)[:, None], len(y)) for b, y in zip(bases, some)], axis=1)
        q, x = self.turned(q), self.turned(x)
        lengths = np.sqrt((q * q).sum(axis=1))[:, None] * np.sqrt((x * x).sum(axis=1))
        best = np.inf
        for kept in sorted({-(-d * i // 16) for i in range(1, 17)}):
            rest = np.sqrt((q[:, kept:] ** 2).sum(axis=1))[:, None] * np.sqrt((x[:, kept:] ** 2).sum(axis=1))
            bound = q[:, :kept] @ x[:, :kept].T + rest + 0.6 * kept ** 0.5 / self.scale(kept) * lengths
            hits = np.count_nonzero(bound >= floor) / bound.size
            cost = DIRECTION_NS * (kept + 2) + VERIFY_NS * hits + ROW_NS * -np.expm1(-hits * LANES * TILE_COLUMNS)
            if cost < best:
                best, self.kept = cost, kept

    def turned(self, rows: np.ndarray) -> np.ndarray:
        return rows if self.turn is None else rows @ self.turn

    @staticmethod
    def scale(kept: int) -> float:
        """Length of a vector in whole numbers, such that a product of two stays in its lane when rounded."""
        return max(1.0, LANE_TOP - kept ** 0.5 / 2 - 1)

    def rounded(self, rows: np.ndarray, longest: np.ndarray | float):
        """(whole numbers of the kept components and of the others' length, what a unit is, error, length kept)."""
        turned = self.turned(rows.astype(float))
        kept, unit = turned[:, :self.kept], longest / self.scale(self.kept)
        unit = np.where(unit > 0, unit, 1.0) if np.ndim(unit) else unit or 1.0
        whole = np.rint(kept / unit)
        error = np.sqrt(((kept - whole * unit) ** 2).sum(axis=1))
        others = np.ceil(np.sqrt((turned[:, self.kept:] ** 2).sum(axis=1))[:, None] / unit)
        return np.concatenate([whole, others], axis=1), unit, error, np.sqrt((kept * kept).sum(axis=1))

    def queries(self, rows: np.ndarray):
        """(matrix, unit of each, error of each, length of each as rounded)."""
        whole, unit, error, length = self.rounded(rows, np.sqrt((rows.astype(float) ** 2).sum(axis=1))[:, None])
        matrix = np.concatenate([-whole, np.full((len(rows), 1), -1.0)], axis=1)  # negative, so that the topmost 16 bits are
        return matrix, unit[:, 0], error, length + error

    def points(self, base: CoverTree):
        """(matrix, unit, largest error, largest length) of a tree's points."""
        if base.lanes is None:
            rows = base.points - base.middle
            whole, unit, error, length = self.rounded(rows, _longest(rows) ** 0.5)
            columns = -(-len(rows) // LANES)
            matrix = np.zeros((whole.shape[1] + 1, columns))
            for lane in range(LANES):
                own = whole[lane * columns:(lane + 1) * columns].T
                matrix[:-1, :own.shape[1]] += own * LANE ** lane
            matrix[-1] = MANTISSA
            base.lanes = matrix, unit, float(error.max()), float(length.max())
        return base.lanes


class _Search:
    """The queries of one tree against the points of any number of trees."""

    def __init__(self, asked: CoverTree, ids: np.ndarray, floors: np.ndarray, point_ids: np.ndarray, k: int, spare: int,
                 lanes: Lanes):
        self.asked, self.ids, self.point_ids, self.k, self.lanes = asked, ids, point_ids, k, lanes
        self.spare = spare  # points at most with a query's own id
        self.floor = np.ceil(floors.astype(float))  # worst score that still counts
        self.found, self.pending, self.scored = [], 0, 0
        self.buffer = np.empty(TILE_ROWS * TILE_POINTS, asked.points.dtype)
        self.packed = np.empty(TILE_ROWS * TILE_COLUMNS)
        self.sides = None

    def meet(self, rows: np.ndarray, base: CoverTree, low: int, high: int) -> None:
        """Score ``rows`` with the points ``low:high`` of a tree, in matrix products."""
        pieces = -(-(high - low) // TILE_POINTS)
        edges = np.linspace(low, high, pieces + 1).astype(int)
        for start in range(0, len(rows), TILE_ROWS):
            at = rows[start:start + TILE_ROWS]
            q = self.asked.points[at]
            floor = self.floor[at].astype(self.buffer.dtype)
            for first, last in zip(edges[:-1], edges[1:]):
                self.scored += len(at) * (last - first)
                scores = self.buffer[:len(at) * (last - first)].reshape(len(at), last - first)
                np.matmul(q, base.points[first:last].T, out=scores)
                new = np.flatnonzero(floor == -np.inf)
                if len(new) and last - first >= self.k + self.spare:
                    floor[new] = np.partition(scores[new], last - first - self.k - self.spare,
                                              axis=1)[:, last - first - self.k - self.spare]
                    self.floor[at[new]] = floor[new]
                some = np.flatnonzero(scores.max(axis=1) >= floor)
                if len(some):
                    r, c = np.divmod(np.flatnonzero(scores[some] >= floor[some, None]), last - first)
                    self._keep(at[some[r]], base.first + base.order[first + c], scores[some[r], c])

    def sift(self, rows: np.ndarray, base: CoverTree) -> None:
        """As ``meet`` for a whole tree, but only what reaches the floor by its lane's bound is scored."""
        if self.sides is None:
            self.sides = self.lanes.queries(self.asked.points)
        matrix, units, errors, lengths = self.sides
        columns, unit, error, length = self.lanes.points(base)
        n, width = len(base.order), columns.shape[1]
        for start in range(0, len(rows), TILE_ROWS):
            at = rows[start:start + TILE_ROWS]
            q = matrix[at[0]:at[-1] + 1] if at[-1] - at[0] + 1 == len(at) else matrix[at]
            # a lane is one less if those below are negative
            beyond = self.floor[at] - self.asked.points[at].astype(float) @ base.middle
            least = np.floor((beyond - lengths[at] * error - errors[at] * length) / (units[at] * unit)) - 2
            least = np.clip(least, -LANE / 2, LANE / 2 - 1).astype(np.int16)
            for low in range(0, width, TILE_COLUMNS):
                high = min(low + TILE_COLUMNS, width)
                out = self.packed[:len(at) * (high - low)].reshape(len(at), high - low)
                np.matmul(q, columns[:, low:high], out=out)
                bounds = out.view(np.int16)
                some = np.flatnonzero(bounds.max(axis=1) >= least)
                if not len(some):
                    continue
                r, place = np.divmod(np.flatnonzero(bounds[some] >= least[some, None]), bounds.shape[1])
                place, lane = np.divmod(place, LANES + 1)
                c = lane * width + low + place
                real = (lane < LANES) & (c < n)
                r, c = some[r[real]], c[real]
                if len(r) * 4 > len(at) * (high - low):  # hardly sifted
                    for lane in range(LANES):
                        first, last = lane * width + low, min(lane * width + high, n)
                        if first < last:
                            self.meet(at, base, first, last)
                    self.scored -= len(at) * sum(max(0, min(x * width + high, n) - x * width - low) for x in range(LANES))
                    continue
                few = max(1, VERIFIED_NUMBERS // self.asked.points.shape[1])
                v = np.concatenate([np.einsum("ij,ij->i", self.asked.points[at[r[i:i + few]]], base.points[c[i:i + few]])
                                    for i in range(0, len(r), few)]) if len(r) else np.zeros(0)
                good = v >= self.floor[at[r]]
                if good.any():
                    self._keep(at[r[good]], base.first + base.order[c[good]], v[good])
        self.scored += len(rows) * n

    def _keep(self, r: np.ndarray, c: np.ndarray, v: np.ndarray) -> None:
        other = self.ids[r] != self.point_ids[c]
        self.found.append((r[other], c[other], np.rint(v[other].astype(float))))
        self.pending += len(self.found[-1][0])
        if self.pending > FOUND_AT_ONCE:
            self.settle()

    def settle(self) -> None:
        """Only each query's best stay; the k-th is what others have to reach."""
        if self.pending:
            r, c, v = _best(*[np.concatenate(f) for f in zip(*self.found)], self.point_ids, len(self.ids), self.k)
            self.found, self.pending = [(r, c, v)], 0
            last = np.flatnonzero(np.bincount(r, minlength=len(self.ids))[r] >= self.k)
            np.maximum.at(self.floor, r[last[self.k - 1::self.k]], v[last[self.k - 1::self.k]])

    def seed(self, bases: list[CoverTree]) -> None:
        """A first floor for queries without one, from the leaves whose centres score best."""
        new = np.flatnonzero(self.floor == -np.inf)
        for base in bases if len(new) else []:
            leaves = np.flatnonzero(~base.open)
            sizes = (base.high - base.low)[leaves]
            for start in range(0, len(new), TILE_ROWS):
                at = new[start:start + TILE_ROWS]
                order = np.argsort(-(self.asked.points[at].astype(float) @ base.centres[leaves].T), axis=1, kind="stable")
                before = np.cumsum(sizes[order], axis=1) - sizes[order]
                row, place = np.nonzero(before < self.k + self.spare)
                chosen = order[row, place]
                for leaf in np.unique(chosen):
                    self.meet(at[row[chosen == leaf]], base, base.low[leaves[leaf]], base.high[leaves[leaf]])
        self.settle()
        self.found = []  # the search meets these points again

    def descend(self, base: CoverTree, floors: np.ndarray):
        """Query leaves, point leaves and which pairs of them may hold a score that counts: both trees level by level."""
        asked, a, b, alive = self.asked, np.array([0]), np.array([0]), np.ones((1, 1), bool)
        while True:
            edges = np.column_stack([asked.low[a], asked.high[a]]).ravel()
            floor = np.minimum.reduceat(np.append(floors, np.inf), edges)[::2]
            ra, rb = asked.radius[a][:, None], base.radius[b][None, :]
            bound = (asked.centres[a] @ base.centres[b].T + ra * base.centre_norms[b] + rb * asked.centre_norms[a][:, None]
                     + ra * rb)
            slack = SLACK * (1 + (asked.centre_norms[a][:, None] + ra) * (base.centre_norms[b] + rb))
            alive &= bound + slack >= floor[:, None]
            rows, columns = alive.any(axis=1), alive.any(axis=0)
            a, b, alive = a[rows], b[columns], alive[rows][:, columns]
            open_a, open_b = asked.open[a], base.open[b]
            if not len(a) or not (open_a.any() or open_b.any()):
                return a, b, alive
            # the tree whose nodes are larger is next
            if open_a.any() and (not open_b.any() or asked.radius[a][open_a].max() >= base.radius[b][open_b].max()):
                a, origin = asked.below(a)
                alive = alive[origin]
            else:
                b, origin = base.below(b)
                alive = alive[:, origin]

    def queries(self, nodes: np.ndarray) -> np.ndarray:
        low, high = self.asked.low[nodes], self.asked.high[nodes]
        return np.arange((high - low).sum()) + np.repeat(low - np.cumsum(high - low) + (high - low), high - low)

    def admits(self, rows: np.ndarray, base: CoverTree, b: np.ndarray) -> np.ndarray:
        """Which of the nodes ``b`` each query's own bound admits: a query is a leaf of radius 0."""
        q = self.asked.points[rows].astype(float)
        norms = np.sqrt((q * q).sum(axis=1))[:, None]
        bound = q @ base.centres[b].T + norms * base.radius[b]
        return bound + SLACK * (1 + norms * (base.centre_norms[b] + base.radius[b])) >= self.floor[rows, None]

    def against(self, base: CoverTree) -> None:
        """Meet what the bounds leave of a tree: all of it where they leave most, else what both trees' descent finds."""
        leaves = np.flatnonzero(~base.open)
        some = np.arange(0, len(self.ids), EVERY)
        share = self.admits(some, base, leaves) @ (base.high - base.low)[leaves] / len(base.order)
        runs = np.add.reduceat(share, np.arange(0, len(some), TILE_ROWS // EVERY))
        dense = np.repeat(runs * EVERY >= DENSE * TILE_ROWS, TILE_ROWS)[:len(self.ids)]
        if dense.any():
            new = dense & (self.floor == -np.inf)
            if new.any():
                self.meet(np.flatnonzero(new), base, 0, len(base.order))
            self.sift(np.flatnonzero(dense & ~new), base)
        if not dense.all():
            a, b, alive = self.descend(base, np.where(dense, np.inf, self.floor))
            rows = self.queries(a)
            origin = np.repeat(np.arange(len(a)), self.asked.high[a] - self.asked.low[a])
            rows, origin = rows[~dense[rows]], origin[~dense[rows]]
            meets = alive[origin] & self.admits(rows, base, b)
            for at in np.flatnonzero(meets.any(axis=0)):
                self.meet(rows[meets[:, at]], base, base.low[b[at]], base.high[b[at]])
        if self.pending >= len(self.ids):
            self.settle()

    def result(self):
        if not self.found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        r, c, v = _best(*[np.concatenate(f) for f in zip(*self.found)], self.point_ids, len(self.ids), self.k)
        keep = v >= self.floor[r]
        return self.asked.first + self.asked.order[r[keep]], c[keep], v[keep]


def _longest(rows: np.ndarray) -> float:
    """The largest squared length."""
    return max((float((x * x).sum(axis=1).max()) for x in (rows[i:i + TREE].astype(float) for i in range(0, len(rows), TREE))),
               default=0.0)


def _trees(points: np.ndarray, most: int, kind: type):
    count = -(-len(points) // most)
    edges = np.linspace(0, len(points), count + 1).astype(int)
    for low, high in zip(edges[:-1], edges[1:]):
        yield CoverTree(points[low:high].astype(kind), WIDE_LEAF).settle(low)


def dual_tree_top_k(query_ids: np.ndarray, queries: np.ndarray, floors: np.ndarray, ids: np.ndarray,
                    points: np.ndarray, k: int, met: list[int] | None = None):
    """Per query its k best of ``points`` that reach its floor: (query, point, score) index arrays.

    Neighbours should stand together, as ``TREE`` points and ``BATCH`` queries
    in a row share a tree. ``met``, if given, gets the number of scores that
    were worked out.
    """
    # whole numbers: a sum of products is exact in single precision below 2**24
    kind = np.float32 if max(_longest(queries), _longest(points)) <= EXACT_SINGLE else np.float64
    ids, bases, out, scored = ids[:len(points)], list(_trees(points, TREE, kind)), [], 0
    spare, lanes = int(np.unique(ids, return_counts=True)[1].max()), Lanes(bases, queries, floors)
    for asked in _trees(queries, BATCH, kind):
        at = asked.first + asked.order
        search = _Search(asked, query_ids[at], floors[at], ids, k, spare, lanes)
        search.seed(bases)
        for base in sorted(bases, key=lambda b: -float(b.middle @ asked.middle)):  # the most promising first
            search.against(base)
        out.append(search.result())
        scored += search.scored
    if met is not None:
        met.append(scored)
    r, c, v = (np.concatenate(x) for x in zip(*out))
    return r, c, v.astype(np.int64)


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows))])


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of ``_binary``: two-byte whole numbers if all have them, else floats."""
    widths = np.array(pa.compute.binary_length(column))
    short = widths == 2 * dim
    if short.all() or not short.any():
        ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
        flat = np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]] if len(column) else np.zeros(0, np.uint8)
        return flat.view(np.int16 if short.all() else np.float64).reshape(len(column), dim)
    out = np.empty((len(column), dim))
    for those in (short, ~short):
        out[those] = _matrix(column.filter(pa.array(those)), dim)
    return out


VECTOR = "vec_id long, dim int, v binary"


def quantised(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id, dim, v`` (floor(scale * x) of each component, see ``_matrix``) of the vectors that take part."""
    kind = embeddings.schema["embedding"].dataType.elementType.typeName()
    x = F.col("embedding") if kind in ("float", "double") else F.col("embedding").cast("array<double>")

    def pack(batches):
        for batch in batches:
            if batch.column(0).null_count or batch.column(1).null_count:
                batch = batch.filter(pa.compute.and_(pa.compute.is_valid(batch.column(0)), pa.compute.is_valid(batch.column(1))))
            ids, values = batch.column(0).to_numpy(), batch.column(1)
            dims = np.array(pa.compute.list_value_length(values), np.int64)
            flat = np.multiply(values.flatten().to_numpy(zero_copy_only=False), scale, dtype=float)  # null: not a number
            np.floor(flat, out=flat)
            if len(flat) and dims.min() == dims.max() and -SHORT <= flat.min() and flat.max() <= SHORT:  # as a rule
                d = int(dims[0])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                                  _binary(flat.reshape(-1, d).astype(np.int16))], names=["vec_id", "dim", "v"])
                continue
            ends = np.append(0, np.cumsum(dims))
            odd = np.append(0, np.cumsum(~np.isfinite(values.flatten().to_numpy(zero_copy_only=False))))
            sound = odd[ends[1:]] == odd[ends[:-1]]
            for d in np.unique(dims[sound & (dims > 0)]):
                rows = np.flatnonzero(sound & (dims == d))
                whole = np.clip(flat[ends[rows, None] + np.arange(d)], -2.0**63, 2.0**63)
                short = np.abs(whole).max(axis=1) <= SHORT
                for own, number in ((short, np.int16), (~short, np.float64)):
                    if own.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[rows[own]], pa.int64()), pa.array(np.full(own.sum(), d), pa.int32()),
                             _binary(whole[own].astype(number))], names=["vec_id", "dim", "v"])

    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).mapInArrow(pack, VECTOR)


def _pivots(vectors: DataFrame, lengths: list[tuple[int, int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors) of the top level for each frequent length: the smallest by id hash, neighbours together."""
    wanted = {d: min(MOST_PIVOTS, max(PIVOTS, n // PER_PIVOT)) for d, n in lengths}
    places = 1 << 30
    at = F.pmod(F.xxhash64("vec_id"), F.lit(places))
    # rows among which there are enough
    most = F.coalesce(*[F.when(F.col("dim") == d, F.lit(int(places * min(1.0, (2 * wanted[d] + 64) / n)))) for d, n in lengths],
                      F.lit(0))
    top = vectors.withColumn("at", at).filter(F.col("at") < most).dropDuplicates(["vec_id"]).collect()
    out = {}
    for d, most in wanted.items():
        same = sorted((r for r in top if r["dim"] == d), key=lambda r: (r["at"], r["vec_id"]))[:most]
        if same:
            points = _matrix(pa.array([bytes(r["v"]) for r in same], pa.binary()), d).astype(float)
            order = CoverTree(points).order
            out[d] = np.array([r["vec_id"] for r in same])[order], points[order]
    return out


def _distinct(ids: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of the distinct rows; ids that repeat with several vectors all count."""
    order = np.argsort(ids, kind="stable")
    if not (ids[order[1:]] == ids[order[:-1]]).any():
        return np.arange(len(ids))
    key = np.column_stack([ids, np.unique(x, axis=0, return_inverse=True)[1].ravel()])
    return np.sort(np.unique(key, axis=0, return_index=True)[1])


def _search_rows(query_ids, q, floors, ids, x, k: int):
    """``dual_tree_top_k`` for ids that may repeat, in which case more than ``k`` rows a query are found."""
    repeats = int(np.unique(ids, return_counts=True)[1].max())  # 1, but for ids with several vectors
    return dual_tree_top_k(query_ids, q, floors, ids, x, k * repeats)


def top_k(embeddings: DataFrame, k: int = K, step: int = QUERY_STEP, scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of every vector whose id is divisible by ``step``."""
    spark = embeddings.sparkSession
    vectors = materialize(quantised(embeddings, scale), "quantised-vectors")
    lengths = [(r["dim"], r["n"]) for r in vectors.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), "dim").limit(LENGTHS + 1).collect()]
    pivots = _pivots(vectors, lengths[:LENGTHS])

    def assign(batches):
        """The nearest pivot and how far it is."""
        for batch in batches:
            sizes = np.array(batch.column("dim"))
            for d in np.unique(sizes):
                part = batch.filter(pa.array(sizes == d))
                own, near = np.full(part.num_rows, -1), np.zeros(part.num_rows)
                if int(d) in pivots:
                    x, p = _matrix(part.column("v"), int(d)), pivots[int(d)][1]
                    kind = np.float32 if max(_longest(x), _longest(p)) <= EXACT_SINGLE else np.float64
                    x, turned, squares = x.astype(kind), (2 * p.T).astype(kind), (p * p).sum(axis=1).astype(kind)
                    for low in range(0, len(x), TILE_ROWS):
                        own[low:low + TILE_ROWS] = (x[low:low + TILE_ROWS] @ turned - squares).argmax(axis=1)
                    gap = x.astype(float) - p[own]
                    near = np.sqrt((gap * gap).sum(axis=1))
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("dim"), part.column("v"),
                                                  pa.array(own, pa.int32()), pa.array(near)], names=["vec_id", "dim", "v", "pivot", "gap"])

    placed = materialize(vectors.mapInArrow(assign, VECTOR + ", pivot int, gap double"), "placed-vectors")
    crowd = placed.filter(F.col("pivot") >= 0).groupBy("dim", "pivot").agg(
        F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect()
    size_of = {d: np.zeros(len(p[0]), np.int64) for d, p in pivots.items()}
    radius_of = {d: np.zeros(len(p[0])) for d, p in pivots.items()}
    for r in crowd:
        size_of[r["dim"]][r["pivot"]], radius_of[r["dim"]][r["pivot"]] = r["n"], r["radius"]

    def most_of(d: int, n: int) -> int:
        """Vectors of a part: several parts a core, none too large for a worker, not too many for the queries' copies."""
        parts = min(MOST_PARTS, PARTS_A_CORE * spark.sparkContext.defaultParallelism)
        return max(1, min(max(BLOCK, -(-n // parts)), PART_NUMBERS // d))

    # parts: runs of neighbouring pivots; a crowded pivot has several of its own
    rows, parts_of = [], {}  # of a pivot: its blocks, first part and parts; of a part: its pivots
    for d, sizes in size_of.items():
        most, parts, room = most_of(d, int(sizes.sum())), [], 0
        for i, n in enumerate(map(int, sizes)):
            own = max(1, -(-n // most)) if n > 1.5 * most else 1
            if own > 1 or n > room:
                parts += [[] for _ in range(own)]
                room = most if own == 1 else 0
            for part in parts[-own:]:
                part.append(i)
            room -= n if own == 1 else 0
            rows.append((d, i, len(parts) - own, own))
        parts_of[d] = parts
    bare = [(d, n) for d, n in lengths if d not in pivots]
    others = max([1, *(-(-n // most_of(d, n)) for d, n in bare)])  # parts of each length without pivots
    split = F.broadcast(spark.createDataFrame(rows, "dim int, pivot int, first long, own long"))
    hashed, asks = F.xxhash64("vec_id"), F.col("vec_id") % step == 0
    dealt = (placed.join(split, ["dim", "pivot"], "left")
             .withColumn("part", F.coalesce("first", F.lit(0).cast("long"))
                         + F.pmod(hashed, F.coalesce("own", F.lit(others).cast("long"))))
             .select("dim", "pivot", "part", "vec_id", "v"))

    queries_n = placed.filter(asks).count()
    widest = max((d for d, _ in lengths), default=1)
    chunks = max(1, -(-queries_n // max(1, min(QUERY_BLOCK, QUERY_NUMBERS // widest))))

    def deal(batches, near: bool):
        """Each query to the parts that its bounds admit: the nearest of all ones, or what is left."""
        for batch in batches:
            sizes = np.array(batch.column("dim"))
            for d in np.unique(sizes):
                whole = batch.filter(pa.array(sizes == d))
                for low in range(0, whole.num_rows, TILE_ROWS):
                    part = whole.slice(low, TILE_ROWS)
                    n, floor = part.num_rows, part.column("floor").to_numpy()
                    if int(d) in pivots:
                        q, (ids, p) = _matrix(part.column("v"), int(d)).astype(float), pivots[int(d)]
                        dots = q @ p.T
                        if len(ids) > k:
                            rivals = np.where(ids[None, :] == part.column("vec_id").to_numpy()[:, None], -np.inf, dots)
                            floor = np.maximum(floor, -np.partition(-rivals, k - 1, axis=1)[:, k - 1])
                        norms, radius = np.sqrt((q * q).sum(axis=1))[:, None], radius_of[int(d)]
                        slack = SLACK * (1 + norms * (np.sqrt((p * p).sum(axis=1)) + radius))
                        admitted = (dots + norms * radius + slack >= floor[:, None]) & (size_of[int(d)] > 0)
                        inside = parts_of[int(d)]
                        order, starts = np.concatenate(inside), np.cumsum([0] + [len(x) for x in inside[:-1]])
                        best = np.maximum.reduceat(dots[:, order], starts, axis=1)
                        nearest = np.zeros(best.shape, bool)
                        np.put_along_axis(nearest, np.argsort(-best, axis=1, kind="stable")[:, :-(-len(inside) // NEAR)], True, axis=1)
                        which, at = np.nonzero(np.logical_or.reduceat(admitted[:, order], starts, axis=1) & (nearest == near))
                    else:
                        which, at = np.nonzero(np.full((n, others), near))
                    some = part.select(["dim", "pivot", "vec_id", "v"]).take(pa.array(which))
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(at, pa.int64()), pa.array(floor[which])],
                                                     names=["dim", "pivot", "vec_id", "v", "part", "floor"])

    keys = ["dim", "part", "chunk"]
    tasks = 4 * chunks * max(1, sum(map(len, parts_of.values())) + others * len(bare))
    points = (dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
              .select("dim", "pivot", "part", "chunk", "vec_id", "v").repartition(tasks, *keys))

    def rows_of(table: pa.Table):
        """(places of the distinct rows, neighbours together; ids; vectors)."""
        table = table.combine_chunks()
        ids, x = table.column("vec_id").to_numpy(), _matrix(table.column("v").combine_chunks(), table.column("dim")[0].as_py())
        pos = _distinct(ids, x)
        pos = pos[np.argsort(table.column("pivot").to_numpy()[pos], kind="stable")]
        return pos, ids[pos], x[pos]

    def search(ask: pa.Table, there: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        if ask.num_rows and there.num_rows:
            at, query_ids, q = rows_of(ask)
            _, ids, x = rows_of(there)
            r, c, v = _search_rows(query_ids, q, ask.column("floor").to_numpy()[at], ids, x, k)
            out = [query_ids[r], ids[c], v]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(pa.array, out))))

    def met(asked: DataFrame, near: bool) -> DataFrame:
        queries = (asked.select("dim", "pivot", "vec_id", "v", "floor")
                   .mapInArrow(lambda batches: deal(batches, near),
                               "dim int, pivot int, vec_id long, v binary, part long, floor double")
                   .withColumn("chunk", F.pmod(hashed, F.lit(chunks))).repartition(tasks, *keys))
        return queries.groupBy(*keys).cogroup(points.groupBy(*keys)).applyInArrow(
            search, "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return (found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
                .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k))

    # the nearest parts first: what they give is a floor for the others
    asked = placed.filter(asks)
    near = materialize(ranked(met(asked.withColumn("floor", F.lit(float("-inf"))), True)), "near-scores")
    floors = near.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    rest = met(asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))), False)
    return (ranked(near.select("query_id", "vec_id", "score").unionByName(rest))
            .select("query_id", "rank", "vec_id", "score"))
