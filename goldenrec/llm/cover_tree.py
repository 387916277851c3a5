"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are normalised in double precision; cosine >= c means a distance of at
most tau = sqrt(2 - 2c) on the unit sphere, where the triangle inequality
holds. Equal vectors are one node with a weight.

*Upper levels.* All vectors of a dimension are one cell. A cell that is not
small is parted: a few of its members (at most about ``FAN``) become pivots, a
member goes to its nearest pivot's child cell, whose covering radius is that of
its farthest member. A cell whose radius is at most half of tau links with
itself, without a look at its pairs. Cells are parted level by level until all
are small. Pivots, radii and counts are tables; rows of a cell meet its pivots
in shares of about ``leaf`` rows, so nothing here is collected or broadcast.

*Below.* The members of a small cell (or of a part of a large one that is a point or
links with itself) get nested levels of centres with halving radii, once, and
are written as one row, a block. Blocks meet in pairs, those of two cells only if
the cells' centres are within both covering radii plus tau (and not at all if they
are within tau minus both radii, as the cells link as a whole). That is a cross
product of the written blocks, which reads them again and sends nothing through
an exchange: what is written and shuffled grows with the vectors, not with the
pairs of cells. Two blocks meet level by level, beginning with the tree nodes in
reach of the other's cell: a pair of tree nodes goes on if their centres are
within both covering radii plus tau, is taken as a whole if they are within tau
minus both radii, and is otherwise split into its children; single vectors are
compared exactly. Bounds have a margin for rounding, so every pair at the
threshold is decided by its cosine in double precision.

What comes out is a row per linked vector (links counted, one edge to a member
of its component), never pairs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.operators.components import components
from goldenrec.session import materialize

RADII = (0.8, 0.4, 0.2, 0.1)
MARGIN = 1e-6
BLOCK = 512
PAIRS = 1 << 18
#: Pivots of a cell, at most about so many.
FAN = 64
#: A cell of a lesser radius is not parted again, whatever its size.
FLOOR = 1e-3
#: A cell of more than ``leaf`` members is still small if it has at most one of so
#: many shares of its dimension's vectors and its vectors are at most so many bytes
#: in double precision, as a task holds two blocks.
SHARES = 16
HELD = 1 << 24
BLOCK_DDL = "cell long, part long, inner boolean, radius double, dim long, weight long, centre array<double>, path binary, vecs binary, nodes binary, copies binary"
BLOCK_SCHEMA = pa.schema([("cell", pa.int64()), ("part", pa.int64()), ("inner", pa.bool_()), ("radius", pa.float64()), ("dim", pa.int64()), ("weight", pa.int64()),
                          ("centre", pa.list_(pa.float64())), *((c, pa.binary()) for c in ("path", "vecs", "nodes", "copies"))])


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (no row is zero)."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _net(x: np.ndarray, radius: float) -> np.ndarray:
    """Index of each point's centre: centres are over ``radius`` apart in the
    order of points, every point is within ``radius`` of its centre."""
    near = 1 - radius * radius / 2
    centre, chosen = np.full(len(x), -1, np.int64), np.zeros(0, np.int64)
    for k in range(0, len(x), BLOCK):
        own = np.arange(k, min(k + BLOCK, len(x)))
        if len(chosen):
            dots = x[own] @ x[chosen].T
            best = dots.argmax(axis=1)
            found = dots[np.arange(len(own)), best] >= near
            centre[own[found]] = chosen[best[found]]
            own = own[~found]
        close = x[own] @ x[own].T >= near
        for i in range(len(own)):
            if centre[own[i]] < 0:
                mine = close[i] & (centre[own] < 0)
                centre[own[mine]] = centre[own[i]] = own[i]
                chosen = np.append(chosen, own[i])
    return centre


def nested_levels(x: np.ndarray) -> np.ndarray:
    """(points x levels): each point's centre at every level; a level's nodes
    part those of the level above."""
    out, groups = np.zeros((len(x), len(RADII)), np.int64), [np.arange(len(x))]
    for level, radius in enumerate(RADII):
        below = []
        for g in groups:
            if len(g) == 1:
                out[g, level:] = g[0]
                continue
            c = g[_net(x[g], radius)]
            out[g, level] = c
            order = np.argsort(c, kind="stable")
            below += np.split(g[order], np.flatnonzero(np.diff(c[order])) + 1)
        groups = below
    return out


class Tree:
    """Points sorted by their path of centres: each level's nodes are ranges."""

    def __init__(self, x: np.ndarray, path: np.ndarray):
        self.order = np.lexsort(path.T[::-1])
        self.x, path = x[self.order], path[self.order]
        self.begins, self.radius = [], []
        for level in range(path.shape[1]):
            change = (path[1:, :level + 1] != path[:-1, :level + 1]).any(axis=1)
            begin = np.concatenate(([0], np.flatnonzero(change) + 1))
            size = np.diff(np.append(begin, len(x)))
            dots = np.einsum("ij,ij->i", self.x, np.repeat(self.x[begin], size, axis=0))
            self.begins.append(begin)
            self.radius.append(np.sqrt(np.maximum(2 - 2 * np.minimum.reduceat(dots, begin), 0)))
        self.begins.append(np.arange(len(x)))
        self.radius.append(np.zeros(len(x)))

    def ends(self, level: int) -> np.ndarray:
        return np.append(self.begins[level][1:], len(self.x))


def _children(tree: Tree, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(first child, number of children) of each node of a level."""
    below = tree.begins[level + 1]
    first = np.searchsorted(below, tree.begins[level])
    return first, np.searchsorted(below, tree.ends(level)) - first


def _expand(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) for runs of ``count`` positions from ``begin``."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begin[owner]


class Dual:
    """Meets two trees (or one with itself) and gathers links."""

    def __init__(self, a: Tree, b: Tree, weight_a: np.ndarray, weight_b: np.ndarray, cosine: float):
        self.a, self.b, self.same, self.cosine = a, b, a is b, cosine
        self.tau = float(np.sqrt(2 - 2 * cosine))
        self.weight_a, self.weight_b = weight_a[a.order], weight_b[b.order]
        self.sum_a, self.sum_b = (np.concatenate(([0], np.cumsum(w))) for w in (self.weight_a, self.weight_b))
        # Links of each point, as steps over ranges; edges between points, b's
        # numbered after a's.
        self.shift, self.held = (0 if self.same else len(a.x)), 0
        self.step_a, self.step_b = np.zeros(len(a.x) + 1, np.int64), np.zeros(len(b.x) + 1, np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def run(self, of_a: np.ndarray | None = None, of_b: np.ndarray | None = None) -> "Dual":
        """``of_a``, ``of_b``: the top nodes that can have a link, all if None.
        They meet in single precision, with room for its rounding; what is found
        is decided in ``_level``."""
        a, b = self.a, self.b
        of_a, of_b = (np.arange(len(t.begins[0])) if of is None else of for t, of in ((a, of_a), (b, of_b)))
        # By radius, so that most blocks have one bound for all of their pairs.
        of_a, of_b = (of[np.argsort(t.radius[0][of], kind="stable")] for t, of in ((a, of_a), (b, of_b)))
        (top_a, radius_a), (top_b, radius_b) = ((t.x[t.begins[0][of]].astype(np.float32), t.radius[0][of]) for t, of in ((a, of_a), (b, of_b)))
        room = self.tau + MARGIN
        slack = (a.x.shape[1] + 4) * 2.0 ** -23
        for k in range(0, len(of_a), BLOCK):
            for m in range(k // (2 * BLOCK) * 2 * BLOCK if self.same else 0, len(of_b), 2 * BLOCK):
                dots = top_a[k:k + BLOCK] @ top_b[m:m + 2 * BLOCK].T
                reach = radius_a[k:k + BLOCK][-1] + radius_b[m:m + 2 * BLOCK][-1] + room
                p, q = np.nonzero(dots >= 1 - reach * reach / 2 - slack)
                if not len(p):
                    continue
                reach = radius_a[k + p] + radius_b[m + q] + room
                fine = dots[p, q] >= 1 - reach * reach / 2 - slack
                if self.same:
                    fine &= k + p <= m + q
                i, j = of_a[k + p[fine]], of_b[m + q[fine]]
                if len(i):
                    self._level(0, *((np.minimum(i, j), np.maximum(i, j)) if self.same else (i, j)))
        return self

    def _level(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """Pairs of nodes of a level, all of them possibly near."""
        a, b = self.a, self.b
        p, q = a.begins[level][i], b.begins[level][j]
        leaf = level == len(a.begins) - 1
        for k in range(0, len(i), PAIRS):
            part = slice(k, k + PAIRS)
            dots = np.einsum("ij,ij->i", a.x[p[part]], b.x[q[part]])
            own_i, own_j = i[part], j[part]
            if leaf:
                hit = dots >= self.cosine
                if self.same:
                    hit &= own_i < own_j
                self._whole(level, own_i[hit], own_j[hit])
                continue
            spread = a.radius[level][own_i] + b.radius[level][own_j]
            far = np.sqrt(np.maximum(2 - 2 * dots, 0))
            whole = far + spread <= self.tau - MARGIN
            if self.same:
                whole &= own_i != own_j
            self._whole(level, own_i[whole], own_j[whole])
            go = np.flatnonzero(~whole & (far <= spread + self.tau + MARGIN))
            first_a, count_a = _children(a, level)
            first_b, count_b = _children(b, level)
            made = np.concatenate(([0], np.cumsum(count_a[own_i[go]] * count_b[own_j[go]])))
            lo = 0
            while lo < len(go):  # as many pairs at a time as have a block's children
                hi = max(lo + 1, int(np.searchsorted(made, made[lo] + PAIRS, "right")) - 1)
                self._split(level, own_i[go[lo:hi]], own_j[go[lo:hi]], first_a, count_a, first_b, count_b)
                lo = hi

    def _split(self, level, i, j, first_a, count_a, first_b, count_b) -> None:
        pair, child_a = _expand(first_a[i], count_a[i])
        again, child_b = _expand(first_b[j[pair]], count_b[j[pair]])
        child_a = child_a[again]
        if self.same:
            ahead = child_a <= child_b
            child_a, child_b = child_a[ahead], child_b[ahead]
        self._level(level + 1, child_a, child_b)

    def _whole(self, level: int, i: np.ndarray, j: np.ndarray) -> None:
        """All pairs between two ranges of points link."""
        if not len(i):
            return
        a, b = self.a, self.b
        p, q, p_end, q_end = a.begins[level][i], b.begins[level][j], a.ends(level)[i], b.ends(level)[j]
        for step, at, sums, lo, hi in ((self.step_a, (p, p_end), self.sum_b, q, q_end), (self.step_a if self.same else self.step_b, (q, q_end), self.sum_a, p, p_end)):
            more = sums[hi] - sums[lo]
            np.add.at(step, at[0], more)
            np.subtract.at(step, at[1], more)
        pair, left = _expand(p, p_end - p)
        self.edges.append((left, q[pair] + self.shift))
        pair, right = _expand(q, q_end - q)
        self.edges.append((p[pair], right + self.shift))
        self.held += len(left) + len(right)
        if self.held > 4 * PAIRS:  # down to a spanning forest
            label = self.labels()
            at = np.flatnonzero(label != np.arange(len(label)))
            self.edges, self.held = [(at, label[at])], 0

    def labels(self) -> np.ndarray:
        """Least point of each point's component; b's points follow a's."""
        label = np.arange(self.shift + len(self.b.x))
        u, v = (np.concatenate([e[k] for e in self.edges] or [np.zeros(0, np.int64)]) for k in (0, 1))
        while True:
            low = np.minimum(label[u], label[v])
            new = label.copy()
            np.minimum.at(new, u, low)
            np.minimum.at(new, v, low)
            new = new[new]
            if (new == label).all():
                return label
            label = new

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """(links of each point, label), a's points first, then b's."""
        links = np.cumsum(self.step_a)[:-1]
        if not self.same:
            links = np.concatenate((links, np.cumsum(self.step_b)[:-1]))
        return links, self.labels()


# --- Over a table -----------------------------------------------------------


def _usable(v) -> "F.Column":
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _key(v) -> "F.Column":
    """A hash that equal vectors share."""
    return F.xxhash64(v)


def _by_dim(batch: pa.RecordBatch | pa.Table):
    """(dimension, row indices, unit vectors) of a batch with a column vec."""
    column = batch.column(batch.schema.get_field_index("vec"))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        yield int(dim), at, unit(matrix(column.take(pa.array(at)), int(dim)))


def _longs(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


def _nearest(table: pa.Table) -> pa.Table:
    """Members of a share of a cell under the nearest of the cell's pivots."""
    table = table.sort_by("node")
    (_, _, x), = _by_dim(table)
    pivot, node = _longs(table, "pivot", "node")
    centre, own = np.flatnonzero(pivot), np.flatnonzero(~pivot)
    sub, gap = np.zeros(len(own), np.int64), np.zeros(len(own))
    for k in range(0, len(own), BLOCK):
        dots = x[own[k:k + BLOCK]] @ x[centre].T
        sub[k:k + BLOCK] = node[centre[dots.argmax(axis=1)]]
        gap[k:k + BLOCK] = np.sqrt(np.maximum(2 - 2 * dots.max(axis=1), 0))
    taken = table.take(pa.array(own)).select(["cell", "salt", "node", "vec", "copies"])
    return taken.append_column("sub", pa.array(sub)).append_column("gap", pa.array(gap))


def _levels(kind: str):
    """The members of a part, sorted by their path of centres, as one row."""
    def levels(table: pa.Table) -> pa.Table:
        (dim, _, x), = _by_dim(table)
        pivot, node, copies = _longs(table, "pivot", "node", "copies")
        own = np.flatnonzero(~pivot)
        if not len(own):
            return BLOCK_SCHEMA.empty_table()
        path = nested_levels(x[own]).astype(np.int32)
        order = np.lexsort(path.T[::-1])
        own, path = own[order], path[order]
        row = table.select(["cell", "part", "inner", "radius"]).slice(0, 1).to_pylist()[0]
        vecs = matrix(table.column("vec").combine_chunks(), dim)[own].astype(kind)
        row |= {"dim": dim, "weight": int(copies[own].sum()), "centre": x[pivot].reshape(-1), "path": path.tobytes(), "vecs": vecs.tobytes()}
        row |= {"nodes": node[own].tobytes(), "copies": copies[own].tobytes()}
        return pa.Table.from_pylist([row], schema=BLOCK_SCHEMA)

    return levels


class _Block:
    """One side of row ``k`` of a batch of pairs of blocks."""

    def __init__(self, batch: pa.RecordBatch, side: str, k: int, kind: str):
        def at(name):
            return batch.column(batch.schema.get_field_index(f"{side}_{name}"))[k]

        def of(name, dtype):
            return np.frombuffer(at(name).as_buffer(), dtype)

        self.cell, self.part, self.radius = (at(c).as_py() for c in ("cell", "part", "radius"))
        self.centre, self.copies = np.array(at("centre").as_py()), of("copies", np.int64)
        x = unit(of("vecs", kind).astype(np.float64).reshape(len(self.copies), -1))
        self.tree = Tree(x, of("path", np.int32).reshape(-1, len(RADII)))
        self.node = of("nodes", np.int64)[self.tree.order]

    def reached(self, other: "_Block", tau: float) -> np.ndarray:
        """The tree's top nodes that can hold a member near one of ``other``'s cell."""
        reach = self.tree.radius[0] + (other.radius + tau + MARGIN)
        return np.flatnonzero(self.tree.x[self.tree.begins[0]] @ other.centre >= 1 - reach * reach / 2)


def _meet(cosine: float, kind: str):
    """Links of pairs of blocks."""
    tau = float(np.sqrt(2 - 2 * cosine))

    def meet(batches):
        a = None
        for batch in batches:
            cells, parts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("a_cell", "a_part"))
            for k in range(batch.num_rows):
                if a is None or (a.cell, a.part) != (cells[k], parts[k]):
                    a = _Block(batch, "a", k, kind)
                b = _Block(batch, "b", k, kind)
                if a.cell != b.cell:
                    found = Dual(a.tree, b.tree, a.copies, b.copies, cosine).run(a.reached(b, tau), b.reached(a, tau))
                else:
                    found = Dual(a.tree, a.tree if a.part == b.part else b.tree, a.copies, b.copies, cosine).run()
                links, label = found.result()
                ids = a.node if found.same else np.concatenate((a.node, b.node))
                hit = np.flatnonzero(links > 0)
                yield pa.RecordBatch.from_pydict({"node": ids[hit], "links": links[hit], "root": ids[label[hit]]})

    return meet


def _in_shares(rows: DataFrame, keys: tuple[str, ...], run, schema: str, *parts: int) -> DataFrame:
    # Dealt out by all keys: a join by cell before would else leave a cell's
    # shares in one task.
    return rows.repartition(*parts, *keys).groupBy(*keys).applyInArrow(run, schema)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _part(members: DataFrame, opened: DataFrame, tau: float, leaf: int, fan: int, vec_type: str, level: int):
    """One level: the opened cells parted. Gives (members, cells, centres) of the
    children and the links (node, links, root) within those that link with
    themselves."""
    def kept(frame: DataFrame) -> DataFrame:
        return materialize(frame, "cover_tree")

    salt = F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt")
    most = F.least(F.lit(fan), F.greatest(F.lit(2), F.ceil(F.col("n") * 2 / F.col("small"))))
    shared = opened.withColumn("salts", F.ceil(F.col("n") / leaf)).withColumn("every", F.greatest(F.lit(1), F.floor(F.col("n") / most)))
    own = members.join(shared, "cell")
    # The old pivot and the member farthest from it are pivots too, so a level
    # always parts its cells.
    chosen = (F.pmod(F.xxhash64("node", F.lit(level)), F.col("every")) == 0) | (F.col("node") == F.col("cell")) | (F.col("node") == F.col("far"))
    pivots = kept(own.filter(chosen).select("cell", "node", "vec", "salts"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    dealt = own.select("cell", salt, F.lit(False).alias("pivot"), "node", "vec", "copies").unionByName(
        pivots.select("cell", each, F.lit(True).alias("pivot"), "node", "vec", F.lit(0).cast("long").alias("copies")))
    placed = kept(_in_shares(dealt, ("cell", "salt"), _nearest, f"cell long, salt long, node long, vec {vec_type}, copies long, sub long, gap double"))

    children = placed.groupBy(F.col("sub").alias("child")).agg(
        F.min("cell").alias("cell"), F.count(F.lit(1)).alias("n"), F.sum("copies").alias("weight"), F.max("gap").alias("radius"),
        F.max_by("node", "gap").alias("far"), (F.max("gap") <= (tau - MARGIN) / 2).alias("inner"))
    cells = kept(children.join(opened.select("cell", "small"), "cell").withColumn("cell", F.col("child")).drop("child"))
    members = placed.select(F.col("sub").alias("cell"), "node", "vec", "copies")
    links = members.join(cells.filter("inner").select("cell", "weight"), "cell").select(
        "node", (F.col("weight") - F.col("copies")).alias("links"), F.col("cell").alias("root"))
    return members, cells, pivots.select(F.col("node").alias("cell"), "node", "vec"), links


def _side(rows: DataFrame, name: str) -> tuple[DataFrame, dict]:
    return rows.select(*[F.col(c).alias(f"{name}_{c}") for c in rows.columns]), {c: F.col(f"{name}_{c}") for c in rows.columns}


def _apart(a: dict, b: dict, tau: float):
    """(whether two cells can have links, whether all of their pairs link)."""
    dot = F.aggregate(F.zip_with(a["centre"], b["centre"], lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    reach = a["radius"] + b["radius"] + (tau + MARGIN)
    room = F.lit(tau - MARGIN) - (a["radius"] + b["radius"])
    two = (a["cell"] != b["cell"]) & (a["dim"] - b["dim"] == 0)
    return two & (dot >= 1 - reach * reach / 2), two & (room >= 0) & (dot >= 1 - room * room / 2)


def _pairs(blocks: DataFrame, tau: float) -> DataFrame:
    """Pairs of blocks (columns a_*, b_*) whose members have to meet, each once.
    No conjunct of the condition is an equation of the two sides, which would
    make it a join that sends each block once for every pair."""
    blocks = blocks.withColumn("bit", F.xxhash64("cell", "part").bitwiseAND(1))
    (left, a), (right, b) = _side(blocks, "a"), _side(blocks, "b")
    one = a["cell"] == b["cell"]
    # Which of two blocks comes first is as good as drawn, so that every block
    # is first in about as many pairs.
    turn = ((a["cell"] < b["cell"]) | (one & (a["part"] < b["part"]))) == (a["bit"] == b["bit"])
    near, whole = _apart(a, b, tau)
    return left.join(right, (one & ~a["inner"] & ((a["part"] == b["part"]) | turn)) | (near & ~whole & turn)).drop("a_bit", "b_bit")


def _whole_cells(blocks: DataFrame, members: DataFrame, tau: float) -> list[DataFrame]:
    """Links (node, links, root) of cells all of whose pairs link."""
    cells = materialize(blocks.groupBy("cell").agg(*(F.first(c).alias(c) for c in ("dim", "radius", "centre")), F.sum("weight").alias("weight")), "cover_tree")
    (left, a), (right, b) = _side(cells, "a"), _side(cells, "b")
    met = materialize(left.join(right, _apart(a, b, tau)[1]).select("a_cell", "b_cell", "b_weight"), "cover_tree")
    sums = met.groupBy(F.col("a_cell").alias("cell")).agg(F.sum("b_weight").alias("links"))
    return [met.select(F.col("a_cell").alias("node"), F.lit(0).cast("long").alias("links"), F.col("b_cell").alias("root")),
            members.select("cell", "node").join(sums, "cell").select("node", "links", F.col("cell").alias("root"))]


def near_duplicates(rows: DataFrame, cosine: float = 0.9, leaf: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``rows``.

    Pairs with cosine >= ``cosine`` in double precision link; n_links counts the
    other rows linked directly, copies included; component_id is the least id
    reachable, itself included; kept is vec_id = component_id. Vectors that are
    NULL, empty, zero, or hold NULL or non-finite components link with nothing.
    Vectors of different dimensions link with nothing in common. Repeated rows
    are rows of their own. A row with a NULL id links like any other; it is not
    kept, and a component without ids has component_id NULL. Other columns are
    not read, so names cannot clash. An empty table gives an empty result.
    """
    given = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec"))
    usable = given.filter(_usable(F.col("vec"))).withColumn("key", _key(F.col("vec")))
    nodes = materialize(usable.groupBy("vec").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")).select(
        F.monotonically_increasing_id().alias("node"), _key(F.col("vec")).alias("key"), "*"), "cover_tree")
    vec_type = nodes.schema["vec"].dataType.simpleString()
    tau = float(np.sqrt(2 - 2 * cosine))
    members = nodes.select((-F.size("vec")).cast("long").alias("cell"), "node", "vec", "copies")  # a cell for each dimension
    centres = members.limit(0).select("cell", "node", "vec")
    held = F.least(F.floor(F.lit(HELD / 8) / -F.col("cell")), F.floor(F.col("n") / SHARES))
    cells = materialize(members.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("far")).select(
        "*", F.greatest(F.lit(leaf), held).alias("small"), F.lit(2.0).alias("radius"), F.lit(False).alias("inner")), "cover_tree")
    # A cell is parted unless it is small, a point, or links with itself.
    wide = (F.col("n") > F.col("small")) & (F.col("radius") > FLOOR) & ~F.col("inner")
    all_members, all_centres, all_shut, linked, level = [], [], [], [], 0
    while True:
        shut, opened = cells.filter(~wide).select("cell", F.ceil(F.col("n") / F.col("small")).alias("parts"), "inner", "radius"), cells.filter(wide)
        all_members.append(members.join(shut, "cell"))
        all_centres.append(centres.join(shut, "cell"))
        all_shut.append(shut.select("parts"))
        if opened.isEmpty():
            break
        members, cells, centres, links = _part(members, opened, tau, leaf, FAN, vec_type, level)
        linked.append(links)
        level += 1

    part = F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    split = _union(all_members).select("cell", part, "inner", "radius", F.lit(False).alias("pivot"), "node", "vec", "copies").unionByName(
        _union(all_centres).select("cell", each, "inner", "radius", F.lit(True).alias("pivot"), "node", "vec", F.lit(0).cast("long").alias("copies")))
    kind = "float32" if vec_type == "array<float>" else "float64"
    # As many files as blocks: a file's rows are in memory together.
    n_blocks = _union(all_shut).agg(F.sum("parts")).first()[0] or 1
    blocks = materialize(_in_shares(split, ("cell", "part"), _levels(kind), BLOCK_DDL, n_blocks), "cover_tree")
    met = _pairs(blocks, tau).mapInArrow(_meet(cosine, kind), "node long, links long, root long")
    if level:  # else a dimension is one cell
        linked += _whole_cells(blocks, _union(all_members), tau)
    linked = materialize(_union([met, *linked]), "cover_tree")
    roots = components(linked.select(F.col("node").alias("u"), F.col("root").alias("v")))

    sums = linked.groupBy("node").agg(F.sum("links").alias("links"))
    joined = materialize(nodes.select("node", "key", "first", "copies").join(sums, "node", "left").join(roots, "node", "left").select(
        "node", "key", F.coalesce("root", "node").alias("root"), "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "cover_tree")
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named, by = joined.join(least, "root"), "key"
    if not joined.groupBy("key").count().filter("count > 1").isEmpty():  # vectors that share a hash: by themselves, then
        named, by = nodes.select("node", "vec").join(named.select("node", "n_links", "component_id"), "node"), "vec"
    out = usable.select("vec_id", by).join(named.select(by, "n_links", "component_id"), by).select("vec_id", "n_links", "component_id").unionByName(
        given.filter(~_usable(F.col("vec"))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
