"""Exact k-nearest neighbours without an all-pairs join (shared by SMOTE
and the kNN classifier).

The reference rows are dealt to the leaves of a k-d tree over their first
principal axes (``pyspark.ml.feature.PCA``: a distributed d x d Gramian).  The
cuts come from a bounded sample of the reference rows, taken by hash; they only
say where a row lies.  All reference rows are in the tree, and the box of each
leaf is aggregated from its rows.  Because |u_i.(x - y)| <= ||x - y|| for unit
axes, no row of a leaf is nearer to x than the leaf's box.

1. Bound: x meets the rows of its own leaf; the k-th smallest distance r(x) is
   an upper bound on its true k-th distance.
2. Exact pass: x is sent to every other leaf (or, where boxes tell little,
   larger part of the tree) whose box lies within r(x), and meets its rows.

Where x and rows meet, Spark groups both by leaf (many queries of one leaf are
dealt to several groups) and numpy compares a block of them; the best k of a
group go on, and a window ranks them per query.  The bound follows the rows'
own density on as many axes as the tree has, so with twice the rows a query
meets about as many leaves as before.

Distances are plain sums of squares in the order of the feature columns; ties
are broken by the reference id, so the result equals a brute-force ORDER BY
(distance, id).  A row with a null has no distance and takes no part.  Rows
with NaN or infinite values lie outside the tree; queries without a finite
bound (and such queries themselves) meet all rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLED = 32                 # sampled reference rows a leaf, for the cuts
MOST_LEAVES = 4096           # boxes the driver holds; beyond, leaves take more rows
MOST_ROWS = 65_536           # reference rows of the largest part of the tree that queries are sent to
QUERIES = 8_192              # queries of one group
BLOCK = 2_000_000            # distances held at once
SEND = 1_000                 # cost of sending a query, in distances
ROUTED = 512                 # queries whose boxes are looked for at once, among ``MOST_LEAVES``
SENT = 10_000                # rows of one batch of queries sent


def principal_axes(ref: DataFrame, features: list[str], m: int) -> list[list[float]]:
    """First m principal axes of the reference rows (unit vectors); coordinate
    axes where fewer than two whole rows or fewer than m features are given."""
    d = len(features)
    vdf = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="skip").transform(ref.select(*features))
    if d >= m and len(vdf.select("_v").take(2)) == 2:
        pc = PCA(k=m, inputCol="_v", outputCol="_p").fit(vdf).pc.toArray()
        axes = [[float(pc[j, i]) for j in range(d)] for i in range(m)]
        if all(math.isfinite(x) for a in axes for x in a) and all(sum(x * x for x in a) > 0.5 for a in axes):
            return axes
    return [[1.0 if j == i else 0.0 for j in range(d)] for i in range(m)]


def knn(query: DataFrame, ref: DataFrame, qid: str, rid: str, features: list[str], k: int,
        exclude_self: bool = False, rows_per_cell: int = 1024, axes: int = 8) -> DataFrame:
    """(qid, ``nn_id``, ``dist`` (Euclidean), ``nn_rank`` 1..k) for every query row,
    ordered by (distance, reference id).

    ``query`` and ``ref`` carry an id column and the numeric ``features``.
    With ``exclude_self`` a query id never matches the same reference id.

    Copies are collapsed first, on both sides: the reference side becomes one
    row per distinct vector with its smallest k+1 ids (``row_number <= k+1``
    per vector — Spark keeps a partial top-(k+1) per map task, so a vector
    copied a third of the time shuffles a few rows).  The top-k rows by
    (distance, id) come from the first k+1 distinct vectors by (distance,
    smallest id), so the tree search runs on distinct vectors and the answer
    is expanded back from at most (k+1)^2 candidates per query row."""
    q, mine = collapsed(query, qid, features, 1)
    r, theirs = collapsed(ref, rid, features, k + 1)
    near = _knn_unique(q, r, "_rep", "_rep", features, k + 1 if exclude_self else k, rows_per_cell, axes)
    near = near.select(F.col("_rep").alias("_qid"), F.col("nn_id").alias("_rid"), "dist")
    return expanded(near, mine, theirs, qid, k, exclude_self)


def collapsed(df: DataFrame, key: str, features: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """One row per distinct vector, ``_rep`` (its smallest id) and the features;
    and ``_rep, _id``: the vector's smallest ``most`` ids (1: all its ids)."""
    rows = df.select(F.col(key).alias("_id"), *[F.col(f"`{f}`").cast("double").alias(f) for f in features])
    distinct = rows.groupBy(*features).agg(F.min("_id").alias("_rep"))
    vector = Window.partitionBy(*features)
    if most > 1:
        ids = rows.withColumn("_c", F.row_number().over(vector.orderBy("_id"))).where(F.col("_c") <= most)
        ids = ids.withColumn("_rep", F.min("_id").over(vector))
    else:
        # a null never meets a null in a join on equality
        same = [F.col(f"l.{f}").eqNullSafe(F.col(f"d.{f}")) for f in features]
        ids = rows.alias("l").join(distinct.alias("d"), same)
    return distinct.select("_rep", *features), ids.select("_rep", "_id")


def expanded(near: DataFrame, mine: DataFrame, theirs: DataFrame, qid: str, k: int, exclude_self: bool) -> DataFrame:
    """Neighbours of distinct vectors (``_qid, _rid, dist``) as neighbours of
    all query rows, ranked by (distance, id)."""
    out = near.join(theirs.toDF("_rid", "_nid"), "_rid").join(mine.toDF("_qid", "_q"), "_qid")
    if exclude_self:
        out = out.where(F.col("_q") != F.col("_nid"))
    w = Window.partitionBy("_q").orderBy("dist", "_nid")
    top = out.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    return top.select(F.col("_q").alias(qid), F.col("_nid").alias("nn_id"), "dist",
                      F.col("nn_rank").cast("int").alias("nn_rank"))


@dataclass
class _Tree:
    """k-d tree over projections: node i is cut on ``axis[i]`` at ``cut[i]``
    (up to it: ``left[i]``, beyond: ``right[i]``); a leaf has left -1."""

    axes: np.ndarray
    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaf(self, x: np.ndarray) -> np.ndarray:
        p, at = x @ self.axes.T, np.zeros(len(x), dtype=np.int64)
        while (inner := np.flatnonzero(self.left[at] >= 0)).size:
            n = at[inner]
            at[inner] = np.where(p[inner, self.axis[n]] <= self.cut[n], self.left[n], self.right[n])
        return at


def _grow(sample: np.ndarray, axes: np.ndarray, leaves: int, least: int) -> _Tree:
    """Halve the sampled rows on their widest axis until there are ``leaves``;
    a half keeps ``least`` of them, so that a leaf bounds its queries."""
    p = sample @ axes.T
    nodes, queue = [[0, 0.0, -1, -1]], [(0, np.arange(len(p)), max(0, math.ceil(math.log2(leaves))))]
    while queue:
        node, rows, depth = queue.pop()
        if not depth or len(rows) < 2 * least:
            continue
        for axis in np.argsort(-p[rows].std(axis=0), kind="stable"):
            cut = np.sort(p[rows, axis])[(len(rows) - 1) // 2]
            below = p[rows, axis] <= cut
            if least <= below.sum() <= len(rows) - least:
                nodes[node] = [int(axis), float(cut), len(nodes), len(nodes) + 1]
                queue += [(len(nodes), rows[below], depth - 1), (len(nodes) + 1, rows[~below], depth - 1)]
                nodes += [[0, 0.0, -1, -1], [0, 0.0, -1, -1]]
                break
    axis, cut, left, right = zip(*nodes)
    return _Tree(axes, np.array(axis), np.array(cut), np.array(left), np.array(right))


@dataclass
class _Boxes:
    """Rows and box of each node; ``cell[i]``: queries are sent to node i as a whole."""

    tree: _Tree
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    cell: np.ndarray

    def with_cells(self, most: int) -> "_Boxes":
        cell = (self.rows <= most) | (self.tree.left < 0)
        return _Boxes(self.tree, self.rows, self.low, self.high, cell)

    def of_leaves(self) -> list[tuple[int, int]]:
        """(leaf, the cell it lies in)."""
        out, queue = [], [(0, -1)]
        while queue:
            node, over = queue.pop()
            over = node if over < 0 and self.cell[node] else over
            if self.tree.left[node] < 0:
                out.append((int(node), int(over)))
            else:
                queue += [(self.tree.left[node], over), (self.tree.right[node], over)]
        return out

    def near(self, x: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of ``x``, cell whose box lies within ``r`` of it), all of them."""
        p = x @ self.tree.axes.T
        # rounding room for the projections
        reach = r * (1 + 1e-9) + 1e-9 + 1e-12 * np.abs(p).max(axis=1, initial=0.0)
        who, node, found = np.arange(len(x)), np.zeros(len(x), dtype=np.int64), []
        while len(who):
            gap = np.maximum(np.maximum(self.low[node] - p[who], p[who] - self.high[node]), 0.0)
            keep = (self.rows[node] > 0) & ~(np.sqrt((gap * gap).sum(axis=1)) > reach[who])
            who, node = who[keep], node[keep]
            end = self.cell[node]
            found.append((who[end], node[end]))
            who, node = np.repeat(who[~end], 2), np.stack([self.tree.left[node[~end]], self.tree.right[node[~end]]], axis=1).ravel()
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _boxes(tree: _Tree, leaves: list) -> _Boxes:
    """From one row a leaf: its number, rows, smallest and largest projections."""
    n, m = len(tree.left), len(tree.axes)
    rows, low, high = np.zeros(n, dtype=np.int64), np.full((n, m), np.inf), np.full((n, m), -np.inf)
    for r in leaves:
        rows[r["_leaf"]], low[r["_leaf"]], high[r["_leaf"]] = r["_n"], r["_low"], r["_high"]
    for node in range(n - 1, -1, -1):                     # children come after their parent
        if tree.left[node] >= 0:
            ends = [tree.left[node], tree.right[node]]
            rows[node], low[node], high[node] = rows[ends].sum(), low[ends].min(axis=0), high[ends].max(axis=0)
    return _Boxes(tree, rows, low, high, tree.left < 0)


def _values(x: pd.Series, d: int) -> np.ndarray:
    return np.concatenate(x.to_numpy()).reshape(-1, d) if len(x) else np.zeros((0, d))


def nearest(q: np.ndarray, r: np.ndarray, ids: np.ndarray, none: np.ndarray, k: int, reach: np.ndarray | None = None,
            apart: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, row of ``r``, distance): the first k by (distance, id, null
    ids first) per row of ``q``, within ``reach``.  Rows with the same number in
    ``apart`` don't meet.  A matrix product tells which pairs may be near
    enough; only their distances are summed."""
    center = r.mean(axis=0)
    rc, out, step = r - center, [], max(1, BLOCK // max(1, len(r)))
    rn = (rc * rc).sum(axis=1)
    for lo in range(0, len(q), step):
        part = q[lo:lo + step]
        qc = part - center
        qn = (qc * qc).sum(axis=1)
        rough, room = qn[:, None] + rn - 2 * (qc @ rc.T), 1e-11 * (qn[:, None] + rn)
        if reach is None:
            kth = np.partition(rough + room, k - 1, axis=1)[:, k - 1] if len(r) >= k else np.full(len(part), np.inf)
        else:
            kth = reach[lo:lo + step] ** 2 * (1 + 1e-9) + 1e-18
        i, j = np.nonzero(~(rough - room > kth[:, None]))
        if apart is not None:
            other = apart[0][lo + i] != apart[1][j]
            i, j = i[other], j[other]
        total = np.zeros(len(i))
        for f in range(q.shape[1]):
            gap = part[i, f] - r[j, f]
            total += gap * gap
        dist = np.sqrt(total)
        order = np.lexsort((ids[j], ~none[j], dist, i))
        i, j, dist = i[order], j[order], dist[order]
        first = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((lo + i[first], j[first], dist[first]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _meet(q: DataFrame, r: DataFrame, run, schema: str) -> DataFrame:
    """``run`` on the queries and reference rows with the same ``_cell``."""
    groups = q.groupBy("_cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("_g")).persist()
    q = q.join(F.broadcast(groups), "_cell").withColumn("_part", F.pmod(F.xxhash64("_qid"), F.col("_g")).cast("int")).drop("_g")
    r = r.join(F.broadcast(groups), "_cell").withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_g") - 1))).drop("_g")
    return q.groupBy("_cell", "_part").cogroup(r.groupBy("_cell", "_part")).applyInPandas(run, schema)


def _knn_unique(query: DataFrame, ref: DataFrame, qid: str, rid: str, features: list[str], k: int,
                rows_per_cell: int, axes: int) -> DataFrame:
    """Tree-pruned exact kNN against a reference side without repeated vectors."""
    d = len(features)
    m = max(1, min(axes, d))
    qtype, rtype = query.schema[qid].dataType.simpleString(), ref.schema[rid].dataType.simpleString()
    vector = F.array(*[F.col(f"`{f}`").cast("double") for f in features]).alias("_x")
    # read by the axes, the sample, the boxes and both passes: keep them (MEMORY_AND_DISK; lost blocks are recomputed).
    # Conditions are set on what is kept: below renamed columns the optimizer would derive them for every set of those
    whole_rows = ~F.exists("_x", lambda x: x.isNull())
    r = ref.select(F.col(rid).alias("_rid"), vector).persist().where(whole_rows).withColumn("_none", F.col("_rid").isNull())
    q = query.select(F.col(qid).alias("_qid"), vector).persist().where(whole_rows & F.col("_qid").isNotNull())
    finite = F.forall("_x", lambda x: F.abs(x) < float("inf"))
    inside = r.where(finite)
    n_ref = inside.count()
    U = np.array(principal_axes(inside.select(*[F.col("_x")[j].alias(f"_x{j}") for j in range(d)]), [f"_x{j}" for j in range(d)], m))
    leaves = max(1, min(MOST_LEAVES, n_ref // max(rows_per_cell, 2 * (k + 1))))
    want = leaves * max(SAMPLED, 4 * (k + 1))
    some = inside if n_ref <= want else inside.where(F.pmod(F.xxhash64("_x"), F.lit(n_ref)) < want)
    sample = np.array([x[0] for x in some.select("_x").collect()] if leaves > 1 else [], dtype=float).reshape(-1, d)
    tree = _grow(sample, U, leaves, k + 1)

    @F.pandas_udf("long")
    def place(x: pd.Series) -> pd.Series:
        with np.errstate(all="ignore"):
            return pd.Series(tree.leaf(_values(x, d)))

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        return pd.Series(list(_values(x, d) @ U.T))

    # rows outside the tree lie in leaf -1
    r = r.withColumn("_leaf", F.when(finite, place("_x")).otherwise(F.lit(-1))).persist()
    at = r.where("_leaf >= 0").select("_leaf", project("_x").alias("_p"))
    boxes = _boxes(tree, at.groupBy("_leaf").agg(
        F.count("*").alias("_n"), F.array(*[F.min(F.col("_p")[i]) for i in range(m)]).alias("_low"),
        F.array(*[F.max(F.col("_p")[i]) for i in range(m)]).alias("_high")).collect())    # a row a leaf

    def refs(group: pd.DataFrame) -> tuple:
        none = group["_none"].to_numpy(dtype=bool)
        return _values(group["_x"], d), group["_key"].to_numpy(), none

    # null ids rank first among equal distances, as in an ORDER BY; _key stands in for them
    r = r.withColumn("_key", F.coalesce("_rid", F.lit(0).cast(rtype)))
    qout = f"_qid {qtype}, _x array<double>"
    found = f"_keys array<{rtype}>, _nones array<boolean>, _dists array<double>"

    def listed(n: int, got: tuple, ids: np.ndarray, none: np.ndarray) -> dict:
        i, j, dist = got
        ends = np.searchsorted(i, np.arange(1, n))
        return {"_keys": np.split(ids[j], ends), "_nones": np.split(none[j], ends), "_dists": np.split(dist, ends)}

    def bound(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty:
            return left[["_qid", "_x"]].assign(_own=0, _reach=0.0, _keys=None, _nones=None, _dists=None)
        x, (v, ids, none) = _values(left["_x"], d), refs(right)
        with np.errstate(all="ignore"):
            got = nearest(x, v, ids, none, k) if len(v) else (np.zeros(0, dtype=int), np.zeros(0, dtype=int), np.zeros(0))
        out = left[["_qid", "_x"]].assign(_own=left["_cell"], **listed(len(x), got, ids, none))
        # the k-th distance is a bound only when k rows were seen
        reach = np.array([t[k - 1] if len(t) >= k else np.inf for t in out["_dists"]])
        return out.assign(_reach=np.where(np.isfinite(reach), reach, np.inf))[["_qid", "_x", "_own", "_reach", "_keys", "_nones", "_dists"]]

    mine = q.withColumn("_cell", place("_x")).persist()
    first = _meet(mine, r.where("_leaf >= 0").select("_key", "_none", "_x", F.col("_leaf").alias("_cell")), bound,
                  f"{qout}, _own long, _reach double, {found}")
    # a query in a leaf without rows meets none there
    lost = mine.join(r.select(F.col("_leaf").alias("_cell")).distinct(), "_cell", "left_anti").select(
        "_qid", "_x", F.lit(-2).cast("long").alias("_own"), F.lit(float("inf")).alias("_reach"),
        *[F.array().cast(f"array<{t}>").alias(c) for c, t in (("_keys", rtype), ("_nones", "boolean"), ("_dists", "double"))])
    first = first.unionByName(lost).persist()

    # how large a part of the tree a query is sent to, by the cost for a few queries
    few = first.select("_reach", "_x").limit(128).collect()
    if few:
        reach, x = np.array([t[0] for t in few]), np.array([t[1] for t in few], dtype=float)
        def cost(most: int) -> float:
            b = boxes.with_cells(most)
            _, to = b.near(x, reach)
            return len(to) * SEND + float(b.rows[to].sum())
        sizes = [0] + [MOST_ROWS >> s for s in range(6)]
        with np.errstate(all="ignore"):
            boxes = boxes.with_cells(min(sizes, key=lambda s: (cost(s), s)))
    whole = bool((boxes.tree.left[boxes.cell] >= 0).any())   # else a cell is a leaf, and a query's own was searched

    def route(batches):
        for b in (b.iloc[lo:lo + ROUTED] for b in batches for lo in range(0, len(b), ROUTED)):
            with np.errstate(all="ignore"):
                who, cell = boxes.near(_values(b["_x"], d), b["_reach"].to_numpy())
            far = np.flatnonzero(np.isinf(b["_reach"].to_numpy()))
            who, cell = np.concatenate([who, far]), np.concatenate([cell, np.full(len(far), -1)])
            if not whole:
                other = b["_own"].to_numpy()[who] != cell
                who, cell = who[other], cell[other]
            for lo in range(0, len(who), SENT):
                yield b.iloc[who[lo:lo + SENT]].assign(_cell=cell[lo:lo + SENT])

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        x, (v, ids, none) = _values(left["_x"], d), refs(right)
        if not len(x) or not len(v):
            return pd.DataFrame({"_qid": left["_qid"][:0], "_key": ids[:0], "_none": none[:0], "dist": np.zeros(0)})
        with np.errstate(all="ignore"):
            i, j, dist = nearest(x, v, ids, none, k, left["_reach"].to_numpy(), (left["_own"].to_numpy(), right["_leaf"].to_numpy()))
        return pd.DataFrame({"_qid": left["_qid"].to_numpy()[i], "_key": ids[j], "_none": none[j], "dist": dist})

    sent = first.select("_qid", "_x", "_own", "_reach").mapInPandas(route, f"{qout}, _own long, _reach double, _cell long").persist()
    cells = q.sparkSession.createDataFrame([*boxes.of_leaves(), (-1, -1)], "_leaf long, _cell long")      # a row a leaf
    placed = r.select("_key", "_none", "_leaf", "_x").join(F.broadcast(cells), "_leaf")
    more = _meet(sent, placed, search, f"_qid {qtype}, _key {rtype}, _none boolean, dist double")
    own = first.select("_qid", F.explode(F.arrays_zip("_keys", "_nones", "_dists")).alias("_t")) \
        .select("_qid", F.col("_t._keys").alias("_key"), F.col("_t._nones").alias("_none"), F.col("_t._dists").alias("dist"))
    # pandas takes NaN for null
    pairs = own.unionByName(more).select("_qid", F.when(~F.col("_none"), F.col("_key")).alias("_rid"),
                                         F.coalesce("dist", F.lit(float("nan"))).alias("dist"))
    w = Window.partitionBy("_qid").orderBy("dist", "_rid")
    top = pairs.withColumn("nn_rank", F.row_number().over(w)).where(F.col("nn_rank") <= k)
    return top.select(F.col("_qid").alias(qid), F.col("_rid").alias("nn_id"), "dist",
                      F.col("nn_rank").cast("int").alias("nn_rank"))


def array_to_columns(df: DataFrame, col: str, dim: int, prefix: str = "v") -> tuple[DataFrame, list[str]]:
    """Expand a fixed-length array column into scalar columns (a projection)."""
    names = [f"{prefix}{i}" for i in range(dim)]
    return df.withColumns({n: F.col(col)[i].cast("double") for i, n in enumerate(names)}), names
