"""Approximate nearest neighbours: low-dimensional stable projections indexed by kd-trees.

Vectors are projected onto M normal (2-stable) directions. For two vectors at distance d the squared projected distance
over d^2 follows a chi-square law of M degrees. A query verifies its projected neighbours, leaf by leaf in order of projected
distance, and stops when a vector still to come, were it nearer than the k-th found so far, would have shown up with
probability CONFIDENCE: when next_projected^2 >= quantile(CONFIDENCE) * kth^2. The largest inner product becomes the smallest distance
by one more coordinate, sqrt(most^2 - |x|^2), 0 for queries.

Equal vectors are one class, found by a salted grouping, with their k + 1 smallest ids: copies cost one comparison, and as
no query needs more ids of one class nothing is lost. Classes are dealt into cells by the top of a kd-tree fitted on a
bounded sample (SAMPLE) of projections; each cell is split into bounded blocks with kd-trees of their own. A query looks
into its own cell first; its k-th distance then sends it only to cells whose box can still matter. A cell's queries are dealt
into blocks, too, so no task holds all of either side, and its rows go only to the blocks of queries that visit it.

Rows whose vector is null, zero, or holds nulls or non-finite numbers, and rows without id, take no part. Shorter vectors
count as padded with zeros. Rows that share an id are
one query with several vectors, ranked together, and a candidate each. Ties go to the smaller id. Fewer candidates than k: all of them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, slices, values

M, CONFIDENCE, SEED = 8, 0.95, 11
SAMPLE, CELL_ROWS, MOST_CELLS, BLOCK_ROWS, QUERY_ROWS, LEAF = 20_000, 16_384, 4096, 16_384, 4096, 256
SALT = 256


def chi_square_quantile(p: float, degrees: int) -> float:
    """By bisection of the closed form for even degrees."""
    half = degrees // 2
    cdf = lambda x: 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(half))
    lo, hi = 0.0, 1e4
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def directions(dim: int) -> np.ndarray:
    return np.random.default_rng(SEED).normal(size=(dim + 1, M))


def split_tree(points: np.ndarray, leaves: int) -> list:
    """Nested (axis, threshold, low, high); a leaf is its number."""
    number = iter(range(1 << 30))

    def grow(p, n):
        if n <= 1 or len(p) < 2:
            return next(number)
        axis = int(np.ptp(p, axis=0).argmax())
        cut = float(np.median(p[:, axis]))
        low = p[:, axis] < cut
        return (axis, cut, grow(p[low], n // 2), grow(p[~low], n - n // 2))

    return grow(points, leaves)


def place(tree, points: np.ndarray) -> np.ndarray:
    out = np.zeros(len(points), np.int64)

    def walk(node, at):
        if isinstance(node, int):
            out[at] = node
        elif len(at):
            low = points[at, node[0]] < node[1]
            walk(node[2], at[low])
            walk(node[3], at[~low])

    walk(tree, np.arange(len(points)))
    return out


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """A kd-tree's leaves: halves along the widest axis down to LEAF points."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        at = stack.pop()
        if len(at) <= LEAF:
            out.append(at)
            continue
        axis = int(np.ptp(points[at], axis=0).argmax())
        o = at[np.argsort(points[at, axis], kind="stable")]
        stack += [o[: len(o) // 2], o[len(o) // 2 :]]
    return out


def box_distance2(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return (np.maximum(np.maximum(low - q, q - high), 0) ** 2).sum(-1)


def search(x: np.ndarray, px: np.ndarray, ids: np.ndarray, q: np.ndarray, pq: np.ndarray, kth: np.ndarray, k: int, most2: float, quantile: float):
    """For each query (row of q; kth: squared distance known already) the k best rows of x, of those no farther than kth:
    (query row, id, score). Queries take their leaves in order of distance, 1, 2, 4, ... a round; in a round a leaf meets all
    queries that still need it in one product, and then each query's distance to its k-th is brought down."""
    leaves = _leaves(px)
    bound = np.zeros((len(q), len(leaves)))
    for axis in range(px.shape[1]):
        low = np.array([px[a, axis].min() for a in leaves])
        high = np.array([px[a, axis].max() for a in leaves])
        bound += np.maximum(np.maximum(low - pq[:, axis : axis + 1], pq[:, axis : axis + 1] - high), 0) ** 2
    order = np.argsort(bound, axis=1, kind="stable")
    base = (q * q).sum(1) + most2
    limit = np.array(kth, float)
    least = (base - limit) / 2 - 1e-9 * (base + 1)  # scores below can't be among the k best; -inf where nothing is known
    best_q, best_x, best_s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    done, live = 0, np.arange(len(q))
    while done < len(leaves) and len(live):
        new = order[live, done : 2 * done + 1]
        far = np.take_along_axis(bound[live], new, 1)
        go = (far <= 0) | (far < quantile * limit[live, None])
        go[:, 0] |= done == 0
        who, leaf = np.repeat(live, go.sum(1)), new[go]
        live = live[go.all(1)]  # bounds ascend: whoever stops here needs no later leaf
        by_leaf = np.argsort(leaf, kind="stable")
        who, ends = who[by_leaf], np.cumsum(np.bincount(leaf, minlength=len(leaves)))
        found = [(best_q, best_x, best_s)]
        for at, lo, hi in zip(leaves, np.r_[0, ends[:-1]].tolist(), ends.tolist(), strict=True):
            if lo < hi:
                some = who[lo:hi]
                s = q[some] @ x[at].T
                floor = least[some]
                if done == 0 and len(at) > k:
                    floor = np.maximum(floor, np.partition(s, -k, axis=1)[:, -k])
                i, n = np.nonzero(s >= floor[:, None])
                found.append((some[i], at[n], s[i, n]))
        who, row, s = (np.concatenate(c) for c in zip(*found, strict=True))
        o = np.lexsort((ids[row], -s, who))
        who, row, s = who[o], row[o], s[o]
        first = np.searchsorted(who, who)
        nth = np.arange(len(who)) - first
        last = np.flatnonzero(nth == k - 1)
        least[who[last]] = np.maximum(least[who[last]], s[last])
        limit[who[last]] = np.minimum(limit[who[last]], np.maximum(base[who[last]] - 2 * s[last], 0))
        best_q, best_x, best_s = who[nth < k], row[nth < k], s[nth < k]
        done = 2 * done + 1
    # Scores by pairs alone, so that they don't depend on which queries met a leaf together.
    return best_q, ids[best_x], np.concatenate([(x[best_x[n : n + 4096]] * q[best_q[n : n + 4096]]).sum(1) for n in range(0, len(best_x), 4096)] or [np.empty(0)])


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, confidence: float = CONFIDENCE) -> DataFrame:
    """query_id, rank, vec_id, score for every query (id divisible by `every`)."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = vectors.agg(F.max(F.size(vector_col))).first()[0] or 0
    if dim < 1:
        return empty

    def clean(batches):
        for batch in slices(batches):
            ids, vecs, norms = [], [], []
            for i, v in zip(values(batch, "vec_id"), values(batch, "v"), strict=True):
                if i is None or not v or None in v:
                    continue
                x = np.zeros(dim)
                x[: len(v)] = v
                x += 0.0  # no negative zeros, equal vectors have equal bytes
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    vecs.append(x.tobytes())
                    norms.append(float(x @ x))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vecs, pa.binary()), pa.array(norms, pa.float64())], names=["vec_id", "v", "norm2"])

    rows = saved(vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).mapInArrow(clean, "vec_id long, v binary, norm2 double"))
    some = rows.groupBy("v", F.pmod("vec_id", F.lit(SALT)).alias("salt")).agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids"))
    classes = saved(some.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids")).select(F.col("ids")[0].alias("rep"), "v", "ids"))
    n, most2 = rows.agg(F.count("*"), F.max("norm2")).first()
    if not n:
        return empty
    n_classes = classes.count()
    g, quantile = directions(dim), chi_square_quantile(confidence, M)

    def project(x: np.ndarray, query: bool = False) -> np.ndarray:
        rest = np.zeros(len(x)) if query else np.sqrt(np.maximum(most2 - (x * x).sum(1), 0))
        return np.c_[x, rest] @ g

    as_rows = lambda blobs: np.frombuffer(b"".join(blobs), np.float64).reshape(-1, dim)
    share = min(1.0, SAMPLE / n_classes)
    limit = min(int(-(2**63) + share * 2**64), 2**63 - 1)
    drawn = [r.v for r in classes.where(F.xxhash64("rep") <= limit).orderBy(F.xxhash64("rep")).select("v").limit(2 * SAMPLE).collect()]
    cells = min(MOST_CELLS, max(1, 1 << math.ceil(math.log2(n_classes / CELL_ROWS)) if n_classes > CELL_ROWS else 1))
    tree = spark.sparkContext.broadcast(split_tree(project(as_rows(drawn)), cells) if drawn and cells > 1 else 0)

    def celled(batches):
        for batch in slices(batches):
            p = project(as_rows(values(batch, "v"))) if batch.num_rows else np.empty((0, M))
            yield pa.RecordBatch.from_arrays([pa.array(place(tree.value, p)), pa.array([x.tobytes() for x in p], pa.binary()), batch.column("rep"), batch.column("v")], names=["cell", "p", "rep", "v"])

    placed = saved(classes.select("rep", "v").mapInArrow(celled, "cell long, p binary, rep long, v binary"))

    def extent(table: pa.Table) -> pa.Table:
        p = np.frombuffer(b"".join(table.column("p").to_pylist()), np.float64).reshape(-1, M)
        return pa.table({"cell": table.column("cell").slice(0, 1), "n": pa.array([len(p)], pa.int64()), "low": pa.array([p.min(0).tobytes()], pa.binary()), "high": pa.array([p.max(0).tobytes()], pa.binary())})

    # Boxes by salted parts of a cell, so that no task holds a whole one.
    parts = placed.select("cell", "p", F.pmod(F.xxhash64("rep"), F.lit(64)).alias("salt")).groupBy("cell", "salt").applyInArrow(extent, "cell long, n long, low binary, high binary").collect()
    boxes: dict[int, list] = {}
    for r in parts:
        lo, hi = np.frombuffer(r.low), np.frombuffer(r.high)
        b = boxes.setdefault(r.cell, [0, lo, hi])
        b[0], b[1], b[2] = b[0] + r.n, np.minimum(b[1], lo), np.maximum(b[2], hi)
    names = sorted(boxes)
    shared = spark.sparkContext.broadcast((np.array(names), np.stack([boxes[c][1] for c in names]), np.stack([boxes[c][2] for c in names])))
    blocks = spark.createDataFrame([(c, -(-boxes[c][0] // BLOCK_ROWS)) for c in names], "cell long, blocks int")
    candidates = placed.join(F.broadcast(blocks), "cell").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).drop("blocks")
    asked = saved(rows.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "v").join(classes.select("rep", "v"), "v").select("query_id", F.col("rep").alias("query")))
    wanted = asked.select("query").distinct().join(classes.select(F.col("rep").alias("query"), "v"), "query")

    def routed(first: bool):
        """A row per query and cell that it has to see: its own, or the others that its k-th distance doesn't rule out."""

        def run(batches):
            cell, low, high = shared.value
            for batch in slices(batches):
                if not batch.num_rows:
                    continue
                pq = project(as_rows(values(batch, "v")), True)
                own = [int(box_distance2(p, low, high).argmin()) for p in pq]
                kth = [math.inf] * len(pq) if first else [math.inf if x is None else x for x in values(batch, "kth")]
                out = []
                for i, p in enumerate(pq):
                    bound = box_distance2(p, low, high)
                    go = [own[i]] if first else [c for c in np.flatnonzero((bound <= 0) | (bound < quantile * kth[i])) if c != own[i]]
                    out += [(int(cell[c]), i) for c in go]
                at = pa.array([i for _, i in out], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), batch.column("query").take(at), batch.column("v").take(at), pa.array([kth[i] for _, i in out], pa.float64())], names=["cell", "query", "v", "kth"])

        return run

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        x, q = as_rows(left.column("v").to_pylist()), as_rows(right.column("v").to_pylist())
        px = np.frombuffer(b"".join(left.column("p").to_pylist()), np.float64).reshape(-1, M)
        who, rep, s = search(x, px, left.column("rep").to_numpy(), q, project(q, True), right.column("kth").to_numpy(), k + 1, most2, quantile)
        return pa.table({"query": pa.array(right.column("query").to_numpy()[who]), "rep": pa.array(rep), "score": pa.array(s)})

    def searched(queries: DataFrame, first: bool) -> DataFrame:
        sent = saved(queries.mapInArrow(routed(first), "cell long, query long, v binary, kth double"))
        # A cell's rows go once to each QUERY_ROWS of the queries that visit it, and nowhere if none does. A row per cell.
        ways = F.broadcast(sent.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("ways")))
        sent = sent.join(ways, "cell").withColumn("q_block", F.pmod(F.xxhash64("query"), F.col("ways")).cast("int"))
        sent = sent.join(F.broadcast(blocks), "cell").withColumn("block", F.explode(F.expr("sequence(0, blocks - 1)")))
        met = candidates.join(ways, "cell").withColumn("q_block", F.explode(F.expr("sequence(0, ways - 1)"))).drop("ways")
        keys = ("cell", "block", "q_block")
        return saved(met.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(meet, "query long, rep long, score double"))

    def best(found: DataFrame) -> DataFrame:
        w = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
        return found.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k + 1)

    home = searched(wanted, True)
    kth = best(home).groupBy("query").agg(F.count("*").alias("m"), F.min("score").alias("s"))
    norm = classes.join(rows.select("v", "norm2").distinct(), "v").select(F.col("rep").alias("query"), "norm2")
    far = wanted.join(kth, "query", "left").join(norm, "query").select("query", "v", F.when(F.col("m") == k + 1, F.greatest(F.col("norm2") + F.lit(most2) - 2 * F.col("s"), F.lit(0.0))).alias("kth"))
    found = best(home.union(searched(far, False)) if len(names) > 1 else home).select("query", "rep", "score")
    pairs = asked.join(found, "query").join(classes.select("rep", "ids"), "rep").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
