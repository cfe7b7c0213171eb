"""Approximate nearest neighbours by learned partitions, in two levels.

Parts are learned from bounded samples of distinct vectors: the graph of a sample's nearest neighbours
is halved along its slowest mode again and again, which cuts few edges and gives equal parts; moves to
the part of most neighbours follow. A small network learns which parts hold a vector's neighbours.
Inside each part a second level is learned in the same way, on an executor. There are about as many
leaves as the square root of the rows, so leaves grow as slowly as their number does.

Every row is stored in its most probable leaf; a query goes to its most probable leaves, by the product
of both levels, and is compared there with all rows, in double precision. How many leaves are probed is
measured: a bounded sample of rows is compared with all rows by brute force.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm._common import stage

#: Distinct vectors that a network is fitted on, for each of its parts. Parts grow with the fourth root of the rows.
SAMPLE_ROWS = 256
NEIGHBOURS = 10
#: Rows that are compared with all others to set the number of leaves probed, and the share of neighbours these must hold.
MEASURED, RECALL = 256, 0.97
#: Rows of a leaf that a task holds at once.
BLOCK = 8192
#: Numbers that one step of routing holds.
STEP = 1 << 22


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of x from y; scaled where squares leave the range of doubles."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        difference = x - y
        d = np.sqrt((difference * difference).sum(axis=1))
        odd = ~(d < 1e150) | (d < 1e-140)
        if odd.any():
            some = difference[odd]
            most = np.abs(some).max(axis=1)
            unit = some / np.where((most > 0) & np.isfinite(most), most, 1)[:, None]
            d[odd] = np.where(most > 0, np.where(np.isfinite(most), most * np.sqrt((unit * unit).sum(axis=1)), np.inf), 0)
    return d


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x) if k else 0, 512):
        d = squared(x[at : at + 512], x)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        order = np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable")
        out[at : at + 512] = np.take_along_axis(near, order, 1)
    return out


def balanced_parts(graph: np.ndarray, parts: int, rounds: int = 12, steps: int = 80, slack: float = 1.1) -> np.ndarray:
    """Equal halves of the neighbour graph, again and again; then moves to the part of most neighbours while it has room.

    A half is cut at the median of the slowest mode of diffusion over the edges inside a part.
    """
    n, rng = len(graph), np.random.default_rng(0)
    part = np.zeros(n, np.int64)
    ends = np.repeat(np.arange(n), graph.shape[1]), graph.reshape(-1)
    a, b = np.r_[ends[0], ends[1]], np.r_[ends[1], ends[0]]
    for _ in range(parts.bit_length() - 1):
        inside = part[a] == part[b]
        u, v = a[inside], b[inside]
        degree = np.bincount(u, minlength=n) + 1e-9
        count = int(part.max(initial=0)) + 1
        weight = np.bincount(part, weights=degree, minlength=count)
        y = rng.normal(size=n)
        for _ in range(steps):
            y = (y + np.bincount(u, weights=y[v], minlength=n) / degree) / 2
            y -= (np.bincount(part, weights=degree * y, minlength=count) / weight)[part]
            y /= np.sqrt(np.bincount(part, weights=y * y, minlength=count) + 1e-300)[part]
        order = np.lexsort((y, part))
        sizes = np.bincount(part, minlength=count)
        place = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        half = np.zeros(n, np.int64)
        half[order] = place >= np.repeat(sizes // 2, sizes)
        part = 2 * part + half
    room = int(np.ceil(slack * n / parts))
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (ends[0], part[ends[1]]), 1)
        np.add.at(votes, (ends[1], part[ends[0]]), 1)
        to = np.argmax(votes, axis=1)
        gain = votes[np.arange(n), to] - votes[np.arange(n), part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for k in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if sizes[to[k]] < room:
                sizes[part[k]] -= 1
                sizes[to[k]] += 1
                part[k] = to[k]
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of parts."""
        w1, b1, w2, b2 = self.weights
        s = np.maximum((x - self.mean) / self.scale @ w1 + b1, 0) @ w2 + b2
        s -= s.max(axis=1, keepdims=True)
        return s - np.log(np.exp(s).sum(axis=1, keepdims=True))


def train_router(x: np.ndarray, target: np.ndarray, hidden: int = 64, epochs: int = 40, rate: float = 3e-3) -> Router:
    """One hidden layer, cross entropy against the distribution of each vector's neighbours over parts."""
    rng = np.random.default_rng(0)
    scale = x.std(axis=0)
    r = Router(x.mean(axis=0), np.where(scale > 0, scale, 1.0), [])
    z = (x - r.mean) / r.scale
    shape = [(x.shape[1], hidden), (hidden,), (hidden, target.shape[1]), (target.shape[1],)]
    w = [rng.normal(0, (2 / s[0]) ** 0.5, s) if len(s) == 2 else np.zeros(s) for s in shape]
    m, v, t = [np.zeros(s) for s in shape], [np.zeros(s) for s in shape], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            k = order[at : at + 128]
            h = np.maximum(z[k] @ w[0] + w[1], 0)
            s = h @ w[2] + w[3]
            p = np.exp(s - s.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - target[k]) / len(k)
            dh = d @ w[2].T * (h > 0)
            t += 1
            for i, g in enumerate((z[k].T @ dh, dh.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    r.weights = w
    return r


def fit(x: np.ndarray, parts: int, neighbours: int = NEIGHBOURS) -> Router:
    """x: distinct vectors in a range whose squares are doubles; parts: a power of two."""
    graph = neighbour_graph(x, neighbours)
    part = balanced_parts(graph, parts)
    each = graph.shape[1]
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), each), part[graph.reshape(-1)]), 1 / (each + 1))
    target[np.arange(len(x)), part] += 1 / (each + 1)
    return train_router(x, target)


@dataclass
class Tree:
    """A network over parts, one over the leaves of each part, and the largest number of the sample, by which vectors are divided."""

    unit: float
    top: Router
    below: list[Router]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x / self.unit, -1e6, 1e6)

    def leaves(self) -> int:
        return sum(len(r.weights[3]) for r in self.below)

    def home(self, x: np.ndarray) -> np.ndarray:
        z, width = self.scaled(x), len(self.below[0].weights[3])
        part = np.argmax(self.top.scores(z), axis=1)
        out = np.empty(len(z), np.int64)
        for p in np.unique(part).tolist():
            at = part == p
            out[at] = p * width + np.argmax(self.below[p].scores(z[at]), axis=1)
        return out

    def order(self, x: np.ndarray) -> np.ndarray:
        """All leaves of each vector, most probable first."""
        z = self.scaled(x)
        both = self.top.scores(z)[:, :, None] + np.stack([r.scores(z) for r in self.below], axis=1)
        return np.argsort(-both.reshape(len(z), -1), axis=1, kind="stable")


def usable(vector: str) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    v = F.col(vector)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return v.isNotNull() & F.forall(v, lambda x: F.coalesce(finite(x), F.lit(False))) & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False)))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _drawn(rows: DataFrame, share: float, salt: int) -> DataFrame:
    """Distinct vectors of this share of all, chosen by their hashes, with copies counted once."""
    return rows.where(F.pmod(F.xxhash64("v", F.lit(salt)), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30)) + 1).select("v").distinct()


def power(x: float) -> int:
    """The power of two nearest to x, 1 at least."""
    return 1 << max(0, round(np.log2(max(1.0, x))))


def build_tree(rows: DataFrame, n: int, sample_rows: int = SAMPLE_ROWS) -> Tree:
    """Learn parts and leaves for n rows (v); about sample_rows * n**0.25 vectors come to the driver, and as many to the task of each part."""
    spark, parts = rows.sparkSession, power(n**0.25)
    want = sample_rows * parts
    sample = np.array([r.v for r in _drawn(rows, want / n, 1).orderBy(F.xxhash64("v"), "v").limit(2 * want).collect()], np.float64)
    unit = float(np.abs(sample).max())
    tree = Tree(unit, fit(np.clip(sample / unit, -1e6, 1e6), parts), [])
    held = spark.sparkContext.broadcast(tree)

    def of_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = np.argmax(held.value.top.scores(held.value.scaled(_vectors(b.column(0)))), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), b.column(0)], ["part", "v"])

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["v"].to_numpy()).astype(np.float64)
        x = x[np.lexsort(x.T[::-1])][: 4 * want]
        r = fit(held.value.scaled(x), parts)
        return pd.DataFrame({"part": [int(rows["part"].iloc[0])], "arrays": [[a.astype(np.float32).tobytes() for a in (r.mean, r.scale, *r.weights)]]})

    drawn = _drawn(rows, want * parts / n, 2).mapInArrow(of_part, "part long, v array<double>")
    made = {r["part"]: [np.frombuffer(a, np.float32).astype(np.float64) for a in r["arrays"]] for r in drawn.groupBy("part").applyInPandas(learn, "part long, arrays array<binary>").collect()}
    d = sample.shape[1]
    for p in range(parts):
        if p in made:
            mean, scale, w1, b1, w2, b2 = made[p]
            tree.below.append(Router(mean, scale, [w1.reshape(d, -1), b1, w2.reshape(len(b1), -1), b2]))
        else:  # no vector of the sample is at home there
            tree.below.append(Router(np.zeros(d), np.ones(d), [np.zeros((d, 1)), np.zeros(1), np.zeros((1, parts)), np.zeros(parts)]))
    return tree


def nearest(y: np.ndarray, own: int | None, ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of the k nearest rows, ties to lesser ids; of the rows that are ``own`` in id and vector one is left out."""
    d = distances(vectors, y)
    here = np.ones(len(d), bool)
    if own is not None:
        same = np.flatnonzero(ids == own)
        same = same[(vectors[same] == y).all(axis=1)]
        here[same[:1]] = False
    some = np.flatnonzero(here)
    if len(some) > k:
        some = some[d[some] <= np.partition(d[some], k - 1)[k - 1]]
    some = some[np.lexsort((ids[some], d[some]))][:k]
    return some, d[some]


def search(rows: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, sample_rows: int = SAMPLE_ROWS, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """The k nearest other rows found for each row for which ``queries`` holds: query_id, rank, vec_id, score.

    Scores are Euclidean distances of the original vectors in double precision; ties go to the lesser id.
    A query leaves out one row of its own id and vector, itself; other rows of its id are candidates, and
    each row of a repeated id has an answer of its own. All candidates are returned if they are k or fewer.
    Rows without an id, unusable vectors and vectors of another dimension than most take no part. Of
    copies of one vector only the k + 1 least ids can be among the k nearest, so only these are stored.
    """
    spark = rows.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("q")).where(F.col("id").isNotNull() & usable("v"))
    sizes = {r["d"]: r["count"] for r in base.groupBy(F.size("v").alias("d")).count().collect()}  # one row per dimension
    if not sizes:
        return spark.createDataFrame([], out)
    dimension = max(sizes, key=lambda d: (sizes[d], d))
    base = base.where(F.size("v") == dimension)
    tree = spark.sparkContext.broadcast(build_tree(base, sizes[dimension], sample_rows))  # about 64 numbers a leaf

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(tree.value.home(_vectors(b.column(1)))), *b.columns], ["leaf", "id", "v"])

    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    stored = base.select("id", "v").withColumn("n", nth).where(F.col("n") <= k + 1).select("id", "v")
    index = stage(stored.mapInArrow(placed, "leaf long, id long, v array<double>"), "index")
    leaves = tree.value.leaves()
    counts = np.zeros(leaves, np.int64)
    for r in index.groupBy("leaf").count().collect():  # one row per leaf
        counts[r["leaf"]] = r["count"]
    probes = spark.sparkContext.broadcast((measured(index, tree, counts, k, recall), counts))

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, held = probes.value
        step = max(1, STEP // leaves)
        for b in batches:
            x, found = _vectors(b.column(1)), []
            for at in range(0, len(x), step):
                order = tree.value.order(x[at : at + step])
                # As many leaves as were measured, and more until they hold k rows beside the query's own.
                enough = (np.cumsum(held[order], axis=1) < k + 1).sum(axis=1) + 1
                found += [o[: max(least, e)].tolist() for o, e in zip(order, enough)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64())), *b.columns], ["probes", "id", "v", "times"])

    blocks = F.broadcast(spark.createDataFrame(pd.DataFrame({"leaf": np.arange(leaves), "blocks": -(-counts // block)})))  # one row per leaf
    held = index.join(blocks, "leaf").select("leaf", F.pmod(F.xxhash64("id"), "blocks").alias("block"), F.lit(0).alias("asks"), "id", "v", F.lit(0).cast("long").alias("times"))
    asked = base.where("q").groupBy("id", "v").agg(F.count("*").alias("times")).mapInArrow(routed, "probes array<long>, id long, v array<double>, times long")
    asked = asked.select(F.explode("probes").alias("leaf"), "id", "v", "times").join(blocks, "leaf").where("blocks > 0")
    asked = asked.select("leaf", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("asks"), "id", "v", "times")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors = None, [], []
        for b in batches:
            at = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((at[1:] != at[:-1]).any(axis=1)) + 1).tolist(), len(at)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                part = b.slice(lo, hi - lo)
                if tuple(at[lo, :2]) != key:
                    key, ids, vectors = tuple(at[lo, :2]), [], []
                own, x = part.column(3).to_numpy(), _vectors(part.column(4))
                if at[lo, 2] == 0:
                    ids.append(own)
                    vectors.append(x)
                elif ids:
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    found: list[tuple] = []
                    for q, y, times in zip(own.tolist(), x, part.column(5).to_pylist()):
                        some, d = nearest(y, q, ids[0], vectors[0], k)
                        name = np.uint64(xxhash.xxh64_intdigest(y.tobytes())).astype(np.int64)
                        found += zip([q] * len(some), [name] * len(some), [times] * len(some), ids[0][some].tolist(), d.tolist())
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 5, types)], ["query_id", "name", "times", "vec_id", "score"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = held.unionByName(asked).repartition(tasks, "leaf", "block").sortWithinPartitions("leaf", "block", "asks").mapInArrow(compare, "query_id long, name long, times long, vec_id long, score double")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "name").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("query_id", "rank", "vec_id", "score")


def measured(index: DataFrame, tree, counts: np.ndarray, k: int, recall: float) -> int:
    """How many leaves hold this share of the true neighbours of a bounded sample of rows, each compared with all rows."""
    spark, n = index.sparkSession, int(counts.sum())
    drawn = index.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < int(min(1.0, MEASURED / n) * (1 << 30)) + 1).orderBy(F.xxhash64("id"), "id").limit(2 * MEASURED).collect()
    if not drawn:
        return tree.value.leaves()
    asked = spark.sparkContext.broadcast((np.array([r["id"] for r in drawn]), np.array([r["v"] for r in drawn], np.float64)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, x = asked.value
        for b in batches:
            leaf, ids, vectors = b.column(0).to_numpy(), b.column(1).to_numpy(), _vectors(b.column(2))
            found: list[tuple] = []
            for q, (i, y) in enumerate(zip(own.tolist(), x)):
                some, d = nearest(y, i, ids, vectors, k)
                found += zip([q] * len(some), leaf[some].tolist(), ids[some].tolist(), d.tolist())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found) if found else [[]] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.float64()))], ["q", "leaf", "id", "d"])

    near = index.mapInArrow(compare, "q long, leaf long, id long, d double")
    true = near.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("d", "id"))).where(F.col("rank") <= k).select("q", "leaf").collect()  # k rows a query of the sample
    order = tree.value.order(asked.value[1])
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], 1)
    needed = np.sort([place[r["q"], r["leaf"]] for r in true]) if true else np.zeros(1, int)
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1
