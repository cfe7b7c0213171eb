"""Near copies by the exact Jaccard similarity of their sets of shingles.

SimHash links and bands of MinHash values propose: texts that have one in common are connected, nothing
more. What is connected is then compared pair by pair, exactly, and the groups are the components of the
pairs that are similar enough. A pair is missed only if no link, no band and no path of them connects it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm._common import materialize, pieces, small_batches, text_or_empty
from textloom.llm.graph import components, named, within
from textloom.llm.maps import hot_map, in_hot
from textloom.llm.simhash import DISTANCE, SEED, fingerprint_of, hashes, links, with_names

#: At similarity 0.8 a pair shares no band of six values once in 190,000 times.
ROWS, BANDS = 6, 40
#: A band is chained in SALTS parts if over HOT_ROWS of one in SAMPLED rows have it.
SALTS, SAMPLED, HOT_ROWS = 64, 64, 64
#: For quotients that floating point rounds up.
_EPS = 1e-9

_RANDOM = np.random.default_rng(SEED)
_XOR = _RANDOM.integers(0, 1 << 64, (ROWS * BANDS, 1), np.uint64)
_TIMES = _RANDOM.integers(0, 1 << 64, (ROWS * BANDS, 1), np.uint64) | np.uint64(1)
_MIX = _RANDOM.integers(0, 1 << 64, (BANDS, ROWS), np.uint64) | np.uint64(1)


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending; none for a text without words."""
    return np.unique(hashes(text, shingle))


def bands(found: np.ndarray) -> np.ndarray:
    """A key for each band of a set's MinHash values; none for an empty set."""
    if not len(found):
        return np.zeros(0, np.int64)
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 256):
        least = np.minimum(least, ((found[at : at + 256] ^ _XOR) * _TIMES).min(axis=1))
    keys = (least.reshape(BANDS, ROWS) ^ least.reshape(BANDS, ROWS) >> np.uint64(29)) * _MIX
    keys = np.bitwise_xor.reduce(keys ^ keys >> np.uint64(32), axis=1)
    return ((keys >> np.uint64(6) << np.uint64(6)) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def linked(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places whose links connect the sets of at least this similarity, directly or by others of these sets.

    Shingles are ordered from rare to common. A set and one not larger that are similar enough share
    one of the first shingles of both, so many that the rest could not make up for them.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    size = np.array([len(sets[i]) for i in order])
    _, ids, df = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    rank = np.empty(len(df), np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    ids = np.sort(np.repeat(np.arange(len(size)), size) * len(df) + rank[ids]) % max(len(df), 1)
    start = np.r_[0, np.cumsum(size)]
    place = np.arange(len(ids)) - np.repeat(start[:-1], size)
    first = np.array([n - ceil(2 * similarity / (1 + similarity) * n - _EPS) + 1 for n in size.tolist()])
    indexed = np.flatnonzero((place < np.repeat(first, size)) & (np.sort(df)[ids] > 1))
    indexed = indexed[np.argsort(ids[indexed], kind="stable")]
    holders = np.repeat(np.arange(len(size)), size)[indexed]
    at = np.searchsorted(ids[indexed], np.arange(len(df) + 1))
    has = np.zeros(len(df), bool)
    label = np.arange(len(size))
    a, b = [], []
    for x in range(1, len(size)):
        n = int(size[x])
        mine = ids[start[x] : start[x + 1]]
        probed = mine[: n - ceil(similarity * n - _EPS) + 1]
        lists = [holders[i:j] for i, j in zip(at[probed].tolist(), at[probed + 1].tolist()) if j > i]
        if not lists:
            continue
        met = np.concatenate(lists)
        hits = np.bincount(met[met < x], minlength=x)
        near = np.flatnonzero(hits)
        near = near[(size[near] >= similarity * n - _EPS) & (label[near] != label[x])]
        near = near[np.argsort(-hits[near], kind="stable")]
        has[mine] = True
        step = 1
        while len(near):
            now, near = near[:step], near[step:]
            step = min(4 * step, 256)
            begins = np.r_[0, np.cumsum(size[now])]
            places = np.arange(begins[-1]) + np.repeat(start[now] - begins[:-1], size[now])
            common = np.add.reduceat(has[ids[places]].astype(np.int64), begins[:-1])
            for y in now[common >= similarity * (n + size[now] - common) - _EPS].tolist():
                if label[y] != label[x]:
                    a.append(x)
                    b.append(y)
                    label[label == label[y]] = label[x]
            near = near[label[near] != label[x]]
        has[mine] = False
    return order[np.array(a, np.int64)], order[np.array(b, np.int64)]


def banded(classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect the fp of rows (fp, bands) with a band in common.

    Rows of one band are linked to their first. A band of very many rows, found in a sample, is linked in
    SALTS parts, and the firsts of these parts are linked too.
    """
    posted = classes.select("fp", F.explode("bands").alias("k"))
    star = lambda rows, *by: rows.select(F.first("fp").over(Window.partitionBy(*by).orderBy("fp")).alias("a"), F.col("fp").alias("b")).where("a <> b")
    hot = hot_map(posted.where(F.pmod(F.xxhash64("fp"), F.lit(SAMPLED)) == 0).groupBy("k").count().where(F.col("count") > HOT_ROWS), "k")
    if not hot.any():
        return star(posted, "k")
    salt = F.when(in_hot(hot, "k"), F.pmod(F.xxhash64("fp"), F.lit(SALTS))).otherwise(-1)
    salted = posted.withColumn("salt", salt)
    firsts = salted.where("salt >= 0").groupBy("k", "salt").agg(F.min("fp").alias("fp"))
    return star(salted, "k", "salt").unionByName(star(firsts, "k"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order_col: str | None = None, shingle: int = 5, similarity: float = 0.8, distance: int = DISTANCE) -> DataFrame:
    """One row per document: id and component_id, the id of that row of its group which is the least by (order_col, id), nulls first.

    Rows of one id have one text. Texts of one set of shingles are one class, which enters the search once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [hashes(t, shingle) for t in batch.column(2).to_pylist()]
            sets = [np.unique(h) for h in found]
            names = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            sim = np.array([fingerprint_of(h) for h in found], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names), pa.array(sim), pa.array([bands(s) for s in sets], pa.list_(pa.int64())), pc.binary_length(batch.column(2))], ["id", "place", "fp", "sim", "bands", "size"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(order_col or id_col).alias("place"), text_or_empty(text_col).alias("text"))
    types = {c: rows.schema[c].dataType.simpleString() for c in ("id", "place")}
    marked = materialize(rows.mapInArrow(run, f"id {types['id']}, place {types['place']}, fp long, sim long, bands array<long>, size int"))
    classes = materialize(marked.groupBy("fp").agg(F.min(F.struct("place", "id")).alias("least"), F.first("sim").alias("sim"), F.first("bands").alias("bands"), F.max("size").alias("size")))
    proposed = banded(classes).unionByName(links(classes.select(F.col("fp").alias("node"), F.col("sim").alias("fp")), distance))
    roots = components(proposed)
    chosen = classes.join(roots.select(F.col("node").alias("fp"), "root").hint("merge"), "fp").select("root", F.col("fp").alias("node"), F.col("least.id").alias("id"), "size")
    texts = rows.join(chosen.select("id", "node").hint("merge"), "id").groupBy("node").agg(F.first("text").alias("value"))
    found = components(within(chosen, texts, lambda column: [shingle_set(t, shingle) for t in column.to_pylist()], lambda sets: linked(sets, similarity)))
    names = named(classes, found, "fp", F.col("least")).select("fp", F.col("component_id.id").alias("component_id"))
    return with_names(marked.select("id", "fp"), names).select(F.col("id").alias(id_col), "component_id")
