"""SimHash fingerprints and near-duplicate groups by an inverted index on byte positions.

Fingerprints that differ in at most three bits differ in at most three of eight bytes, so they share
at least five. The index is keyed by four positions and their bytes: fourteen sets of four positions
form a Steiner system, in which any three positions lie together in just one set, and the complement
of a set is a set. So each pair of at most three differing bytes meets under a key. Met pairs are
tallied by bytes shared, those under the guaranteed minimum are dropped, the others are verified by
differing bits. Under a key with many fingerprints only a spanning forest of the links is kept, which
has the same groups; a link met under several keys is kept under the first.

With a similarity, links only propose: texts are compared by the exact Jaccard similarity of their sets of
shingles (``shingles``). Fingerprints of texts at 0.8 differ in about ten of 64 bits, which no index finds
among many, so bands of MinHash values propose as well, and both proposals are verified in the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import maps
from textloom.llm._common import large_batches, materialize, pieces, small_batches, text_or_empty
from textloom.llm.graph import components, named
from textloom.llm.maps import hot_map, joined

SEED = 42
SHINGLE = 3
DISTANCE = 3
#: Fingerprints under one key that a task compares at once; more are dealt to pairs of blocks.
BLOCK = 1 << 15
#: Keys with so few rows are searched together.
FEW = 32


def hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """XXH64 of each run of so many words, of all words if they are fewer; none for a text without words."""
    words = text.encode().lower().split()  # of bytes: only A-Z change, only blanks and \t to \r separate
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[:-1]][:n].tolist()
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], "<u8")


def fingerprint_of(h: np.ndarray) -> int:
    """Bit i is set if it is set in over half of these hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    return fingerprint_of(hashes(text, shingle))


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id and fp (64 bits as a signed long) of every row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [_signed(fingerprint(t, shingle)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def position_sets(distance: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that two fingerprints within the distance share all bytes of one of them.

    Up to three bits: the Steiner system. Up to six, 8 - distance bytes are shared: with one group of
    positions less than that, two of the shared ones are in one group, so pairs inside groups do.
    """
    if distance <= 3:
        return [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
    if distance > 6:
        raise ValueError("two of eight bytes are sure to be shared only up to six differing bits")
    return [s for s in combinations(range(8), 2) if s[0] % (7 - distance) == s[1] % (7 - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _shared(differ: np.ndarray) -> np.ndarray:
    """Of each difference the set of its zero bytes, as bits."""
    return np.packbits(differ.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little").reshape(-1)


def _close(differ: np.ndarray, distance: int) -> np.ndarray:
    """Which of these differences share enough bytes, and then differ in few enough bits."""
    near = np.bitwise_count(_shared(differ)) >= 8 - distance
    near[near] = np.bitwise_count(differ[near]) <= distance
    return near


def _first_sets(distance: int) -> np.ndarray:
    """Of each set of shared bytes the number of the first set of positions inside it."""
    sets = [sum(1 << p for p in s) for s in position_sets(distance)]
    return np.array([next((n for n, m in enumerate(sets) if m & x == m), 255) for x in range(256)])


def forest(values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places whose links connect what is within the distance, directly or by others of these values."""
    return spanning(values, lambda differ: _close(differ, distance))


def spanning(values: np.ndarray, near_by: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places whose links connect what ``near_by`` accepts by its difference, directly or by others of these values."""
    a, b, rest = [], [], np.arange(len(values))
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = near_by(values[rest] ^ values[x])
            if near.any():
                found = rest[near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue.extend(found.tolist())
                rest = rest[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, int), np.zeros(0, int))


#: The low bits of a key number its set of positions.
_SETS = 31


def _links(distance: int, block: int):
    """Over rows (k, node, value) sorted by k: links (0, a, b, 0), and of a key with over ``block`` rows its rows (block number + 1, k, node, value)."""
    first = _first_sets(distance)

    def rows(kind, a, b, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(kind, np.int64)), pa.array(a), pa.array(b), pa.array(c.view(np.int64))], ["kind", "a", "b", "c"])

    def found(key: np.ndarray, nodes: np.ndarray, values: np.ndarray, x: np.ndarray, y: np.ndarray) -> Iterator[pa.RecordBatch]:
        here = first[_shared(values[x] ^ values[y])] == (key & _SETS)
        if here.any():
            zero = np.zeros(int(here.sum()), np.int64)
            yield rows(zero, nodes[x[here]], nodes[y[here]], zero)

    def few(keys: np.ndarray, nodes: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Keys with at most FEW rows: each row with the next of its key, the one after, and so on."""
        at = np.arange(len(keys))
        for lag in range(1, FEW):
            at = at[at + lag < len(keys)]
            at = at[keys[at] == keys[at + lag]]
            if not len(at):
                return
            near = at[_close(values[at] ^ values[at + lag], distance)]
            yield from found(keys[near], nodes, values, near, near + lag)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        key, count = None, 0

        def members(nodes: np.ndarray, values: np.ndarray, start: int) -> pa.RecordBatch:
            return rows((np.arange(len(nodes)) + start) // block + 1, np.full(len(nodes), key, np.int64), nodes, values)

        def whole() -> tuple[np.ndarray, np.ndarray]:
            return np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])

        def close() -> Iterator[pa.RecordBatch]:
            if 1 < count <= block:
                nodes, values = whole()
                x, y = forest(values, distance)
                yield from found(np.full(len(x), key), nodes, values, x, y)

        for batch in batches:
            keys, nodes, values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            values = values.view(np.uint64)
            if not len(keys):
                continue
            cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
            sizes = np.diff(cuts)
            # Keys that begin and end inside this batch and have few rows go together; the others, one by one.
            small = sizes <= FEW
            small[0] = small[-1] = False
            inside = np.repeat(small, sizes)
            yield from few(keys[inside], nodes[inside], values[inside])
            for a, b in zip(cuts[:-1][~small].tolist(), cuts[1:][~small].tolist()):
                if keys[a] != key:
                    yield from close()
                    held, key, count = [], int(keys[a]), 0
                before, count = count, count + b - a
                if count <= block:
                    held.append((nodes[a:b], values[a:b]))
                else:
                    if held:
                        yield members(*whole(), 0)
                        held = []
                    yield members(nodes[a:b], values[a:b], before)
        yield from close()

    return run


def _numbered(key: Column, n: Column) -> Column:
    return key.bitwiseAND(F.lit(~_SETS)).bitwiseOR(n.cast("long"))


def links(classes: DataFrame, distance: int = DISTANCE, block: int | None = None) -> DataFrame:
    """Links (a, b) between nodes of rows (node, fp) that make the same groups as all pairs within the distance."""
    block = block or BLOCK
    masks = [sum(0xFF << 8 * p for p in s) for s in position_sets(distance)]
    postings = [F.struct(_numbered(F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(_signed(m)))), F.lit(n)).alias("k")) for n, m in enumerate(masks)]
    schema = "kind long, a long, b long, c long"
    dealt = lambda d: d.repartition("k").sortWithinPartitions("k")
    postings = classes.select(F.explode(F.array(*postings)).alias("p"), "node", "fp").select("p.k", "node", F.col("fp").alias("value"))
    with large_batches(classes.sparkSession):
        met = materialize(dealt(postings).mapInArrow(_links(distance, block), schema))
    found = met.where("kind = 0").select("a", "b")
    large = met.where("kind > 0").select(F.col("a").alias("k"), F.col("b").alias("node"), F.col("c").alias("value"), (F.col("kind") - 1).alias("mine"))
    if large.isEmpty():
        return found
    # Every two rows of such a key meet in the pair of their blocks.
    counts = large.groupBy("k").agg((F.max("mine") + 1).alias("n"))
    pairs = large.join(counts, "k").select("k", "node", "value", "mine", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("other"))
    key = _numbered(F.xxhash64("k", F.least("mine", "other"), F.greatest("mine", "other")), F.col("k").bitwiseAND(F.lit(_SETS)))
    return found.unionByName(dealt(pairs.select(key.alias("k"), "node", "value")).mapInArrow(_links(distance, 2 * block), schema).select("a", "b"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE, similarity: float | None = None, order_col: str | None = None) -> DataFrame:
    """One row per document: id, fp, component_id (the least id of its group, itself included).

    Texts without words have the fingerprint 0 and are linked like any other. Copies share a
    fingerprint and enter the search once. A null id is no component's name unless it has no other.
    An empty table has no groups; extra columns are ignored.

    With a similarity: id and component_id, the id of that row of its group which is the least by
    (order_col, id), nulls first; rows of one id must have one text. See ``shingles.groups``.
    """
    if similarity is not None:
        from textloom.llm import shingles

        return shingles.groups(docs, id_col, text_col, order_col, shingle, similarity, distance)
    marked = materialize(with_fingerprint(docs, id_col, text_col, shingle))
    classes = materialize(marked.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(classes.select(F.col("fp").alias("node"), "fp"), distance))
    return with_names(marked, named(classes, roots, "fp", F.col("least"))).select(F.col("id").alias(id_col), "fp", "component_id")


def with_names(marked: DataFrame, names: DataFrame) -> DataFrame:
    """The rows and the component_id of their fp, which very many copies may share."""
    often = hot_map(marked.groupBy("fp").count().where(F.col("count") > maps.HOT_ROWS), "fp")
    return joined(marked, names, ["fp"], often, "fp", F.xxhash64("id"))


def digits(fp: str | Column = "fp") -> Column:
    """Sixteen lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
