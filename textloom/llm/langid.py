"""Language identification by nearest centroid.

A text is the normalised TF-IDF vector of its hashed character n-grams (one to three characters of
lower-cased letters, words set off by blanks). Vectors of labelled texts of a language are clustered
into several centroids on the unit sphere; a text takes the language of the centroid of the largest
cosine. It is rejected if it has no letter, or lies further from all centroids than learned bounds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import pieces, small_batches, text_or_empty

DIMENSIONS = 1 << 13
CENTROIDS = 4
#: The classifier is fitted on about so many labelled rows, equal shares for all languages, drawn by a hash of the id.
SAMPLE_ROWS = 3000
#: Bounds of rejection: a text's cosine may fall short of the least training cosine at its length by this factor.
SLACK = 0.4
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # odd, from the golden ratio and public hash functions
_LENGTHS = [4, 16, 64, 256, 1024]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray | None:
    """Counts of hashed n-grams, or None if the text has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[points]
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank after each run of letters
    points = np.where(letter, points, 32)[keep]
    c = np.empty(len(points) + 2, np.uint32)
    c[0] = c[-1] = 32
    c[1:-1] = points
    shift = np.uint32(32 - DIMENSIONS.bit_length() + 1)
    one = c * _MULTIPLIERS[0]
    two = (one[:-1] ^ np.uint32(0x27D4EB2F)) * _MULTIPLIERS[1] + c[1:]
    three = two[:-1] * _MULTIPLIERS[2] + c[2:]
    counts = np.bincount(one >> shift, minlength=DIMENSIONS)
    for h in (two, three):
        counts += np.bincount((h * _MULTIPLIERS[0]) >> shift, minlength=DIMENSIONS)
    return counts


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of normalised TF-IDF."""
    v = np.sqrt(counts, dtype=np.float32) * idf
    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k centroids of unit length, from starts that lie far from one another."""
    mean = x.mean(axis=0)
    starts = [int(np.argmax(x @ mean))]
    near = x @ x[starts[0]]
    while len(starts) < min(k, len(x)):
        starts.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[starts[-1]])
    c = x[starts].copy()
    for _ in range(rounds):
        of = np.argmax(x @ c.T, axis=1)
        for j in range(len(c)):
            if (of == j).any():
                c[j] = x[of == j].mean(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    languages: list[str]
    of: np.ndarray
    bounds: np.ndarray

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected) of each text."""
        counted = [grams(t) for t in texts]
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        some = [k for k, g in enumerate(counted) if g is not None]
        for at in range(0, len(some), 128):
            part = some[at : at + 128]
            counts = np.stack([counted[k] for k in part])
            near = weigh(counts, self.idf) @ self.centroids.T
            best = np.argmax(near, axis=1)
            for k, b, score, n in zip(part, best, near[np.arange(len(part)), best], counts.sum(axis=1)):
                out[k] = (self.languages[self.of[b]], float(min(1.0, max(0.0, score))), bool(score < self.bounds[np.searchsorted(_LENGTHS, n, "right")]))
        return out


def train(rows: list[tuple[str, np.ndarray]], centroids: int = CENTROIDS) -> Model:
    """From (language, counts): document frequencies, centroids, and for each length the least cosine that is accepted."""
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return Model(np.ones(DIMENSIONS, np.float32), np.zeros((1, DIMENSIONS), np.float32), [UNKNOWN], np.zeros(1, int), np.full(len(_LENGTHS) + 1, np.inf))
    seen = np.zeros(DIMENSIONS)
    for _, g in rows:
        seen += g > 0
    idf = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 1
    made, of = [], []
    vectors = np.stack([weigh(g, idf) for _, g in rows])
    label = np.array([languages.index(lang) for lang, _ in rows])
    for k in range(len(languages)):
        c = cluster(vectors[label == k], centroids)
        made.append(c)
        of += [k] * len(c)
    made = np.concatenate(made)
    near = (vectors @ made.T).max(axis=1)
    sizes = np.searchsorted(_LENGTHS, [g.sum() for _, g in rows], "right")
    bounds, least = np.zeros(len(_LENGTHS) + 1), np.inf
    for b in range(len(bounds) - 1, -1, -1):  # longer texts are bounded from below at least as much as shorter ones
        if (sizes == b).any():
            least = min(least, float(np.quantile(near[sizes == b], 0.01)))
        bounds[b] = SLACK * least if np.isfinite(least) else 0.0
    bounds[0] = min(bounds[0], 0.02)
    return Model(idf, made, languages, np.array(of), bounds)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``sample_rows`` of these rows; rows without a label or letters are not learned from.

    Rows are drawn by a hash of id and text, so null and repeated ids are drawn like others, and copies of
    one row together: one of them is kept. No rows: nothing is recognised.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # one row per language
    drawn = F.lit(False)
    for lang, n in counts.items():
        drawn = drawn | ((F.col("lang") == lang) & (F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)) < int((1 << 20) * sample_rows / len(counts) / n) + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [(lang, g) for lang, g in zip(batch.column(0).to_pylist(), map(grams, batch.column(1).to_pylist())) if g is not None]
            at = [np.flatnonzero(g) for _, g in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang for lang, _ in found], pa.string()), pa.array([a.astype("<u2").tobytes() for a in at], pa.binary()), pa.array([g[a].astype("<u4").tobytes() for a, (_, g) in zip(at, found)], pa.binary())],
                ["lang", "at", "n"],
            )

    got = []
    for r in sorted(rows.where(drawn).dropDuplicates(["lang", "text"]).select("lang", "text").mapInArrow(run, "lang string, at binary, n binary").collect(), key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["n"]))):
        g = np.zeros(DIMENSIONS, np.float32)
        g[np.frombuffer(r["at"], "<u2")] = np.frombuffer(r["n"], "<u4")
        got.append((r["lang"], g))
    return train(got)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns and _lang (und if there is no letter), _score (cosine, 0 to 1), _rejected.

    A null text is empty. Of languages that are equally near the first by name is taken. Rows are kept as
    they are, repeated ones too; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # bounded: dimensions x languages x centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            *rest, text = batch.columns
            lang, score, rejected = zip(*held.value.predict(text.to_pylist())) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*rest, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], [*names, "lang", "score", "rejected"])

    # Columns travel under names of their own, so that none clashes.
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names)
    text = F.coalesce(rows[names[docs.columns.index(text_col)]], F.lit(""))
    schema = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, docs.schema))
    found = rows.select(*names, text.alias("_t")).mapInArrow(run, f"{schema}, lang string, score double, rejected boolean")
    return found.toDF(*docs.columns, "_lang", "_score", "_rejected")


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of all rows, chosen by their ids."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2
