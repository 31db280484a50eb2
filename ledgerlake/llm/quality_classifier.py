"""Operator 9: quality classifier on random Fourier features.

Document statistics (shares of symbols, capitals, repeats and the like; no label,
language, source or id) are standardised and mapped by random Fourier features
that approximate a Gaussian kernel. Each task sums its part of the normal
equations over every labelled training row; the summed equations give ridge
weights. Raw scores of a calibration part (training rows whose crc32 remainder is
4) are summed over a fixed grid and made monotone by isotonic regression; if one of
the two parts lacks a class, both steps use all training rows.

Defined results: null and empty texts have all-zero statistics and are scored as
any other. Labels other than 0 and 1 and null ids are no training rows; a label
row that is repeated counts once. Without training rows every score is 0.5, with
one class only the score is that class. A null doc_id is not held out. Result
columns replace input columns of the same name; other columns pass on untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.llr_quality import SYMBOLS, duplicate_lines, per_text, repeated_words
from ledgerlake.llm.scratch import stored
from ledgerlake.llm.words import Words, _class, slices

FOLDS = 5
CUT = 0.3
FEATURES = 192
RIDGE = 1e-3
GRID = 400  # cells of the raw score between -0.5 and 1.5
_SETS = {
    "symbols": SYMBOLS, "capitals": _class(set(range(0x41, 0x5B))), "digits": _class(set(range(0x30, 0x3A))),
    "shouts": _class({0x21, 0x3F}), "stops": _class({0x2E, 0x2C}), "breaks": _class({0x0A}),
    "foreign": _class(set(range(0xC0, 0x100))), "bars": _class({0x7C}),
}
N_STATS = len(_SETS) + 8


def _statistics(piece: pa.Array) -> np.ndarray:
    w = Words(piece)
    n = np.maximum(w.counts, 1).astype(float)
    size = np.maximum(np.diff(w.bounds), 1).astype(float)
    h, doc = w.hashes(), w.doc
    lens = w.ends - w.starts
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    # distinct words of a text: counted on the sorted (text, word) pairs
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    new = np.ones(len(hs), dtype=bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
    distinct = np.bincount(ds[new], minlength=w.n_docs)
    lines = w.byte_counts(_SETS["breaks"]) + 1
    cols = [w.byte_counts(c) / size for c in _SETS.values()]
    cols += [np.log1p(w.counts) / 10, np.bincount(doc, lens, minlength=w.n_docs) / n / 10, distinct / n,
             per_text(w, again) / n, per_text(w, repeated_words(w)) / n,
             np.array(duplicate_lines(piece.to_pylist())) / lines,
             per_text(w, lens <= 2) / n, per_text(w, lens >= 12) / n]
    out = np.column_stack(cols)
    out[w.counts == 0] = 0.0
    return np.round(out, 6)


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def statistics(text: pa.Array) -> pa.Array:
    rows = [_statistics(piece) for _, piece in slices(text)]
    flat = np.concatenate(rows) if rows else np.zeros((0, N_STATS))
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * N_STATS, pa.int32()),
                                    pa.array(flat.ravel(), pa.float64()))


@dataclass
class Model:
    """Everything that scoring needs; its size does not depend on the data."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return features(x, self.mean, self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.full(len(x), float(self.values[0]))
        return np.round(np.interp(self.raw(x), self.knots, self.values), 6)


def features(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, seed: int = 9) -> np.ndarray:
    """Random Fourier features of a Gaussian kernel, beside the linear terms and a constant."""
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    freq = rng.normal(size=(x.shape[1], FEATURES)) / np.sqrt(x.shape[1])
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    return np.column_stack([np.cos(z @ freq + phase) * np.sqrt(2.0 / FEATURES), z / 8, np.ones(len(x))])


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=float).reshape(len(column), N_STATS)


def fold(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS, F.lit(-1))


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted least-squares non-decreasing fit (pool adjacent violators)."""
    pools: list[list[float]] = []
    for v, w in zip(value, weight, strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, n2 = pools.pop()
            v1, w1, n1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(n, v) for v, _, n in pools]) if pools else np.zeros(0)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on (doc_id, stats): normal equations and calibration are sums over all
    labelled rows outside the held-out fold; only bounded sums reach the driver."""
    y = (labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", F.col("quality").cast("double")
         .alias("y")).distinct().withColumn("fold", fold(F.col("doc_id"))).filter("fold <> 0"))
    train = stored(stats.filter("doc_id IS NOT NULL").select("doc_id", "stats").join(y, "doc_id")
                   .select("stats", "y", "fold"), "labelled")
    sums = train.agg(F.count("*").alias("n"), F.sum("y").alias("y"),
                     *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(N_STATS)],
                     *[F.sum(F.col("stats")[i] * F.col("stats")[i]).alias(f"q{i}") for i in range(N_STATS)]).first()
    if not sums.n or sums.y in (0, sums.n):
        return Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(0), np.zeros(0),
                     np.array([0.5 if not sums.n else float(sums.y > 0)]))
    mean = np.round([sums[f"s{i}"] / sums.n for i in range(N_STATS)], 9)
    var = np.array([sums[f"q{i}"] / sums.n for i in range(N_STATS)]) - mean ** 2
    scale = np.round(np.sqrt(np.maximum(var, 0)), 9)
    scale[scale < 1e-6] = 1.0
    part = train.filter("fold = 4").agg(F.count("*").alias("n"), F.sum("y").alias("y")).first()
    use_cal = 0 < part.n < sums.n and 0 < part.y < part.n and 0 < sums.y - part.y < sums.n - part.n
    fit_rows = train.filter("fold <> 4") if use_cal else train
    width = FEATURES + N_STATS + 1

    def normal_equations(batches):
        a = np.zeros((width, width + 1))
        for b in batches:
            x = features(_matrix(b.column(0)), mean, scale)
            target = np.asarray(b.column(1), dtype=float)
            a[:, :width] += x.T @ x
            a[:, width] += x.T @ target
        yield pa.RecordBatch.from_pydict({"row": pa.array(range(width), pa.int32()),
                                          "part": pa.array([r.tobytes() for r in a])})

    def add(table: pa.Table) -> pa.Table:
        parts = sorted(x.as_py() for x in table.column("part"))  # a fixed order of adding
        return pa.table({"row": table.column("row")[:1],
                         "part": pa.array([sum(np.frombuffer(x) for x in parts).tobytes()])})

    schema = "row int, part binary"
    got = fit_rows.select("stats", "y").mapInArrow(normal_equations, schema).groupBy("row").applyInArrow(add, schema)
    a = np.zeros((width, width + 1))
    for r in got.collect():
        a[r.row] = np.frombuffer(r.part)
    weights = np.linalg.solve(a[:, :width] + RIDGE * sums.n * np.eye(width) / width, a[:, width])
    model = Model(mean, scale, weights, np.zeros(0), np.zeros(0))

    @F.arrow_udf("int")
    def cell(stats: pa.Array) -> pa.Array:
        return pa.array(np.clip((model.raw(_matrix(stats)) + 0.5) / 2 * GRID, 0, GRID - 1).astype(np.int32))

    cal = train.filter("fold = 4") if use_cal else train
    grid = sorted((r.cell, r.n, r.y) for r in cal.groupBy(cell("stats").alias("cell"))
                  .agg(F.count("*").alias("n"), F.sum("y").alias("y")).collect())
    at, n, good = (np.array(v, dtype=float) for v in zip(*grid, strict=True))
    model.knots = (at + 0.5) / GRID * 2 - 0.5
    model.values = np.clip(isotonic(good / n, n), 0, 1)
    return model


def score(rows: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """``rows`` (with doc_id and stats) with held_out, score and predicted instead of stats."""
    @F.arrow_udf("double")
    def scored(stats: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(stats)) if len(stats) else [], pa.float64())

    return (rows.withColumns({"held_out": fold(F.col("doc_id")) == 0, "score": scored("stats")})
            .withColumn("predicted", (F.col("score") >= cut).cast("int")).drop("stats"))


def document_statistics(docs: DataFrame) -> DataFrame:
    return docs.withColumn("stats", statistics(F.col("text")))


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """``docs`` with held_out, score and predicted (1: keep)."""
    model = fit(document_statistics(docs.select("doc_id", "text")), labels)
    return score(document_statistics(docs), model, cut)
