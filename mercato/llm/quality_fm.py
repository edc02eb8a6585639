"""Quality classifier: a factorisation machine over hashed words, structure
statistics and length metadata.

    y = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

The pair term is computed in linear time as half of, per factor, the square of
the sum minus the sum of the squares of v_i x_i. Words fall into
``2^HASH_BITS`` columns (share of the text's words, square-root scaled);
structure statistics are standardised columns of their own, as are one-hot
length classes.

It is fitted on the driver on a bounded sample, ``SAMPLE_ROWS`` labelled rows
taken by hash of their id (the features, not the texts, travel), and scores
every whole text in Arrow batches with the broadcast model, whose size is
fixed. Labels, language, source and id are never inputs.

Defined cases: a null or empty text gets the score of its (all zero) word
columns; rows without label are scored but not learned from; repeated labels
of one id are averaged, of rows of one id the smallest text is learned from; with no usable label, or only one class, the score is
the smoothed share of label 1 (0.5 with none); an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import SPACED, U64, blocks, learnable, map_arrow, text_bytes, word_hashes, word_spans

HASH_BITS = 14
WORD_COLS = 1 << HASH_BITS
FACTORS = 8
#: Labelled rows to fit on, at most.
SAMPLE_ROWS = 6000
N_STATS = 16
N_LENGTHS = 24
N_COLS = WORD_COLS + N_STATS + N_LENGTHS


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_DIGIT = _mask(b"0123456789")
_UPPER = _mask(bytes(range(0x41, 0x5B)))
_LETTER = _UPPER | _mask(bytes(range(0x61, 0x7B))) | _mask(bytes(range(0x80, 0x100)))
_STOP = _mask(b".,;:!?'\"()-")
_LINE = _mask(b"\n")
_ODD = SPACED & ~_LETTER & ~_DIGIT & ~_STOP


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive entries of ``first``."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def features(data: np.ndarray, off: np.ndarray):
    """(row, col, value) of the word columns and the dense (rows, N_STATS)
    statistics and length classes of the texts in one block."""
    n = len(off) - 1
    words, first = word_hashes(data, off)
    starts, ends, _ = word_spans(data, off)
    count = np.diff(first)
    row = np.repeat(np.arange(n), count)
    key = (row.astype(np.int64) << HASH_BITS) | (words >> U64(64 - HASH_BITS)).astype(np.int64)
    key.sort()
    new = np.flatnonzero(np.diff(key, prepend=-1)) if len(key) else np.zeros(0, np.int64)
    tf = np.diff(np.append(new, len(key)))
    key = key[new]
    r, c = key >> HASH_BITS, (key & (WORD_COLS - 1)).astype(np.int32)
    value = np.sqrt(tf / np.maximum(count[r], 1)).astype(np.float32)

    size = np.maximum(np.diff(off), 1)
    many = np.maximum(count, 1)
    share = lambda m: _per_text(m[data], off) / size
    length = (ends - starts).astype(float)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][count > 0]] = False
    distinct = np.bincount(r, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, r, tf)
    mean = _per_text(length, first) / many
    odd_end = _ODD[data[ends - 1]] if len(ends) else np.zeros(0, bool)
    stats = np.stack([
        np.log1p(size), np.log1p(count), mean, _per_text(length ** 2, first) / many - mean ** 2,
        share(_ODD), share(_DIGIT), share(_UPPER), share(_STOP), share(_LINE), 1 - share(SPACED),
        distinct / many, top / many, _per_text(again, first) / many, _per_text(odd_end, first) / many,
        _per_text(length == 1, first) / many, _per_text(length > 20, first) / many,
    ], axis=1)
    bucket = np.minimum((2 * np.log2(np.diff(off) + 1)).astype(int) // 2, N_LENGTHS - 1)
    return r, c, value, stats, bucket


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def score(self, r, c, value, stats, bucket) -> np.ndarray:
        """Probability of label 1 for each text, in time linear in the columns."""
        n = len(bucket)
        z = np.clip((stats - self.mean) / self.scale, -5, 5)
        y, s, q = _linear(self, r, c, value, z, bucket, n)
        return 1 / (1 + np.exp(-np.clip(y + 0.5 * (s * s - q).sum(1), -30, 30)))


def _linear(m: Model, r, c, value, z, bucket, n):
    """First-order part, and sums and sums of squares of v x, of each text."""
    wd, vd = m.w[WORD_COLS:WORD_COLS + N_STATS], m.v[WORD_COLS:WORD_COLS + N_STATS]
    wl, vl = m.w[WORD_COLS + N_STATS:], m.v[WORD_COLS + N_STATS:]
    first = np.searchsorted(r, np.arange(n + 1))
    vx = m.v[c] * value[:, None]
    y = m.w0 + _per_text(m.w[c] * value, first) + z @ wd + wl[bucket]
    s = np.stack([_per_text(vx[:, f], first) for f in range(vx.shape[1])], 1) + z @ vd + vl[bucket]
    q = _per_text((vx * vx).sum(1), first)[:, None] / vx.shape[1] + (z * z) @ (vd * vd) + vl[bucket] ** 2
    return y, s, q


def fit(parts: list[tuple], labels: np.ndarray, *, epochs: int = 12, batch: int = 256, rate: float = 0.02,
        decay: float = 1e-4, seed: int = 7) -> Model:
    """Logistic loss, mini-batches, Adam. ``parts`` are the rows' features."""
    rng = np.random.default_rng(seed)
    stats = np.stack([p[2] for p in parts])
    bucket = np.array([p[3] for p in parts])
    mean, scale = stats.mean(0), np.maximum(stats.std(0), 1e-6)
    z_all = np.clip((stats - mean) / scale, -5, 5)
    p1 = (labels.sum() + 0.5) / (len(labels) + 1)
    m = Model(mean, scale, float(np.log(p1 / (1 - p1))), np.zeros(N_COLS), rng.normal(0, 0.05, (N_COLS, FACTORS)))
    if labels.min() == labels.max():
        m.v[:] = 0
        return m
    par = [m.w, m.v]
    mom = [[np.zeros_like(p), np.zeros_like(p)] for p in par]
    g0 = [0.0, 0.0]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            n = len(rows)
            cnt = np.array([len(parts[j][0]) for j in rows])
            r = np.repeat(np.arange(n), cnt)
            c = np.concatenate([parts[j][0] for j in rows])
            x = np.concatenate([parts[j][1] for j in rows])
            z, b = z_all[rows], bucket[rows]
            y, s, q = _linear(m, r, c, x, z, b, n)
            err = (1 / (1 + np.exp(-np.clip(y + 0.5 * (s * s - q).sum(1), -30, 30))) - labels[rows]) / n
            gw, gv = np.zeros_like(m.w), np.zeros_like(m.v)
            gw[:WORD_COLS] = np.bincount(c, weights=err[r] * x, minlength=WORD_COLS)
            gw[WORD_COLS:WORD_COLS + N_STATS] = z.T @ err
            np.add.at(gw, WORD_COLS + N_STATS + b, err)
            ex, vc = err[r] * x, m.v[c]
            for f in range(FACTORS):
                gv[:WORD_COLS, f] = np.bincount(c, weights=ex * (s[r, f] - vc[:, f] * x), minlength=WORD_COLS)
            es = err[:, None] * s
            gv[WORD_COLS:WORD_COLS + N_STATS] = z.T @ es - (err @ (z * z))[:, None] * m.v[WORD_COLS:WORD_COLS + N_STATS]
            np.add.at(gv, WORD_COLS + N_STATS + b, es - err[:, None] * m.v[WORD_COLS + N_STATS:][b])
            step += 1
            for p, g, (a, h) in zip(par, (gw, gv), mom, strict=True):
                g += decay * p
                a += 0.1 * (g - a)
                h += 0.001 * (g * g - h)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(h / (1 - 0.999 ** step)) + 1e-8)
            g0[0] += 0.1 * (err.sum() - g0[0])
            g0[1] += 0.001 * (err.sum() ** 2 - g0[1])
            m.w0 -= rate * (g0[0] / (1 - 0.9 ** step)) / (np.sqrt(g0[1] / (1 - 0.999 ** step)) + 1e-8)
    return m


def _extract(batches):
    """Arrow batches (label, text) -> one row of features a text."""
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        label = np.array(batch.column("label").to_pylist(), float)
        for i, j in blocks(off):
            r, c, x, stats, bucket = features(data[off[i]:off[j]], off[i:j + 1] - off[i])
            first = np.searchsorted(r, np.arange(j - i + 1))
            yield pa.RecordBatch.from_pydict({
                "label": pa.array(label[i:j]),
                "cols": pa.array([c[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                "vals": pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                "stats": pa.array([s.tobytes() for s in stats], pa.binary()),
                "bucket": pa.array(bucket.astype(np.int32)),
            })


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", folds: int = 3, held: int = 1, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled rows outside the held-out fold."""
    ids = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & learnable(id_col, folds, held))
           .groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(label_col).cast("double")).alias("label"))
           .orderBy(F.md5(F.col("_id").cast("string"))).limit(sample_rows))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
            .join(F.broadcast(ids), "_id")  # sample_rows bounds it
            # one row an id, so that sample_rows bounds the rows too
            .groupBy("_id").agg(F.min("text").alias("text"), F.min("label").alias("label")).select("label", "text")
            .transform(map_arrow, _extract, "label double, cols binary, vals binary, stats binary, bucket int").collect())
    if not rows:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), 0.0, np.zeros(N_COLS), np.zeros((N_COLS, FACTORS)))
    rows.sort(key=lambda r: (bytes(r.stats), bytes(r.cols), bytes(r.vals), r.label))
    parts = [(np.frombuffer(r.cols, np.int32), np.frombuffer(r.vals, np.float32).astype(float),
              np.frombuffer(r.stats), r.bucket) for r in rows]
    return fit(parts, np.array([r.label for r in rows]))


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) for every row, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        m = shared.value
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            out = [m.score(*features(data[off[i]:off[j]], off[i:j + 1] - off[i])) for i, j in blocks(off)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["doc_id", "score"])

    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .transform(map_arrow, run, f"doc_id {id_type}, score double"))


def keep(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least
    ``threshold``: a filter inside each batch, no join."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        m = shared.value
        for batch in batches:
            data, off = text_bytes(batch.column(at))
            out = [m.score(*features(data[off[i]:off[j]], off[i:j + 1] - off[i])) for i, j in blocks(off)]
            yield batch.filter(pa.array((np.concatenate(out) if out else np.zeros(0)) >= threshold))

    return docs.transform(map_arrow, run, docs.schema)
