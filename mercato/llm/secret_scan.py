"""Secret scan: fixed patterns, and a randomness test battery with
false-discovery control.

Patterns (``assign``, ``access``, ``hex``) find secrets of known shape. For the
rest, every maximal run of at least ``MIN_LENGTH`` characters A-Z a-z 0-9 + / _ -
is a test:

* its encoding is inferred, the first of ``ENCODINGS`` that has all its
  characters, and the run becomes a sequence of symbol numbers;
* chi-squared uniformity over the encoding's alphabet, a runs test about the
  middle of the alphabet and a lag-1 serial correlation test give three p-values
  under "uniformly random"; Fisher's method combines them. Below ``GATE`` the
  run isn't random and is let go;
* what is left gets a p-value under "ordinary text", characters drawn with the
  corpus's own frequencies of the encoding's alphabet: one over the likelihood
  ratio of uniform to ordinary, which under ordinary text exceeds 1/p with
  probability at most p, so that evidence grows with the length;
* over all tests of the whole corpus, a weighted Benjamini-Hochberg step (a
  run's weight is its length over the mean length) keeps the false-discovery
  rate at ``FDR``. The step needs only counts of p-values on a fixed grid,
  which Spark sums; p-values are rounded up to the grid, never down.

A run that overlaps a pattern's span is not reported again.

Defined cases: null and empty texts have no span; offsets are code points of
the whole text, end exclusive; rows with a null or repeated id are scanned each;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import blocks, cut, map_arrow, text_bytes

MIN_LENGTH = 16
GATE = 0.01
FDR = 0.001
GRID = 10.0  # steps of the p-value grid in one unit of the natural logarithm

_DIGITS, _LOWER, _UPPER = b"0123456789", bytes(range(0x61, 0x7B)), bytes(range(0x41, 0x5B))
#: Alphabets from narrow to wide; symbols are numbered in this order.
ENCODINGS: list[tuple[str, bytes]] = [
    ("decimal", _DIGITS), ("hex", _DIGITS + b"abcdef"), ("HEX", _DIGITS + b"ABCDEF"), ("base32", _UPPER + b"234567"),
    ("base36", _LOWER + _DIGITS), ("BASE36", _UPPER + _DIGITS), ("base62", _UPPER + _LOWER + _DIGITS),
    ("base64", _UPPER + _LOWER + _DIGITS + b"+/"), ("base64url", _UPPER + _LOWER + _DIGITS + b"-_"),
    ("any", _UPPER + _LOWER + _DIGITS + b"+/-_"),
]

# fixed patterns of the base kinds
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16


def _flags(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_HEX = _flags(_DIGITS + b"abcdef")
_RUN = _flags(ENCODINGS[-1][1])
_SEPARATOR = _flags(b":=")
_INSIDE = np.stack([_flags(a) for _, a in ENCODINGS])
_SYMBOL = np.zeros((len(ENCODINGS), 256), np.int64)
for _e, (_, _a) in enumerate(ENCODINGS):
    _SYMBOL[_e, list(_a)] = np.arange(len(_a))
_SIZE = np.array([len(a) for _, a in ENCODINGS])
_erfc = np.vectorize(math.erfc, otypes=[float])


def _runs(mask: np.ndarray, off: np.ndarray, least: int):
    """(starts, ends) of maximal runs of ``mask`` inside each text."""
    edge = np.zeros(len(mask) + 1, np.int8)
    edge[:-1] = mask
    before = np.concatenate([[False], mask[:-1]])
    inner = off[:-1][off[:-1] < len(mask)]
    before[inner] = False
    starts = np.flatnonzero(mask & ~before)
    after = np.concatenate([mask[1:], [False]])
    last = off[1:][off[1:] > 0] - 1
    after[last] = False
    ends = np.flatnonzero(mask & ~after) + 1
    ok = ends - starts >= least
    return starts[ok], ends[ok]


def patterns(data: np.ndarray, off: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, byte offsets in the block."""
    found = []
    raw = data.tobytes()
    if len(data):
        marks = np.concatenate([[0], np.cumsum(_SEPARATOR[data])])
        for r in np.flatnonzero(marks[off[1:]] > marks[off[:-1]]):  # no match without : or =
            for m in ASSIGN.finditer(raw, int(off[r]), int(off[r + 1])):
                if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                    found.append((m.start(), 0, m.end()))
        at = raw.find(b"AKIA")
        if at >= 0:
            # zero-width: a match over the border of two texts must not eat the start of the second
            for r in np.unique(np.searchsorted(off, [m.start() for m in re.finditer(b"(?=AKIA)", raw)], "right") - 1):
                for m in ACCESS.finditer(raw, int(off[r]), int(off[r + 1])):
                    if m.end() - m.start() >= ACCESS_LEAST:
                        found.append((m.start(), 1, m.end()))
        found.extend((int(a), 2, int(b)) for a, b in zip(*_runs(_HEX[data], off, HEX_LEAST), strict=True))
    return sorted(found)


def battery(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(encoding, combined p-value under randomness) of byte runs."""
    n = ends - starts
    m = len(n)
    run = np.repeat(np.arange(m), n)
    begin = np.cumsum(n) - n
    chars = data[np.arange(n.sum()) - begin[run] + starts[run]]
    encoding = np.full(m, len(ENCODINGS) - 1)
    for e in range(len(ENCODINGS) - 2, -1, -1):
        encoding[np.logical_and.reduceat(_INSIDE[e][chars], begin)] = e
    k = _SIZE[encoding]
    sym = _SYMBOL[encoding[run], chars]

    key = np.sort(run * 128 + sym)
    new = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(np.append(new, len(key)))
    chi2 = np.bincount(key[new] >> 7, weights=times.astype(float) ** 2, minlength=m) * k / n - n
    # matched by a scaled chi-squared of the exact mean and variance; Wilson-Hilferty
    nu = (k - 1) * n / (n - 1)
    z = (np.cbrt(chi2 / (k - 1)) - (1 - 2 / (9 * nu))) / np.sqrt(2 / (9 * nu))
    p1 = _erfc(z / math.sqrt(2)) / 2

    high = sym * 2 >= k[run]
    same = np.ones(len(run), bool)
    same[begin] = False
    turns = np.zeros(len(run))
    turns[1:] = high[1:] != high[:-1]
    turns = np.bincount(run, weights=turns * same, minlength=m)  # fair coins: n - 1 chances of one half
    p2 = _erfc(np.abs(turns - (n - 1) / 2) / np.sqrt((n - 1) / 4) / math.sqrt(2))

    mid = sym - (np.bincount(run, weights=sym, minlength=m) / n)[run]
    prod = np.zeros(len(run))
    prod[1:] = mid[1:] * mid[:-1]
    var = np.bincount(run, weights=mid * mid, minlength=m)
    r = np.bincount(run, weights=prod * same, minlength=m) / np.maximum(var, 1e-12)
    p3 = np.where(var > 0, _erfc(np.abs(r + 1 / n) * np.sqrt(n) / math.sqrt(2)), 0.0)

    half = -(np.log(np.maximum(p1, 1e-300)) + np.log(np.maximum(p2, 1e-300)) + np.log(np.maximum(p3, 1e-300)))
    return encoding, np.exp(-half) * (1 + half + half * half / 2)


def ordinary_p(data: np.ndarray, n: np.ndarray, encoding: np.ndarray, freq: np.ndarray) -> np.ndarray:
    """p-values under ordinary text of runs of n bytes that lie end to end."""
    ratio = np.zeros((len(ENCODINGS), 256))
    for e, (_, a) in enumerate(ENCODINGS):
        q = freq[list(a)] + 1.0
        ratio[e, list(a)] = -np.log(len(a) * q / q.sum())
    run = np.repeat(np.arange(len(n)), n)
    return np.exp(-np.clip(np.bincount(run, weights=ratio[encoding[run], data], minlength=len(n)), 0, 690))


_SCHEMA = ("base_start array<int>, base_kind array<int>, base_end array<int>, run_start array<int>, run_end array<int>, "
           "run_code array<int>, run_text array<string>, tests long, length long, bytes binary")


def _scan(batches):
    """(doc_id, text) -> spans of the patterns, runs that pass the gate, and
    (on the first row of each block) the block's character counts."""
    def lists(first, values, kind):
        return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))

    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        for i, j in blocks(off):
            own, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
            n = j - i
            point = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
            base = patterns(own, at)
            bs, bk, be = (np.array([b[c] for b in base], np.int64) for c in range(3))
            row = np.searchsorted(at, bs, "right") - 1
            starts, ends = _runs(_RUN[own], at, MIN_LENGTH)
            doc = np.searchsorted(at, starts, "right") - 1
            tests = np.bincount(doc, minlength=n)
            length = np.bincount(doc, weights=ends - starts, minlength=n).astype(np.int64)
            if len(starts):
                code, p = battery(own, starts, ends)
                # pattern spans are known secrets: no overlap with them
                covered = np.zeros(len(own) + 1, np.int64)
                np.add.at(covered, bs, 1)
                np.add.at(covered, be, -1)
                inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
                ok = (p >= GATE) & (inside[ends] == inside[starts])
                starts, ends, doc, code = starts[ok], ends[ok], doc[ok], code[ok]
            else:
                code = np.zeros(0, int)
            lead = point[at[:-1]]
            b_first, r_first = np.searchsorted(row, np.arange(n + 1)), np.searchsorted(doc, np.arange(n + 1))
            counts = [None] * n
            counts[0] = np.bincount(own, minlength=256).astype(np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(i, n),
                lists(b_first, point[bs] - lead[row], pa.int32()), lists(b_first, bk, pa.int32()),
                lists(b_first, point[be] - lead[row], pa.int32()),
                lists(r_first, point[starts] - lead[doc], pa.int32()), lists(r_first, point[ends] - lead[doc], pa.int32()),
                lists(r_first, code, pa.int32()), lists(r_first, [own[p:q].tobytes().decode() for p, q in zip(starts, ends, strict=True)], pa.string()),
                pa.array(tests.astype(np.int64)), pa.array(length), pa.array(counts, pa.binary())],
                ["doc_id", *(c.split()[0] for c in _SCHEMA.split(", "))])


def _byte_counts(batches):
    total = np.zeros(256, np.int64)
    for batch in batches:
        for b in batch.column("bytes").to_pylist():
            if b is not None:
                total += np.frombuffer(b, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(256)), pa.array(total)], ["byte", "n"])


def _places(batch: pa.RecordBatch, freq: np.ndarray, mean: float) -> np.ndarray:
    """Grid place of the weighted p-value of every run of a batch."""
    code = batch.column("run_code").flatten().to_numpy(zero_copy_only=False)
    data, off = text_bytes(batch.column("run_text").flatten())
    n = np.diff(off)
    p = ordinary_p(data, n, code, freq) / (n / mean)
    return np.floor(-np.log(np.clip(p, 1e-300, 1.0)) * GRID).astype(np.int64)


def scan(docs: DataFrame, *, fdr: float = FDR, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex,
    n_random, base (the pattern spans) and spans (all), each as
    kind:start:end by start and kind, comma-joined."""
    sc = docs.sparkSession.sparkContext
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
               .transform(map_arrow, _scan, f"doc_id {id_type}, {_SCHEMA}"), "secrets")
    counts = (rows.filter("bytes is not null").select("bytes").transform(map_arrow, _byte_counts, "byte long, n long")
              .groupBy("byte").agg(F.sum("n").alias("n")).collect())  # 256 rows
    freq = np.zeros(256)
    for r in counts:
        freq[r["byte"]] = r["n"]
    tests, length = rows.agg(F.coalesce(F.sum("tests"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    mean = length / tests if tests else 1.0

    def place_counts(batches):
        for batch in batches:
            place, n = np.unique(_places(batch, freq, mean), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(n)], ["place", "n"])

    # at most as many rows as the grid has places
    grid = (rows.select("run_code", "run_text").filter("size(run_code) > 0")
            .transform(map_arrow, place_counts, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("place")).collect())
    cutoff, so_far = math.inf, 0
    for r in grid:
        so_far += r["n"]
        if math.exp(-r["place"] / GRID) <= fdr * so_far / tests:
            cutoff = r["place"]
    shared = sc.broadcast((freq, mean, cutoff))

    def finish(batches):
        f, m, least = shared.value
        for batch in batches:
            place = _places(batch, f, m)
            base = zip(*(batch.column(c).to_pylist() for c in ("base_start", "base_kind", "base_end")), strict=True)
            runs = zip(*(batch.column(c).to_pylist() for c in ("run_start", "run_end")), strict=True)
            out, at = [], 0
            for (bs, bk, be), (rs, re_) in zip(base, runs, strict=True):
                own = sorted(zip(bs, bk, be, strict=True))
                new = [(s, 3, e) for k, (s, e) in enumerate(zip(rs, re_, strict=True)) if place[at + k] >= least]
                at += len(rs)
                text = [",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in x) for x in (own, sorted(own + new))]
                out.append((*(bk.count(k) for k in range(3)), len(new), hashlib.sha256(text[0].encode()).hexdigest(), *text))
            cols = list(zip(*out, strict=True)) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "base", "spans"])

    return rows.drop("bytes", "tests", "length").transform(
        map_arrow, finish, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, n_random long, "
                           "base_sha256 string, base string, spans string")
