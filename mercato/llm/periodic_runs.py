"""Periodic run detection: branching-tandem test on an enhanced suffix array.

The words of a text are a sequence of exact numbers. A maximal run [s, e) with
smallest period p ends in a square of period p that can't be rotated further to
the right; its halves start suffixes i = e - 2p and i + p whose longest common
prefix is exactly p, that is, they lie in different children of one LCP interval
of depth p. So, for each LCP interval of depth d and each suffix i of its
children but the largest, ISA[i + d] and ISA[i - d] are looked up: a hit inside
the interval but outside i's own child is a branching square. As the largest
child is skipped, all intervals together look up O(n log n) suffixes. Squares are
then rotated to the left as far as they go, by doubling steps, and those that
become the same stretch are merged into one run with the smallest period
(squares of a multiple of the period give the same stretch).

All texts of a block share the arrays; ranks start from (text, word), so no
common prefix crosses a border. Suffixes are sorted by prefix doubling that
sorts only what is still tied; the ranks of each doubling step are kept and
answer both LCP values and rotations. Intervals come as index ranges of the LCP
array (nearest smaller values by doubling); there are no tree nodes.

Defined cases: null and empty texts have no word, no run and the hash of an
empty string; every row gets a row, repeated and null ids too; words are compared
by their bytes; an empty table gives an empty result. A text is handled whole in
one task, with 4 bytes a word and doubling step for the ranks and 8 for the
minima of the LCP array.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import blocks, map_arrow, text_bytes, word_spans
from mercato.llm.words import encode, span_ids

MIN_LENGTH = 12
#: Bytes of text in one block.
BLOCK = 500_000


def ranks_by_doubling(keys: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks of the prefixes of 1, 2, 4, ... words).

    ``keys`` are non-negative and differ between texts; ``end[i]`` is where the
    text of position i ends. Equal ranks at step k mean equal prefixes of 2^k
    words that lie inside the text; a prefix cut off by the end has a rank of its own.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    new = np.ones(n, bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [rank], 1
    while True:
        # places in the order whose group has more than one member
        last = np.ones(n, bool)
        last[:-1] = new[1:]
        tied = np.flatnonzero(~(new & last))
        if len(tied) == 0:
            return order, levels
        pos = order[tied]
        nxt = pos + step
        inside = nxt < end[pos]
        second = np.where(inside, rank[np.where(inside, nxt, 0)] + 1, 0)
        group = rank[pos].astype(np.int64)
        sort = np.argsort(group * (n + 1) + second, kind="stable")
        pos, group, second = pos[sort], group[sort], second[sort]
        order[tied] = pos
        fresh = np.ones(len(tied), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (second[1:] != second[:-1])
        new[tied] = fresh
        # a member's rank is the place of the first with the same prefix
        rank = rank.copy()
        rank[pos] = np.maximum.accumulate(np.where(fresh, tied, 0))
        levels.append(rank)
        step *= 2


def common_prefix(levels: list[np.ndarray], end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefix of the suffixes at a < n and b < n of one text each."""
    a, b = a.copy(), b.copy()
    out = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ok = (a < end[np.minimum(a, len(end) - 1)]) & (b < len(end))
        ok &= b < end[np.minimum(b, len(end) - 1)]
        at = np.flatnonzero(ok)
        at = at[levels[k][a[at]] == levels[k][b[at]]]
        out[at] += 1 << k
        a[at] += 1 << k
        b[at] += 1 << k
    return out


def nearest_smaller(lcp: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places ``at``: the first place of the stretch around it where lcp stays >= its own value,
    and the place after that stretch. lcp[0] must be 0."""
    tables = [lcp]
    while (1 << len(tables)) <= len(lcp):
        t, half = tables[-1], 1 << (len(tables) - 1)
        tables.append(np.minimum(t[:-half], t[half:]))  # minimum of 2^k values from each place
    value = lcp[at]
    left, right = at.copy(), at + 1
    for k in range(len(tables) - 1, -1, -1):
        size = 1 << k
        go = np.flatnonzero(left >= size)
        go = go[tables[k][left[go] - size] >= value[go]]
        left[go] -= size
        go = np.flatnonzero(right + size <= len(lcp))
        go = go[tables[k][right[go]] >= value[go]]
        right[go] += size
    return left, right


def branching_squares(sa: np.ndarray, lcp: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares whose halves lie in different children of the interval of that depth."""
    none = np.zeros(0, np.int64)
    at = np.flatnonzero(lcp > 0)
    if len(at) == 0:
        return none, none
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    lo, hi = nearest_smaller(lcp, at)  # lcp stays >= depth in [lo, hi); the interval's suffixes are [lo - 1, hi)
    depth = lcp[at]
    sort = np.lexsort((at, depth, lo))
    at, lo, hi, depth = at[sort], lo[sort], hi[sort], depth[sort]
    # a border of depth d splits its interval: children are [lo - 1, b1), [b1, b2), ... [bm, hi)
    opens = np.ones(len(at), bool)
    opens[1:] = (lo[1:] != lo[:-1]) | (depth[1:] != depth[:-1])
    first = np.flatnonzero(opens)
    interval = np.cumsum(opens) - 1
    begin = np.concatenate([lo[first] - 1, at])
    of = np.concatenate([np.arange(len(first)), interval])
    closes = np.ones(len(at), bool)
    closes[:-1] = opens[1:]
    finish = np.concatenate([at[first], np.where(closes, hi, np.append(at[1:], 0))])
    low, high, d = lo[first] - 1, hi[first], depth[first]
    size = finish - begin
    # all children but the largest of each interval
    by = np.lexsort((size, of))
    largest = np.ones(len(by), bool)
    largest[:-1] = of[by][1:] != of[by][:-1]
    small = by[~largest]
    many = size[small]
    child = np.repeat(small, many)
    inner = np.arange(len(child)) - np.repeat(np.cumsum(many) - many, many)
    i = sa[begin[child] + inner]
    lo_, hi_, d_ = low[of[child]], high[of[child]], d[of[child]]
    starts, periods = [], []
    for sign in (1, -1):
        j = i + sign * d_
        ok = np.flatnonzero((j >= 0) & (j < n))
        place = isa[j[ok]]
        hit = (place >= lo_[ok]) & (place < hi_[ok]) & ~((place >= begin[child[ok]]) & (place < finish[child[ok]]))
        ok = ok[hit]
        starts.append(np.minimum(i[ok], j[ok]))
        periods.append(d_[ok])
    found = np.unique(np.stack([np.concatenate(starts), np.concatenate(periods)], 1), axis=0)
    return found[:, 0], found[:, 1]


def rotate_left(levels: list[np.ndarray], begin: np.ndarray, i: np.ndarray, p: np.ndarray) -> np.ndarray:
    """How far the squares at i of period p rotate to the left, not beyond their text's begin."""
    a = i.copy()
    for k in range(len(levels) - 1, -1, -1):
        size = 1 << k
        go = np.flatnonzero(a - size >= begin[i])
        go = go[levels[k][a[go] - size] == levels[k][a[go] - size + p[go]]]
        a[go] -= size
    return i - a


def runs(ids: np.ndarray, first: np.ndarray, least: int = MIN_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of the maximal runs of all texts, by start and period.

    ``ids`` are the word numbers of all texts, ``first`` the index of each
    text's first word. Lengths are at least ``least`` and twice the period.
    """
    none = np.zeros(0, np.int64)
    n = len(ids)
    if n < 2:
        return none, none, none
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    begin, end = first[text], first[text + 1]
    sa, levels = ranks_by_doubling(encode(pa.array(text * (int(ids.max()) + 1) + ids)), end)
    lcp = np.zeros(n, np.int64)
    tied = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    lcp[tied] = common_prefix(levels, end, sa[tied - 1], sa[tied])
    i, p = branching_squares(sa, lcp, n)
    start, stop = i - rotate_left(levels, begin, i, p), i + 2 * p
    long = stop - start >= least
    start, stop, p = start[long], stop[long], p[long]
    by = np.lexsort((p, stop, start))
    start, stop, p = start[by], stop[by], p[by]
    new = np.ones(len(by), bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, p = start[new], stop[new], p[new]
    by = np.lexsort((p, start))
    return start[by], stop[by], p[by]


def tandem_positions(doc_ids, first: np.ndarray) -> np.ndarray:
    """Index of the word that each word becomes: in one of ten texts, by crc32
    of the id, a tail of the text repeats with a period that the id sets."""
    out = np.arange(first[-1])
    for k, d in enumerate(doc_ids):
        n = int(first[k + 1] - first[k])
        if d is None or n == 0:
            continue
        h = zlib.crc32(str(d).encode())
        if h % 10:
            continue
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        out[first[k] + a:first[k + 1]] = first[k] + a + np.arange(n - a) % p
    return out


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the given words, each with a blank behind it."""
    size = ends - starts + 1
    off = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    at = np.repeat(starts - off[:-1], size) + np.arange(off[-1])
    blank = off[1:] - 1
    at[blank] = 0
    out = data[at] if len(data) else np.zeros(0, np.uint8)
    out[blank] = 0x20
    return out, off


def _block(data: np.ndarray, off: np.ndarray, doc_ids, rewrite: bool, least: int):
    """Columns of the texts of one block."""
    starts, ends, first = word_spans(data, off)
    ids = span_ids(data, starts, ends)
    if rewrite:
        at = tandem_positions(doc_ids, first)
        starts, ends, ids = starts[at], ends[at], ids[at]
    s, e, p = runs(ids, first, least)
    text = np.searchsorted(first, s, "right") - 1
    if len(s):  # empty texts share their border with the next one
        text = np.repeat(np.arange(len(first) - 1), np.diff(np.searchsorted(s, first)))
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, s + p, 1)
    np.add.at(edge, e, -1)
    kept = np.cumsum(edge[:-1]) == 0
    out, at = _joined(data, starts[kept], ends[kept])
    many = np.concatenate([[0], np.cumsum(kept)])[first]
    view = memoryview(out)
    bounds = np.searchsorted(text, np.arange(len(first)))
    rows = []
    for k in range(len(first) - 1):
        a, b = bounds[k], bounds[k + 1]
        own = list(zip((s[a:b] - first[k]).tolist(), (e[a:b] - s[a:b]).tolist(), p[a:b].tolist(), strict=True))
        lines = "".join(f"{x},{y},{z}\n" for x, y, z in own)
        best = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None, None, None)
        lo, hi = int(at[many[k]]), int(at[many[k + 1]])
        rows.append((len(own), *best, 1000 * best[1] // best[2] if own else None,
                     hashlib.sha256(lines.encode()).hexdigest(),
                     hashlib.sha256(view[lo:max(lo, hi - 1)]).hexdigest(), int(first[k + 1] - first[k]),
                     int(many[k + 1] - many[k]), own))
    return rows


_NAMES = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_kept",
          "runs"]
_TYPES = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2 + [
    pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))]
_SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
           "collapsed_sha256 string, n_words long, n_kept long, "
           "runs array<struct<start: long, length: long, period: long>>")


def detect(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH,
           rewrite: bool = False) -> DataFrame:
    """One row per row of ``docs``: its runs, the longest one, and the hash of
    the text with every run reduced to its first period.

    ``rewrite`` first makes the tail of one text in ten periodic
    (``tandem_positions``), which shows runs of every size in any table.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(id_col).cast("string").alias("_id"),
                       F.col(text_col).alias("text"))

    def run(batches):
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            ids = batch.column("_id").to_pylist()
            for i, j in blocks(off, BLOCK):
                found = _block(data[off[i]:off[j]], off[i:j + 1] - off[i], ids[i:j], rewrite, least)
                cols = list(zip(*found, strict=True))
                structs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in cols[-1]]
                arrays = [pa.array(c, t) for c, t in zip([*cols[:-1], structs], _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), *arrays], ["doc_id", *_NAMES])

    return rows.transform(map_arrow, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {_SCHEMA}")
