"""Removal of repeated passages by bounded interval expansion on a
Burrows-Wheeler transform.

A byte of a document goes if a string of ``LENGTH`` bytes that covers it also
starts in a document with a smaller id (judged on the input). All such strings
are found exactly, without sorting the suffixes of the whole corpus at once:

1. Copies: of documents with identical bytes only the smallest id is looked at
   further; the others are removed whole (if they have ``LENGTH`` bytes).
2. Routing: every window of ``LENGTH`` bytes has a minimizer, the ``KMER``-byte
   string in it with the smallest hash. Equal windows have equal minimizers, so
   dealing windows by minimizer brings equal windows together. Runs of windows
   with one minimizer travel as one string, and only if the minimizer occurs
   in two different texts (checked on 32-bit hashes inside each bucket; a false
   alarm costs time only).
3. In each bucket the different strings are concatenated, sorted by suffix and
   transformed (BWT). Intervals of suffixes with a common prefix are extended
   backward, one byte at a time, breadth first: at value l, neighbouring
   suffixes of an interval stay together if the suffixes that follow their
   first byte were together at value l - 1. Suffixes alone in their interval
   leave; the expansion stops at ``LENGTH``. What is left are the groups of
   equal windows; the smallest id in a group decides.
4. A minimizer with more than ``HOT_RUNS`` runs (a common phrase of some 25 to
   49 bytes between different texts gives a different string a document) would
   be one group as large as the phrase is common. Its windows are dealt one by
   one, by a 128-bit hash of all their bytes, and the smallest id of equal
   hashes decides. Which minimizers are hot is counted over the whole corpus
   and kept in a Bloom filter; one that passes it by chance is only dealt the
   dearer way, the same in every text.
5. Removed ranges go back to their documents and are merged.

Hot passages are collapsed before every shuffle: a block of texts reports one
occurrence of a minimizer, and one occurrence of a string (its smallest id;
occurrences with a larger id are removed on the spot), so that a passage in a
third of all documents is one entry a block; so does a window of a hot
minimizer. Inside a bucket, strings are worked on ``CHUNK`` bytes at a time,
cut between minimizers, none of which has more strings than a chunk.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` lose
nothing; a null id counts as larger than every other; rows with the same id
don't remove each other's bytes; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import U64, blocks, bloom, bloom_hits, cut, map_arrow, mix, powers, ship, span_hashes, text_bytes

LENGTH = 50
KMER = 20
BUCKET_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
CHUNK = 900_000
#: Runs of a minimizer (of 2 * LENGTH - KMER bytes at most) that surely fit a chunk.
HOT_RUNS = CHUNK // (2 * LENGTH - KMER)
#: Bytes of a window dealt on its own: two hashes, ord, text id, start.
WINDOW_BYTES = 40
_LIVE = np.uint32(0xFFFFFFFF)
_OTHER = np.random.default_rng(50).permutation(256).astype(np.uint8)


# ------------------------------------------------------------------ minimizers
def window_runs(data: np.ndarray, off: np.ndarray, length: int = LENGTH, kmer: int = KMER):
    """Runs of windows with one minimizer: (text, first window, last window,
    64-bit hash of the minimizer), positions in the block."""
    n = len(data)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, U64)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    h = mix((sums[kmer:] - sums[:-kmer]) * down[:n + 1 - kmer])
    # the 32 high bits decide, then the leftmost place: the same in every text
    least = (h & U64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=U64)
    wide, span = 1, length - kmer + 1
    while wide < span:
        step = min(wide, span - wide)
        least = np.minimum(least[:len(least) - step], least[step:])
        wide += step
    place = (least & U64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))[:len(place)]
    ok = np.arange(len(place)) + length <= off[text + 1]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new & ok)
    # a run ends before the next begins, or where windows stop fitting the text
    last = np.minimum(np.append(first[1:], len(place)) - 1, off[text[first] + 1] - length)
    return text[first], first, last, mix(h[place[first]] ^ U64(0x2545F4914F6CDD1D))


def _pack(values: np.ndarray) -> bytes:
    """Bytes of a column for a shuffle: length, then compressed."""
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(value, kind) -> np.ndarray:
    raw = value.as_buffer()
    size = int.from_bytes(raw[:8].to_pybytes(), "little")
    return np.frombuffer(pa.decompress(raw[8:], size, codec="zstd"), kind)


def _column(t: pa.Table, name: str, kind) -> np.ndarray:
    """A column's packed values of all rows, end to end."""
    parts = [_unpack(v, kind) for v in t.column(name) if v.is_valid and len(v.as_buffer())]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def argsort(key: np.ndarray, bits: int) -> np.ndarray:
    """Stable argsort of keys below 2^bits: by sorting key and place as one
    64-bit number where they fit."""
    place = max(1, (len(key) - 1).bit_length())
    if bits + place > 64:
        return np.argsort(key, kind="stable")
    both = (key.astype(U64) << U64(place)) | np.arange(len(key), dtype=U64)
    both.sort()
    return (both & U64((1 << place) - 1)).astype(np.int64)


def _groups(values: np.ndarray):
    """(starts, ends) of the runs of equal values."""
    if len(values) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    return at, np.append(at[1:], len(values))


def _key(h: np.ndarray, buckets: int):
    """(bucket, 32-bit hash in the bucket, both as one number)."""
    b = (h >> U64(32)) % U64(buckets)
    low = h & U64(0xFFFFFFFF)
    return b.astype(np.int64), low.astype(np.uint32), (b << U64(32)) | low


def _deal(kind: int, bucket: np.ndarray, columns: list[np.ndarray], extra: bytes = b""):
    """One row for each bucket with the bytes of its part of every column."""
    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    at, end = _groups(own)
    columns = [c[order] for c in columns]
    rows = [(kind, int(own[p]), *(_pack(c[p:q]) for c in columns), extra) for p, q in zip(at, end, strict=True)]
    return rows


def _batch(rows: list[tuple], width: int) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * (2 + width)
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[2:])],
        ["kind", "key", *(f"c{k}" for k in range(width))])


_SHAPE = "kind int, key long, c0 binary, c1 binary, c2 binary"
_FOUND = _SHAPE + ", c3 binary"


def _minimizers(buckets: int):
    """(tid, text) -> minimizers to be checked (kind 0: hash, text number, runs,
    and the block's text ids) and those seen in two texts already (kind 1: text id, key)."""
    def flush(held):
        tids = np.concatenate([h[0] for h in held])
        lead = np.concatenate([[0], np.cumsum([len(h[0]) for h in held])])
        text = np.concatenate([h[1] + lead[k] for k, h in enumerate(held)])
        key = np.concatenate([h[2] for h in held])
        order = np.argsort(key)
        key, tid = key[order], tids[text[order]]
        text = text[order]
        at, end = _groups(key)
        if len(at) == 0:
            return []
        live = np.minimum.reduceat(tid, at) != np.maximum.reduceat(tid, at)
        first = np.where(live, _LIVE, text[at].astype(np.uint32)).astype(np.uint32)
        # ascending hashes of a bucket travel as steps
        bucket = (key[at] >> U64(32)).astype(np.int64)
        low = (key[at] & U64(0xFFFFFFFF)).astype(np.uint32)
        step = np.diff(low, prepend=np.uint32(0))
        head = _groups(bucket)[0]
        step[head] = low[head]
        rows = _deal(0, bucket, [step, first, (end - at).astype(np.uint32)], _pack(tids))
        own = np.repeat(live, end - at)
        pair = np.unique(np.stack([tid[own], key[own]], 1), axis=0) if own.any() else np.zeros((0, 2), U64)
        pairs = _deal(1, (pair[:, 0] % U64(buckets)).astype(np.int64), [pair[:, 0].copy(), pair[:, 1].copy()])
        return rows + [(*r, b"") for r in pairs]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            tid = batch.column("tid").to_numpy().view(U64)
            for i, j in blocks(off):
                text, _, _, h = window_runs(data[off[i]:off[j]], off[i:j + 1] - off[i])
                held.append((tid[i:j], text, _key(h, buckets)[2]))
                size += off[j] - off[i]
                if size >= BLOCK_BYTES:
                    yield _batch(flush(held), 4)
                    held, size = [], 0
        if held:
            yield _batch(flush(held), 4)

    return run


def _live(buckets: int, hot_runs: int):
    """One bucket of minimizers -> (text id, key) of those in two texts, and
    (kind 2: key, runs) of the hot ones."""
    def run(t: pa.Table) -> pa.Table:
        if t.column("kind")[0].as_py() == 1:
            return t
        bucket = t.column("key")[0].as_py()
        low, tid, known, runs = [], [], [], []
        for r in range(t.num_rows):
            row, ids = _unpack(t.column("c1")[r], np.uint32), _unpack(t.column("c3")[r], U64)
            runs.append(_unpack(t.column("c2")[r], np.uint32))
            low.append(np.cumsum(_unpack(t.column("c0")[r], np.uint32), dtype=np.uint32))
            known.append(row == _LIVE)
            tid.append(ids[np.where(known[-1], 0, row)])
        low, tid, known, runs = (np.concatenate(x) for x in (low, tid, known, runs))
        order = np.argsort(low)
        low, tid, known, runs = low[order], tid[order], known[order], runs[order].astype(np.int64)
        at, end = _groups(low)
        live = np.logical_or.reduceat(known, at) | (np.minimum.reduceat(tid, at) != np.maximum.reduceat(tid, at))
        ok = np.repeat(live, end - at) & ~known
        keys = (U64(bucket) << U64(32)) | low.astype(U64)
        rows = _deal(1, (tid[ok] % U64(buckets)).astype(np.int64), [tid[ok], keys[ok]])
        total = np.add.reduceat(runs, at)
        hot = live & (total > hot_runs)
        if hot.any():
            rows += _deal(2, np.full(int(hot.sum()), bucket), [keys[at[hot]], total[hot]])
        return pa.Table.from_batches([_batch([(*r, b"") for r in rows], 4)])

    return run


def _by_text(t: pa.Table) -> pa.Table:
    """(text id, key) pairs of one bucket of text ids -> keys of each text; the
    hot keys and their number of runs are a row without text id."""
    hot = t.filter(pc.equal(t.column("kind"), 2))
    t = t.filter(pc.equal(t.column("kind"), 1))
    tid, key = _column(t, "c0", U64), _column(t, "c1", U64)
    order = np.argsort(tid, kind="stable")
    tid, key = tid[order], key[order]
    at, end = _groups(tid)
    out, own = [np.unique(key[p:q]).tobytes() for p, q in zip(at, end, strict=True)], [*tid[at].view(np.int64)]
    runs = [None] * len(out)
    if hot.num_rows:
        out.append(_column(hot, "c0", U64).tobytes())
        own.append(None)
        runs.append(int(_column(hot, "c1", np.int64).sum()))
    return pa.table({"tid": pa.array(own, pa.int64()), "live": pa.array(out, pa.binary()), "runs": pa.array(runs, pa.int64())})


# --------------------------------------------------------------------- strings
def _copy_spans(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    lead = np.cumsum(size) - size
    return data[np.repeat(start - lead, size) + np.arange(size.sum())]


def _meta(ord_, tid, start, size, low) -> np.ndarray:
    out = np.zeros((len(ord_), 5), np.int64)
    for k, c in enumerate((ord_, tid.view(np.int64), start, size, low)):
        out[:, k] = c
    return out


def _ranges(kind: int, buckets: int, tid: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Removed ranges, dealt by text id."""
    return _deal(kind, (tid % U64(buckets)).astype(np.int64),
                 [tid, np.stack([start, end], 1).astype(np.uint32) if len(tid) else np.zeros((0, 2), np.uint32)])


def _joined(buckets: int, tid: np.ndarray, start: np.ndarray, length: int = LENGTH):
    """Windows that are removed, as ranges: neighbours of a text are one."""
    if len(tid) == 0:
        return []
    order = np.lexsort((start, tid))
    tid, start = tid[order], start[order]
    new = np.ones(len(tid), bool)
    new[1:] = (tid[1:] != tid[:-1]) | (start[1:] > start[:-1] + length)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(tid)) - 1
    return [(r + (b"",))[:5] for r in _ranges(1, buckets, tid[at], start[at], start[last] + length)]


def _least(windows: np.ndarray):
    """(hash, hash, ord, tid, start) of windows -> whether each is in the
    smallest document of its equal ones."""
    order = np.lexsort((windows[2], windows[1], windows[0]))
    a, b, own = windows[:3, order]
    new = np.ones(len(own), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.flatnonzero(new)
    first = np.empty(len(own), bool)
    first[order] = own == np.repeat(own[at], np.diff(np.append(at, len(own))))
    return first


def _lone(buckets: int, spread: int, windows: np.ndarray):
    """Windows of hot minimizers of one block: (kind 2) those of the smallest
    document, dealt by hash; the others are removed."""
    first = _least(windows)
    gone = windows[:, ~first]
    windows = windows[:, first]
    bucket = (windows[0].view(U64) % U64(spread)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rows = [(2, int(bucket[order[p]]), _pack(np.ascontiguousarray(windows[:, order[p:q]])), b"", b"")
            for p, q in zip(*_groups(bucket[order]), strict=True)]
    return rows + _joined(buckets, gone[3].view(U64), gone[4])


def _strings(buckets: int, shared, spread: int):
    """(ord, tid, text, live) -> strings to compare (kind 0: five numbers each,
    bytes), windows of hot minimizers (kind 2) and ranges that are removed for
    sure (kind 1)."""
    def flush(held):
        windows = np.concatenate([h[4] for h in held], 1)
        return strings(held) + (_lone(buckets, spread, windows) if windows.shape[1] else [])

    def strings(held):
        meta = np.concatenate([h[0] for h in held])
        data = np.concatenate([h[1] for h in held])
        bucket = np.concatenate([h[2] for h in held])
        if len(meta) == 0:
            return []
        off = np.concatenate([[0], np.cumsum(meta[:, 3])])
        h = np.concatenate([h[3] for h in held])
        order = np.lexsort((meta[:, 0], h))
        h, own = h[order], meta[order, 0]
        at, end = _groups(h)
        first = np.repeat(own[at], end - at) == own
        gone, stay = order[~first], np.sort(order[first])
        rows = _ranges(1, buckets, meta[gone, 1].view(U64), meta[gone, 2], meta[gone, 2] + meta[gone, 3])
        stay = stay[np.argsort(bucket[stay], kind="stable")]
        b = bucket[stay]
        for p, q in zip(*_groups(b), strict=True):
            some = stay[p:q]
            rows.append((0, int(b[p]), _pack(np.ascontiguousarray(meta[some].T)),
                         _pack(_copy_spans(data, off[some], meta[some, 3])), b""))
        return [(r + (b"",))[:5] for r in rows]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            tid, ord_ = batch.column("tid").to_numpy().view(U64), batch.column("ord").to_numpy()
            for i, j in blocks(off):
                own = data[off[i]:off[j]]
                text, first, last, h = window_runs(own, off[i:j + 1] - off[i])
                bucket, low, key = _key(h, buckets)
                live = [np.frombuffer(batch.column("live")[r].as_buffer(), U64) for r in range(i, j)]
                salt = mix(np.arange(j - i, dtype=U64) + U64(77))
                known = mix(np.concatenate(live) ^ np.repeat(salt, [len(x) for x in live]))
                ok = np.isin(mix(key ^ salt[text]), known)
                text, first, last, bucket, low, key = text[ok], first[ok], last[ok], bucket[ok], low[ok], key[ok]
                hot = bloom_hits(shared.value, mix(key))
                lead = off[i:j] - off[i]
                windows = np.zeros((5, 0), np.int64)
                if len(hot):
                    n = last[hot] - first[hot] + 1
                    at = np.repeat(first[hot] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    of = np.repeat(text[hot], n)
                    windows = np.stack([span_hashes(own, at, at + LENGTH).view(np.int64),
                                        span_hashes(_OTHER[own], at, at + LENGTH).view(np.int64),
                                        ord_[i + of], tid[i + of].view(np.int64), at - lead[of]])
                    text, first, last, bucket, low = (np.delete(x, hot) for x in (text, first, last, bucket, low))
                n = last - first + LENGTH
                held.append((_meta(ord_[i + text], tid[i + text], first - lead[text], n, low),
                             _copy_spans(own, first, n), bucket, span_hashes(own, first, first + n), windows))
                size += int(n.sum()) + windows.shape[1] * WINDOW_BYTES
                if size >= BLOCK_BYTES // 2:
                    yield _batch(flush(held), 3)
                    held, size = [], 0
        if held:
            yield _batch(flush(held), 3)

    return run


# ---------------------------------------------------------------- the transform
def suffix_order(sym: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least, or up to their
    string's end (symbol 0; ends are ordered by place), by prefix doubling."""
    n = len(sym)
    # symbols numbered densely: as many in the first key as fit beside a place
    seen = np.flatnonzero(np.bincount(sym, minlength=1))
    dense = np.zeros(int(seen[-1]) + 1, U64)
    dense[seen] = np.arange(len(seen))
    bits = max(1, (len(seen) - 1).bit_length())
    lead = max(1, min(14, (64 - max(1, n.bit_length())) // bits))
    padded = np.concatenate([dense[sym], np.zeros(lead, U64)])
    key = np.zeros(n, U64)
    for k in range(lead):
        key = (key << U64(bits)) | padded[k:n + k]
    left = end - np.arange(n)
    closed = left < lead
    spare = (bits * (lead - 1 - left[closed])).astype(U64)
    key[closed] = (key[closed] >> spare) << spare
    order = argsort(key, bits * lead)
    ranked = key[order]
    new = np.ones(n, bool)
    new[1:] = (ranked[1:] != ranked[:-1]) | closed[order][1:]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    at = np.flatnonzero(~(new & np.append(new[1:], True)))
    h, wide = lead, n.bit_length()
    while h < depth and len(at):
        p = order[at]
        pair = (rank[p] << wide) | rank[p + h]
        by = argsort(pair, 2 * wide)
        p, pair = p[by], pair[by]
        order[at] = p
        new = np.ones(len(at), bool)
        new[1:] = pair[1:] != pair[:-1]
        # read all old ranks above, then write the new ones
        rank[p] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        at = at[~(new & np.append(new[1:], True))]
        h *= 2
    return order


def equal_windows(data: np.ndarray, size: np.ndarray, length: int = LENGTH):
    """Groups of equal ``length``-byte strings in the concatenated strings:
    (string, offset, group) of every window that has an equal one."""
    m = len(size)
    stop = np.cumsum(size) + np.arange(m)
    sym = np.zeros(len(data) + m, np.uint16)
    inside = np.ones(len(sym), bool)
    inside[stop] = False
    sym[inside] = data.astype(np.uint16) + 1
    string = np.repeat(np.arange(m, dtype=np.int32), size + 1)
    order = suffix_order(sym, stop[string], length)
    transform = sym[order - 1]
    follow = np.argsort(transform, kind="stable").astype(np.int32)  # row of the suffix one byte later
    first = sym[order]
    # value 1: intervals of equal first bytes; every end is alone
    new = np.ones(len(sym), bool)
    new[1:] = (first[1:] != first[:-1]) | (first[1:] == 0)
    group = np.maximum.accumulate(np.where(new, np.arange(len(sym), dtype=np.int32), 0))
    rows = np.flatnonzero(~(new & np.append(new[1:], True))).astype(np.int32)
    for _ in range(length - 1):
        if len(rows) == 0:
            break
        then, own = group[follow[rows]], group[rows]
        new = np.ones(len(rows), bool)
        new[1:] = (own[1:] != own[:-1]) | (then[1:] != then[:-1])
        group[rows] = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        rows = rows[~(new & np.append(new[1:], True))]
    place = order[rows]
    own = string[place]
    return own, place - (stop[own] - size[own]), group[rows]


def _compare(buckets: int):
    """One bucket of strings or windows -> ranges that are removed."""
    def run(t: pa.Table) -> pa.Table:
        kind = t.column("kind")[0].as_py()
        if kind == 1:
            return t
        if kind == 2:
            windows = np.concatenate([_unpack(v, np.int64).reshape(5, -1) for v in t.column("c0")], 1)
            gone = windows[:, ~_least(windows)]
            return pa.Table.from_batches([_batch(_joined(buckets, gone[3].view(U64), gone[4]), 3)])
        meta = np.concatenate([_unpack(v, np.int64).reshape(5, -1).T for v in t.column("c0")])
        data = _column(t, "c1", np.uint8)
        off = np.concatenate([[0], np.cumsum(meta[:, 3])])
        h = np.concatenate([span_hashes(data[off[i]:off[j]], off[i:j] - off[i], off[i + 1:j + 1] - off[i])
                            for i, j in blocks(off)])
        order = np.lexsort((meta[:, 0], h))
        at, end = _groups(h[order])
        own = np.repeat(np.arange(len(at)), end - at)
        least = meta[order[at], 0]
        first = meta[order, 0] == least[own]
        gone = order[~first]
        out = [(meta[gone, 1], meta[gone, 2], meta[gone, 2] + meta[gone, 3])]

        # the different strings, in chunks that keep a minimizer together
        some = order[at]
        by = np.argsort(meta[some, 4], kind="stable")
        low = meta[some[by], 4]
        edge = np.append(_groups(low)[0], len(by))
        size = np.concatenate([[0], np.cumsum(meta[some[by], 3])])[edge]
        for i, j in blocks(size, CHUNK):
            ids = by[edge[i]:edge[j]]
            part = some[ids]
            s, place, group = equal_windows(_copy_spans(data, off[part], meta[part, 3]), meta[part, 3])
            if len(s) == 0:
                continue
            mine = least[ids[s]]
            head, tail = _groups(group)
            lowest = np.repeat(np.minimum.reduceat(mine, head), tail - head)
            hit = np.flatnonzero(lowest < mine)
            hit = hit[np.lexsort((place[hit], s[hit]))]
            s, place = ids[s[hit]], place[hit]
            begin = np.ones(len(s), bool)
            begin[1:] = (s[1:] != s[:-1]) | (place[1:] != place[:-1] + 1)
            b = np.flatnonzero(begin)
            e = np.append(b[1:], len(s)) - 1
            # every occurrence of the string in its smallest document
            runs = np.full(len(least), 0)
            np.add.at(runs, s[b], 1)
            lead = np.cumsum(runs) - runs
            sorted_b = np.argsort(s[b], kind="stable")
            p0, p1 = place[b][sorted_b], place[e][sorted_b] + LENGTH
            rows = np.flatnonzero(first & (runs[own] > 0))
            times = runs[own[rows]]
            k = np.repeat(lead[own[rows]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            src = np.repeat(order[rows], times)
            out.append((meta[src, 1], meta[src, 2] + p0[k], meta[src, 2] + p1[k]))
        tid, a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.Table.from_batches([_batch([(r + (b"",))[:5] for r in _ranges(1, buckets, tid.view(U64), a, b)], 3)])

    return run


def merge(start: np.ndarray, end: np.ndarray):
    """Maximal runs of ranges sorted by start (touching ranges join)."""
    far = np.maximum.accumulate(end)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > far[:-1]
    at = np.flatnonzero(new)
    return start[at], far[np.append(at[1:], len(start)) - 1]


def _merged(t: pa.Table) -> pa.Table:
    """Ranges of one bucket of text ids -> the removed runs of each text."""
    tid, r = _column(t, "c0", U64), _column(t, "c1", np.uint32).reshape(-1, 2).astype(np.int64)
    order = np.lexsort((r[:, 0], tid))
    tid, r = tid[order], r[order]
    at, end = _groups(tid)
    spans = [np.stack(merge(r[p:q, 0], r[p:q, 1]), 1).tobytes() for p, q in zip(at, end, strict=True)]
    return pa.table({"tid": pa.array(tid[at].view(np.int64)), "spans": pa.array(spans, pa.binary())})


def _apply(batches):
    """(ord, tid, text, spans) -> what is left of each text."""
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        removed, count, kept = [], [], []
        for r, raw in enumerate(batch.column("spans").to_pylist()):
            spans = np.frombuffer(raw, np.int64).reshape(-1, 2)
            own = data[off[r]:off[r + 1]].tobytes()
            h, at = hashlib.sha256(), 0
            for a, b in spans:
                h.update(own[at:a])
                at = b
            h.update(own[at:])
            removed.append(int((spans[:, 1] - spans[:, 0]).sum()))
            count.append(len(spans))
            kept.append(h.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("ord"), batch.column("tid"), batch.column("spans"), pa.array(removed, pa.int64()),
             pa.array(count, pa.int64()), pa.array(kept, pa.string())],
            ["ord", "tid", "spans", "n_removed", "n_spans", "kept_sha256"])


def _passes(shared):
    """Rows whose text id may be wanted."""
    def run(batches):
        bits = shared.value
        for batch in batches:
            at = bloom_hits(bits, mix(batch.column("tid").to_numpy().view(U64)))
            yield batch.take(pa.array(at))

    return run


def _mixed(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(mix(batch.column("tid").to_numpy().view(U64)).view(np.int64))], ["key"])


def _hot_keys(batches):
    for batch in batches:
        for v in batch.column("live"):
            key = np.frombuffer(v.as_buffer(), U64)
            yield pa.RecordBatch.from_arrays([pa.array(mix(key).view(np.int64))], ["key"])


def dealt(texts: DataFrame, first: DataFrame, buckets: int) -> DataFrame:
    """(ord, tid, text) -> the strings, windows and ranges, one group of
    (kind, key) a bucket."""
    spark = texts.sparkSession
    found = (texts.filter(F.octet_length("text") >= LENGTH).select("tid", "text")
             .transform(map_arrow, _minimizers(buckets), _FOUND)
             .groupBy("kind", "key").applyInArrow(_live(buckets, HOT_RUNS), _FOUND))
    live = found.groupBy("key").applyInArrow(_by_text, "tid long, live binary, runs long")
    live = cut(live.join(first.select("tid", F.col("first").alias("ord")), "tid", "left"), "live")
    hot = live.filter("runs is not null")
    runs = hot.agg(F.coalesce(F.sum("runs"), F.lit(0))).first()[0]
    spread = max(1, math.ceil(runs * (LENGTH - KMER + 1) * WINDOW_BYTES / BUCKET_BYTES))
    bits = spark.sparkContext.broadcast(bloom(hot.transform(map_arrow, _hot_keys, "key long")))
    return (texts.join(live.filter("runs is null").drop("runs"), ["tid", "ord"])
            .transform(map_arrow, _strings(buckets, bits, spread), _SHAPE))


def removals(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256, spans (binary: removed byte ranges as pairs of int64; null if
    none, or if the document is removed whole)."""
    spark = docs.sparkSession
    ship(spark)
    ord_ = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(ord_.alias("ord"), F.xxhash64(text).alias("tid"), text.alias("text"))
    slim = cut(docs.select(F.col(id_col).alias("doc_id"), ord_.alias("ord"), F.xxhash64(text).alias("tid"),
                           F.sha2(text, 256).alias("sha"), F.octet_length(text).cast("long").alias("n_bytes")), "rows")
    first = cut(slim.groupBy("sha").agg(F.min("ord").alias("first"), F.min("tid").alias("tid"),
                                        F.min("n_bytes").alias("n")), "first")
    total = first.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total / BUCKET_BYTES))

    def wanted(keys: DataFrame) -> DataFrame:
        bits = spark.sparkContext.broadcast(bloom(keys.transform(map_arrow, _mixed, "key long")))
        return texts.transform(map_arrow, _passes(bits), texts.schema)

    ranges = dealt(texts, first, buckets).groupBy("kind", "key").applyInArrow(_compare(buckets), _SHAPE)
    spans = cut(ranges.groupBy("key").applyInArrow(_merged, "tid long, spans binary")
                .join(first.select("tid", F.col("first").alias("ord")), "tid"), "spans")
    left = (wanted(spans.select("tid")).join(spans, ["tid", "ord"])
            .transform(map_arrow, _apply, "ord long, tid long, spans binary, n_removed long, n_spans long, kept_sha256 string")
            .dropDuplicates(["ord", "tid"]))
    whole = (F.col("ord") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    out = slim.join(first.select("sha", "first"), "sha").join(left, ["ord", "tid"], "left")
    return out.select(
        "doc_id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(~whole, F.col("spans")).alias("spans"))
