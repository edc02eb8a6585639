import hashlib
import random

import numpy as np
import pyarrow as pa

from mercato.llm import suffix_dedup as sd

from .util import docs, edge_rows, prose


def brute(rows, length=50):
    big = 1 << 63
    own = [(big if r[0] is None else r[0], (r[1] or "").encode()) for r in rows]
    first = {}
    for o, b in own:
        for j in range(len(b) - length + 1):
            w = b[j:j + length]
            first[w] = min(first.get(w, big), o)
    out = []
    for r, (o, b) in zip(rows, own, strict=True):
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - length + 1):
            if first[b[j:j + length]] < o:
                gone[j:j + length] = True
        spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]]))) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((r[0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages():
    rng = random.Random(11)
    shared = [prose(rng, rng.choice([8, 12, 40]), 3000) for _ in range(12)]
    rows = []
    for i in range(60):
        body = prose(rng, rng.randint(5, 60), 3000).split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(body))
            piece = rng.choice(shared)
            body[at:at] = [piece[rng.randrange(20):]]
        rows.append((rng.choice([i, i, -i]), " ".join(body)))
    rows.append((500, "ab" * 400))
    rows.append((501, "ba" * 300 + "é" * 60))
    rows.append((502, "é" * 100))
    rows.append((503, "x" + "\0" * 80))
    rows.append((504, "\0" * 60 + "y"))
    return rows


def run(spark, rows):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                   for r in sd.removals(docs(spark, rows)).collect()), key=repr)


def test_removals_match_brute_force(spark):
    rows = passages() + edge_rows()
    assert run(spark, rows) == brute(rows)


def test_many_blocks_buckets_and_chunks(spark, monkeypatch):
    rows = passages()
    monkeypatch.setattr(sd, "BUCKET_BYTES", 3000)
    assert run(spark, rows) == brute(rows)


def test_interval_expansion_finds_equal_windows():
    rng = random.Random(0)
    for _ in range(40):
        length = rng.choice([3, 5, 50])
        base = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 120))) for _ in range(3)]
        strings = [b[rng.randint(0, len(b)):] + bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 30)))
                   for b in (rng.choice(base) for _ in range(rng.randint(1, 8)))]
        own, place, group = sd.equal_windows(np.frombuffer(b"".join(strings), np.uint8),
                                             np.array([len(s) for s in strings]), length)
        got = {}
        for s, p, g in zip(own, place, group, strict=True):
            got.setdefault(g, set()).add((s, p))
        want = {}
        for i, s in enumerate(strings):
            for j in range(len(s) - length + 1):
                want.setdefault(s[j:j + length], set()).add((i, j))
        assert sorted(map(sorted, got.values())) == sorted(sorted(w) for w in want.values() if len(w) > 1)


def test_runs_cover_every_window_and_agree_across_texts():
    rng = random.Random(1)
    a, b = (prose(rng, 60).encode() for _ in range(2))
    common = prose(rng, 30).encode()
    data = np.frombuffer(a + common + b + common, np.uint8)
    off = np.array([0, len(a) + len(common), len(data)])
    text, first, last, h = sd.window_runs(data, off)
    covered = sorted(p for f, e in zip(first, last, strict=True) for p in range(f, e + 1))
    assert covered == [p for t in range(2) for p in range(off[t], off[t + 1] - 49)]
    of = {p: x for f, e, x in zip(first, last, h, strict=True) for p in range(f, e + 1)}
    for k in range(len(common) - 49):
        assert of[len(a) + k] == of[len(a) + len(common) + len(b) + k]


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "short")]) == brute([(1, None), (2, "short")])


def common_line(n):
    """A 30-byte line between different texts; some have a neighbour's words beside it."""
    rng = random.Random(21)
    line = "All rights reserved 2024, ACME"
    sides = [(prose(rng, 14, 3000), prose(rng, 14, 3000)) for _ in range(n)]
    rows = [(i, f"{a} {line} {b}") for i, (a, b) in enumerate(sides)]
    rows += [(n + i, f"{sides[i][0]} {line} {prose(rng, 14, 3000)}") for i in range(0, n, 9)]
    return rows


def test_windows_of_a_hot_minimizer_are_dealt_singly(spark, monkeypatch):
    rows = common_line(600)
    monkeypatch.setattr(sd, "HOT_RUNS", 50)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 100_000)
    assert run(spark, rows) == brute(rows)
    texts = docs(spark, rows).selectExpr("doc_id as ord", "xxhash64(text) as tid", "text")
    groups = {}
    for r in sd.dealt(texts, texts.selectExpr("tid", "ord as first"), 8).collect():
        groups.setdefault((r.kind, r.key), []).append(bytes(r.c0))
    strings = [np.concatenate([sd._unpack(pa.scalar(v, pa.binary()), np.int64).reshape(5, -1)[4] for v in own])
               for (kind, _), own in groups.items() if kind == 0]
    assert max(np.unique(s, return_counts=True)[1].max() for s in strings) <= 50
    windows = [sum(sd._unpack(pa.scalar(v, pa.binary()), np.int64).size // 5 for v in own)
               for (kind, _), own in groups.items() if kind == 2]
    assert len(windows) > 1 and max(windows) < 2 * sum(windows) / len(windows)


def test_all_minimizers_hot_gives_the_same(spark, monkeypatch):
    rows = passages() + edge_rows()
    monkeypatch.setattr(sd, "HOT_RUNS", 0)
    monkeypatch.setattr(sd, "BUCKET_BYTES", 30_000)
    assert run(spark, rows) == brute(rows)
