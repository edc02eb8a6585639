"""Small tables and brute-force versions for the operator tests."""

import random
import re
import zlib

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ALNUM = re.compile(rb"[A-Za-z0-9\x80-\xff]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          # names that operators use inside
          "key string, size string, score string, kept string, node string, tid string, word string, block string")


def docs(spark, rows):
    """rows: (doc_id, text[, lang[, source]]), with extra columns of clashing names."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]),
             *["x"] * 8) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n, words=400):
    vocab = [f"w{i}" + "abcdefgh"[i % 8] * (i % 4) for i in range(words)]
    return " ".join(rng.choice(vocab) for _ in range(n))


def edge_rows():
    """Nulls, empties, blanks, non-ASCII, ties, repeated rows, a long text."""
    rng = random.Random(4)
    long = prose(rng, 9000)
    base = prose(rng, 120)
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "One"), (6, "été ÉTÉ été"), (None, base),
            (7, base), (7, base), (8, base.upper()), (9, long), (10, long + " tail"), (11, "!!! ??? ..."),
            (12, prose(rng, 60), None, None), (13, prose(rng, 80), "fr", ""), (-5, base + " more"), (None, None)]


def crc(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def words(text, kind=WORD):
    return [bytes(w).lower() for w in kind.findall((text or "").encode())]


def shingles(text):
    w = words(text, ALNUM)
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
