"""Quality rules: compression bands over word, line and repetition counts.

A text is compressed with zstandard twice over: whole, and in fixed chunks of
``CHUNK`` bytes. Its ratio (bytes over compressed bytes) must lie in the band
that ``BANDS`` gives for its length: above the band the text is repetitive,
below it it is incompressible (encoded or random bytes). Short texts compress
less, since the code tables weigh more, hence the limits by length. A chunk
is judged by the band of its own length; when chunks outside their bands hold
``CHUNK_SHARE`` of the text's bytes or more, the text is rejected even if its
whole ratio is in the middle (half noise, half repetition).

Counts: words are maximal runs of other characters than white space;
``word_chars`` their code points; ``n_symbols`` the characters of ``SYMBOLS``
in the text; ``n_dup_lines`` the lines with a word that equal an earlier line;
``n_repeat_words`` the words inside three-word windows that the text has twice
or more, the first included. Words and lines are compared by their bytes.

Defined cases: null counts as empty, has no words and fails the base rule (as
does any text under ``MIN_WORDS`` words); a text or chunk shorter than the
first band has no limits; every row gets a row, repeated or null ids too; an
empty table gives an empty result. Nothing but the row itself decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import SPACED, blocks, map_arrow, text_bytes, word_spans
from mercato.llm.words import pair_ids, per_text, span_ids

#: (least bytes, lowest ratio, highest ratio), by rising length.
BANDS = [(256, 1.10, 2.6), (512, 1.25, 3.0), (1024, 1.33, 3.4), (2048, 1.40, 3.8), (4096, 1.45, 4.2),
         (16384, 1.45, 4.8), (65536, 1.45, 5.5)]
CHUNK = 4096
CHUNK_SHARE = 0.25
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
WINDOW = 3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text of a block."""
    starts, ends, first = word_spans(data, off)
    ids = span_ids(data, starts, ends)
    n = np.diff(first)
    text = np.repeat(np.arange(len(n)), n)

    # windows of three words that lie in one text
    at = np.flatnonzero(text[:len(text) - WINDOW + 1] == text[WINDOW - 1:]) if len(ids) >= WINDOW else np.zeros(0, np.int64)
    key = text[at]
    for k in range(WINDOW):
        key = pair_ids(key, ids[at + k])
    again = at[np.bincount(key)[key] > 1] if len(at) else at
    repeated = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        repeated[again + k] = True

    return {
        "n_words": n,
        "word_chars": per_text(SPACED[data] & ((data & 0xC0) != 0x80), off),
        "n_symbols": per_text(_SYMBOL[data], off),
        "n_dup_lines": duplicate_lines(data, off),
        "n_repeat_words": per_text(repeated, first),
    }


def duplicate_lines(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of it."""
    n = len(off) - 1
    breaks = np.flatnonzero(data == 0x0A)
    # a line ends at a break or at the end of its text; lines without a byte hold no word
    starts = np.unique(np.concatenate([off[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    words = np.concatenate([[0], np.cumsum(SPACED[data])])
    text_of = np.searchsorted(off, starts, "right") - 1
    own = np.minimum(np.append(breaks, len(data))[np.searchsorted(breaks, starts)], off[text_of + 1])
    keep = words[own] > words[starts]
    starts, own, text_of = starts[keep], own[keep], text_of[keep]
    key = pair_ids(span_ids(data, starts, own), text_of)
    _, seen = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[seen] = False
    return np.bincount(text_of[later], minlength=n)


def band(n_bytes: int, bands=None) -> tuple[float, float]:
    """(lowest, highest) ratio allowed for a length."""
    found = (0.0, float("inf"))
    for least, low, high in bands or BANDS:
        if n_bytes >= least:
            found = (low, high)
    return found


def compression(raw: memoryview, compressor, bands=None, chunk: int = CHUNK) -> tuple[float, float, str | None]:
    """(ratio of the whole text, share of its bytes in chunks outside their band, reason to reject)."""
    n = len(raw)
    if n == 0:
        return 0.0, 0.0, None
    ratio = n / len(compressor.compress(raw))
    low, high = band(n, bands)
    if n <= chunk:  # the only chunk is the text
        share = float(not low <= ratio <= high)
    else:
        outside = 0
        for i in range(0, n, chunk):
            piece = raw[i:i + chunk]
            at_least, at_most = band(len(piece), bands)
            outside += len(piece) * (not at_least <= len(piece) / len(compressor.compress(piece)) <= at_most)
        share = outside / n
    reason = ("repetitive" if ratio > high else "incompressible" if ratio < low
              else "chunks" if share >= CHUNK_SHARE else None)
    return ratio, share, reason


_OUT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_bytes long, "
        "ratio double, chunk_share double, base_failed boolean, kept boolean, reason string")


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", level: int = LEVEL, bands=None,
          chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: its counts, ratios, verdict and the reason of a rejection."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        compressor = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            for i, j in blocks(off):
                own, bounds = data[off[i]:off[j]], off[i:j + 1] - off[i]
                c = counts(own, bounds)
                short = c["n_words"] < MIN_WORDS
                failed = short | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                view = memoryview(np.ascontiguousarray(own))
                found = [compression(view[a:b], compressor, bands, chunk) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                reason = ["short" if s else "repeats" if f else r for s, f, (_, _, r) in zip(short, failed, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), *(pa.array(v.astype(np.int64)) for v in c.values()),
                     pa.array(np.diff(bounds)), pa.array([r for r, _, _ in found], pa.float64()),
                     pa.array([s for _, s, _ in found], pa.float64()), pa.array(failed),
                     pa.array([r is None for r in reason]), pa.array(reason, pa.string())],
                    ["doc_id", *c, "n_bytes", "ratio", "chunk_share", "base_failed", "kept", "reason"])

    return rows.transform(map_arrow, run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {_OUT}")


def keep(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns.

    The whole row travels beside its text as one struct, so that no row needs
    an id of its own and no join is made.
    """
    text_col = options.pop("text_col", "text")
    options.pop("id_col", None)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    return judge(whole, id_col="row", text_col="text", **options).filter("kept").select("doc_id.*")
