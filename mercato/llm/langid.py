"""Language identification by a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes (A-Z lowered, the last one
padded). Bytes are embedded, filters of the ``WIDTHS`` slide over each window,
every filter keeps its maximum, and a softmax layer gives the window's language
probabilities. The text's probabilities are the mean over all its windows,
weighted by their bytes, so the whole text counts.

The network is written and trained in numpy: on the driver, on up to
``WINDOWS_PER_TEXT`` windows of each of at most ``SAMPLE_ROWS`` labelled texts
taken by hash of their id. It is broadcast (its size is fixed but for the
number of languages) and applied to windows in batches; there the first layer
is a table look-up, one row for each pair of bytes.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows without label are predicted but not learned from; with no label at all
every text is ``und``; repeated rows are predicted each, of rows of one id the
smallest text with a letter is learned from; an empty table gives
an empty result. Language, source and id are never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import _LOWER, blocks, learnable, map_arrow, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
SAMPLE_ROWS = 3000
WINDOWS_PER_TEXT = 6
UND = "und"


@dataclass
class Net:
    langs: list[str]
    embed: np.ndarray
    conv: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    _tables: list = field(default_factory=list, repr=False)

    def tables(self):
        """First layer as look-ups: per width, one table for each pair of
        neighbouring bytes (or the last single byte) of the filter."""
        if not self._tables:
            for w, width in zip(self.conv, WIDTHS, strict=True):
                one = [(self.embed @ w[k * EMBED:(k + 1) * EMBED]).astype(np.float32) for k in range(width)]
                pairs = [(one[k][:, None] + one[k + 1][None]).reshape(65536, -1) for k in range(0, width - 1, 2)]
                self._tables.append((pairs, one[-1] if width % 2 else None))
        return self._tables

    def __getstate__(self):
        return self.__dict__ | {"_tables": []}

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(n, WINDOW) bytes -> (n, languages)."""
        out = []
        for i in range(0, len(windows), 512):
            x = windows[i:i + 512].astype(np.int32)
            pair = x[:, :-1] * 256 + x[:, 1:]
            pooled = []
            for (pairs, single), b, width in zip(self.tables(), self.bias, WIDTHS, strict=True):
                m = WINDOW - width + 1
                z = pairs[0][pair[:, :m]]
                for k, t in enumerate(pairs[1:], 1):
                    z += t[pair[:, 2 * k:2 * k + m]]
                if single is not None:
                    z += single[x[:, width - 1:width - 1 + m]]
                pooled.append(np.maximum(z.max(1) + b, 0))
            out.append(_softmax(np.concatenate(pooled, 1) @ self.out + self.out_bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.langs)))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def cut_windows(data: np.ndarray, off: np.ndarray):
    """(windows, text, n): all windows of the texts, the text of each, its bytes."""
    size = np.diff(off)
    many = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), many)
    begin = np.zeros(len(size) + 1, np.int64)
    np.cumsum(many, out=begin[1:])
    start = off[text] + (np.arange(len(text)) - begin[text]) * WINDOW
    n = np.minimum(off[text + 1] - start, WINDOW)
    padded = np.concatenate([_LOWER[data], np.zeros(WINDOW, np.uint8)])
    windows = padded[start[:, None] + np.arange(WINDOW)]
    windows[np.arange(WINDOW)[None] >= n[:, None]] = 0
    return windows, text, n


def fit(windows: np.ndarray, label: np.ndarray, langs: list[str], *, epochs: int = 4, batch: int = 64,
        rate: float = 3e-3, seed: int = 5) -> Net:
    """Cross entropy, mini-batches, Adam; the gradient runs back through the
    position of each filter's maximum."""
    rng = np.random.default_rng(seed)
    net = Net(langs, rng.normal(0, 0.3, (256, EMBED)),
              [rng.normal(0, (w * EMBED) ** -0.5, (w * EMBED, FILTERS)) for w in WIDTHS],
              [np.zeros(FILTERS) for _ in WIDTHS],
              rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(langs))), np.zeros(len(langs)))
    par = [net.embed, net.out, net.out_bias, *net.conv, *net.bias]
    mom = [(np.zeros_like(p), np.zeros_like(p)) for p in par]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            x, n = windows[rows].astype(np.int64), len(rows)
            e = net.embed[x].astype(np.float32)
            pooled, kept = [], []
            for w, b, width in zip(net.conv, net.bias, WIDTHS, strict=True):
                m = WINDOW - width + 1
                cols = np.concatenate([e[:, k:k + m] for k in range(width)], 2)
                z = cols @ w.astype(np.float32)
                at = z.argmax(1)
                pooled.append(np.maximum(np.take_along_axis(z, at[:, None], 1)[:, 0] + b, 0))
                kept.append((cols, at))
            h = np.concatenate(pooled, 1)
            d = _softmax(h @ net.out + net.out_bias)
            d[np.arange(n), label[rows]] -= 1
            d /= n
            dh = (d @ net.out.T) * (h > 0)
            ge, gconv, gbias = np.zeros_like(net.embed), [], []
            for k, ((cols, at), w, width) in enumerate(zip(kept, net.conv, WIDTHS, strict=True)):
                own = dh[:, k * FILTERS:(k + 1) * FILTERS]
                seen = cols[np.arange(n)[:, None], at]
                gconv.append(np.einsum("nf,nfc->cf", own, seen))
                gbias.append(own.sum(0))
                back = own[:, :, None] * w.T[None]
                for q in range(width):
                    np.add.at(ge, x[np.arange(n)[:, None], at + q], back[:, :, q * EMBED:(q + 1) * EMBED])
            step += 1
            for p, g, (a, v) in zip(par, [ge, h.T @ d, d.sum(0), *gconv, *gbias], mom, strict=True):
                a += 0.1 * (g - a)
                v += 0.001 * (g * g - v)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def _sample_windows(batches):
    """(lang, text) -> (lang, window): some windows of each text, evenly spread."""
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        lang = batch.column("lang")
        for i, j in blocks(off):
            windows, text, _ = cut_windows(data[off[i]:off[j]], off[i:j + 1] - off[i])
            first = np.searchsorted(text, np.arange(j - i + 1))
            many = np.diff(first)
            take = np.minimum(many, WINDOWS_PER_TEXT)
            row = np.repeat(np.arange(j - i), take)
            begin = np.concatenate([[0], np.cumsum(take)])
            pick = first[row] + (np.arange(len(row)) - begin[row]) * many[row] // np.maximum(take[row], 1)
            yield pa.RecordBatch.from_arrays(
                [lang.take(pa.array(i + row)), pa.array([w.tobytes() for w in windows[pick]], pa.binary())],
                ["lang", "window"])


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          folds: int = 5, held: int = 0, sample_rows: int = SAMPLE_ROWS) -> Net | None:
    """Fit on at most ``sample_rows`` labelled texts outside the held-out fold."""
    can = docs.filter(F.col(lang_col).isNotNull() & learnable(id_col, folds, held))
    ids = can.select(F.col(id_col).alias("_id")).distinct().orderBy(F.md5(F.col("_id").cast("string"))).limit(sample_rows)
    rows = (can.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .join(F.broadcast(ids), "_id")  # sample_rows bounds it
            .filter(has_letter(F.col("text")))
            # one row an id, so that sample_rows bounds the rows too
            .groupBy("_id").agg(F.min(F.struct("text", "lang")).alias("row")).select("row.lang", "row.text")
            .transform(map_arrow, _sample_windows, "lang string, window binary").toArrow())
    if rows.num_rows == 0:
        return None
    lang = np.array(rows.column("lang").to_pylist())
    raw = rows.column("window").to_pylist()
    order = np.array(sorted(range(len(raw)), key=lambda k: (lang[k], raw[k])))  # whatever the task order
    langs, label = np.unique(lang[order], return_inverse=True)
    windows = np.frombuffer(b"".join(raw[k] for k in order), np.uint8).reshape(-1, WINDOW)
    return fit(windows, label, [str(x) for x in langs])


def has_letter(text):
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, net: Net | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row, over its whole text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       has_letter(F.col(text_col)).alias("letters"))
    if net is None:
        return rows.select("doc_id", F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        model = shared.value
        for batch in batches:
            data, off = text_bytes(batch.column("text"))
            best, score = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows)
            for i, j in blocks(off):
                windows, text, n = cut_windows(data[off[i]:off[j]], off[i:j + 1] - off[i])
                p = model.probabilities(windows) * n[:, None]
                total = np.stack([np.bincount(text, weights=c, minlength=j - i) for c in p.T], 1)
                size = np.maximum(np.diff(off[i:j + 1]), 1)
                best[i:j] = total.argmax(1)
                score[i:j] = np.clip(total.max(1) / size, 0, 1)
            ok = batch.column("letters").to_numpy(zero_copy_only=False)
            names = np.where(ok, np.array(model.langs, object)[best], UND)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(np.where(ok, score, 0.0))],
                ["doc_id", "lang_pred", "score"])

    return rows.transform(map_arrow, run, f"doc_id {id_type}, lang_pred string, score double")
