"""Language-model scoring with a hidden Markov model.

Tokens are words (A-Z lowered) and one end token a text. A word is emitted in
two steps, so that the model stays small while every word of the corpus has a
count of its own:

    P(word | state) = P(class of word | state) * P(word | class)

The class of a word is a fixed rule (a hash of the word, or of the first byte
and the last four bytes of longer ones); P(word | class) is its add-one share
among the class's training tokens, with one unknown word a class. Hence the
likelihood of a text is the exact scaled forward recursion over its classes,
times the product of the word shares.

1. The texts are read once. Blocks of about ``BLOCK_TEXT`` bytes become
   rows with the block's dictionary (words, classes, training counts), the
   token sequences as indices into it, and the class sequences of the learnable
   texts, all that the rounds read; they are written to the shared folder and
   the later passes read them instead of the texts.
2. Word counts over the whole corpus: the dictionaries are dealt by word and
   summed, and the totals go back to the blocks; a very common word has one
   row a block, not one an occurrence.
3. Training starts from the class counts of the whole corpus, times seeded
   random weights. Its first rounds hold the state fixed within windows of
   ``WINDOW`` tokens (a mixture, without recursion), until the log-likelihood
   gains less than ``START_TOLERANCE`` of itself; then Baum-Welch rounds
   follow until it gains less than ``TOLERANCE``. Every round, of either kind, is
   a pass over all training texts: expected counts in every partition, a Spark
   aggregate sums them by class (fixed-point, so that reruns agree), and the driver
   normalises (classes x states numbers, whatever the corpus).
4. Each block is scored with its dictionary's totals and the broadcast model.

Defined cases: a null or empty text is its end token alone; rows without id
are scored but not learned from; repeated rows count as often as they occur;
with nothing to learn from all counts are 0 and the model is uniform; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import (
    _LOWER,
    U64,
    blocks,
    cut,
    held_out,
    learnable,
    map_arrow,
    ship,
    span_hashes,
    text_bytes,
    word_spans,
)

STATES = 8
CLASSES = 1 << 14
END = 0
#: Least gain of a round, as a share of the training texts' log-likelihood.
TOLERANCE = 1e-3
#: The same for the first rounds, in which a window has one state, and its tokens.
START_TOLERANCE = 2e-2
WINDOW = 256
#: Moves that the Baum-Welch rounds start from.
STAY = 20
BLOCK_TEXT = 9 << 20
#: Words of more bytes get a cryptographic key.
LONG_WORD = 64
#: Expected counts are summed in units of 1 / FIXED.
FIXED = 1 << 14
#: Tokens of forward-backward at once inside a task.
CHUNK = 300_000
#: Steps of the recursion between two scalings, and the least scale that this is good for.
EVERY = 4
SMALLEST = 1e-20
#: Weight of the corpus class share in every state's emissions, in tokens.
PRIOR = 50.0


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # (states, classes)


def word_classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class 1 .. CLASSES - 1 of each word: from all of up to five bytes, or
    from the first and the last four of longer words."""
    n = ends - starts
    short = n <= 5
    tail = np.where(short, starts, ends - 4)
    h = span_hashes(data, tail, ends) ^ np.where(short, U64(0), data[starts].astype(U64) + U64(1))
    return (1 + (h * U64(0x9E3779B97F4A7C15) >> U64(40)) % U64(CLASSES - 1)).astype(np.uint16)


def word_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of words. Polynomial hashes tell patterned long words apart badly
    (Thue-Morse words collide whatever the base), so these are digested one by one."""
    keys = span_hashes(data, starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        keys[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return keys


# ------------------------------------------------------------------ recursion
def time_major(first: np.ndarray):
    """Layout of sequences step by step: (order of texts by falling length,
    sequences active at each step, offset of each step, place of every token)."""
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    size = size[order]
    steps = int(size[0]) if len(size) else 0
    active = len(size) - np.cumsum(np.bincount(size, minlength=steps + 1))[:steps]
    at = np.zeros(steps + 1, np.int64)
    np.cumsum(active, out=at[1:])
    rank = np.repeat(np.arange(len(size)), size)
    t = np.arange(len(rank)) - np.repeat(np.cumsum(size) - size, size)
    source = first[order][rank] + t
    place = at[t] + rank
    return order, active, at, source, place, rank


def forward(start, move, emit: np.ndarray, active, at, every: int):
    """(alpha, scale) of time-major tokens with the given emission values: forward
    variables, scaled to a sum of 1 at every ``every``-th step only."""
    alpha = np.empty_like(emit)
    scale = np.ones(len(emit), emit.dtype)
    ones = np.ones(emit.shape[1], emit.dtype)
    for t in range(len(active)):
        p, q = at[t], at[t + 1]
        a = alpha[p:q]
        if t == 0:
            a[:] = start
        else:
            np.dot(last[:q - p], move, out=a)
        a *= emit[p:q]
        if t % every == every - 1:
            s = np.matmul(a, ones, out=scale[p:q])
            a /= s[:, None]
        last = a
    return alpha, scale


def expected(m: Hmm, classes: np.ndarray, first: np.ndarray):
    """Baum-Welch expected counts of the sequences: starts, moves, emissions."""
    return _expected(m, classes, first)[:3]


def _expected(m: Hmm, classes: np.ndarray, first: np.ndarray, every: int = EVERY):
    """Expected counts, and the natural logarithm of the sequences' probability.

    A step of the recursion is a product and a multiplication; the counts are taken
    for all steps at once. A class's emissions are divided by their largest, which
    leaves the counts as they are and lets most steps go unscaled; values that get
    near the end of the floating-point range send the sequences through again with
    every step scaled.
    """
    _, active, at, source, place, _ = time_major(first)
    tokens = np.empty(len(classes), np.int64)
    tokens[place] = classes[source]
    del source, place
    peak = m.emit.max(0)
    table = np.ascontiguousarray((m.emit / peak).T, dtype=np.float32)
    move, back = m.move.astype(np.float32), np.ascontiguousarray(m.move.T, dtype=np.float32)
    weight = np.take(table, tokens, axis=0)
    alpha, scale = forward(m.start.astype(np.float32), move, weight, active, at, every)
    size = np.diff(first)
    size = np.sort(size[size > 0])[::-1]
    ends = at[size - 1] + np.arange(len(size))
    rest = alpha[ends].sum(1)  # what the last steps of each sequence left unscaled
    if every > 1 and min(scale.min(initial=1), rest.min(initial=1)) < SMALLEST:
        return _expected(m, classes, first, 1)
    log = float(np.log(scale, dtype=np.float64).sum() + np.log(rest, dtype=np.float64).sum() + np.log(peak)[tokens].sum())
    beta = np.empty((len(size), STATES), np.float32)
    beta[:] = (1 / rest)[:, None]
    for t in range(len(active) - 1, -1, -1):
        p, q = at[t], at[t + 1]
        w = weight[p:q]
        w *= beta[:q - p]
        if t % every == every - 1:
            w /= scale[p:q, None]
        if t:
            np.dot(w, back, out=beta[:q - p])
    # weight is now emission * beta / scale
    moves = np.zeros((STATES, STATES))
    if len(active) > 1:
        before = np.arange(at[1], at[-1]) - np.repeat(active[:-1], active[1:])
        moves += (np.take(alpha, before, axis=0).T @ weight[at[1]:]) * m.move
    gamma = alpha
    gamma *= weight
    np.take(1 / table, tokens, axis=0, out=weight)
    gamma *= weight
    gamma *= scale[:, None]
    counts = np.stack([np.bincount(tokens, weights=gamma[:, k], minlength=CLASSES) for k in range(STATES)])
    return gamma[:at[1]].sum(0).astype(float) if len(active) else np.zeros(STATES), moves, counts, log


def mixed(m: Hmm, classes: np.ndarray, first: np.ndarray):
    """Expected counts and log-likelihood, as ``_expected``, with one state a window of a text."""
    per = -(-np.diff(first) // WINDOW)
    text = np.repeat(np.arange(len(per)), per)
    begin = first[text] + (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * WINDOW
    score = np.add.reduceat(np.take(np.log(m.emit.T).astype(np.float32), classes, axis=0), begin, axis=0)
    score = score.astype(float) + np.log(m.start)
    top = score.max(1, keepdims=True)
    share = np.exp(score - top)
    total = share.sum(1, keepdims=True)
    share /= total
    size = np.diff(np.append(begin, len(classes)))
    counts = np.stack([np.bincount(classes, weights=np.repeat(share[:, k], size), minlength=CLASSES) for k in range(STATES)])
    return share.sum(0), np.zeros((STATES, STATES)), counts, float((np.log(total) + top).sum())


def likelihoods(m: Hmm, classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 probability of each class sequence; only the scales are kept."""
    out = np.zeros(len(first) - 1)
    by_size = np.argsort(-np.diff(first), kind="stable")  # long texts together: few steps with few texts
    emit, ones = np.ascontiguousarray(m.emit.T), np.ones(STATES)
    for i, j in blocks(np.concatenate([[0], np.cumsum(np.diff(first)[by_size])]), CHUNK):
        some, own = _subset(classes, first, by_size[i:j])
        order, active, at, source, place, rank = time_major(own)
        tokens = np.empty(len(source), np.int64)
        tokens[place] = some[source]
        scale = np.empty(len(tokens))
        a = None
        for p, q in zip(at[:-1], at[1:], strict=True):
            a = (m.start[None] if a is None else a[:q - p] @ m.move) * np.take(emit, tokens[p:q], axis=0)
            s = a @ ones
            a /= s[:, None]
            scale[p:q] = s
        out[by_size[i:j][order]] = np.bincount(rank, weights=np.log10(scale[place]), minlength=j - i)
    return out


def normalised(start, moves, counts, prior: float = PRIOR) -> Hmm:
    share = (counts.sum(0) + 1) / (counts.sum() + CLASSES)
    emit = counts + prior * share
    move = moves + 1.0
    start = start + 1.0
    return Hmm(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def seeded(base: np.ndarray, seed: int = 3) -> Hmm:
    """Starting point: the counts of all classes, times random weights a state."""
    counts = (base + 1e-3) * np.random.default_rng(seed).gamma(1.0, 1.0, (STATES, CLASSES))
    return normalised(np.ones(STATES), np.eye(STATES) * STAY, counts, 1.0)


def first_model(sequences: list[np.ndarray], rounds: int = 15, seed: int = 3) -> Hmm:
    """Baum-Welch on sequences in memory, from the seeded model."""
    first = np.concatenate([[0], np.cumsum([len(s) for s in sequences])]).astype(np.int64)
    classes = np.concatenate(sequences).astype(np.int64) if sequences else np.zeros(0, np.int64)
    m = seeded(np.bincount(classes, minlength=CLASSES), seed)
    for _ in range(rounds if len(classes) else 0):
        m = normalised(*expected(m, classes, first), prior=5.0)
    return m


# --------------------------------------------------------------------- blocks
def _encode(batches):
    """(doc_id, learn, held_out, text) -> one row a block of texts."""
    n = 0

    def row(held):
        nonlocal n
        hashes = np.concatenate([h[0] for h in held])
        words, at, index, times = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        of_tokens = np.concatenate([h[1] for h in held])
        classes = of_tokens[at]
        count = np.concatenate([h[2] for h in held])
        learn = np.concatenate([h[3] for h in held])
        rows = np.flatnonzero(learn)
        # long texts together, so that few steps have few texts
        rows = rows[np.argsort(-count[rows], kind="stable")]
        sequences, first = _subset(*_with_ends(of_tokens, count), rows)
        learned = np.bincount(index, weights=np.repeat(learn, count), minlength=len(words)).astype(np.int64)
        order = np.argsort(-times, kind="stable")  # small indices for common words pack well
        new = np.empty(len(words), np.int64)
        new[order] = np.arange(len(words))
        index = new[index].astype(np.uint32)
        ids = pa.concat_arrays([h[4] for h in held])
        flags = pa.concat_arrays([h[5] for h in held])
        out = pa.RecordBatch.from_arrays([
            pa.array([(TaskContext.get().partitionId() << 32) + n], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), flags),
            pa.array([sequences.tobytes()], pa.binary()),
            pa.array([np.diff(first).astype(np.uint32).tobytes()], pa.binary()),
            pa.array([count.astype(np.uint32).tobytes()], pa.binary()),
            pa.array([(index & 0xFFFF).astype(np.uint16).tobytes()], pa.binary()),
            pa.array([(index >> 16).astype(np.uint16).tobytes()], pa.binary()),
            pa.array([words[order].tobytes()], pa.binary()),
            pa.array([classes[order].tobytes()], pa.binary()),
            pa.array([learned[order].tobytes()], pa.binary()),
        ], ["block", "ids", "held", "sequences", "steps", "count", "low", "high", "words", "classes", "learned"])
        n += 1
        return out

    held, size = [], 0
    for batch in batches:
        data, off = text_bytes(batch.column("text"))
        for i, j in blocks(off):
            low = _LOWER[data[off[i]:off[j]]]
            starts, ends, first = word_spans(low, off[i:j + 1] - off[i])
            held.append((word_keys(low, starts, ends), word_classes(low, starts, ends), np.diff(first),
                         batch.column("learn").slice(i, j - i).to_numpy(zero_copy_only=False).astype(bool),
                         batch.column("doc_id").slice(i, j - i), batch.column("held").slice(i, j - i)))
            size += off[j] - off[i]
            if size >= BLOCK_TEXT:
                yield row(held)
                held, size = [], 0
    if held:
        yield row(held)


def _tokens(batch, r: int):
    """Word indices and words a text of row r."""
    low = np.frombuffer(batch.column("low")[r].as_buffer(), np.uint16)
    high = np.frombuffer(batch.column("high")[r].as_buffer(), np.uint16)
    return (low.astype(np.int64) | (high.astype(np.int64) << 16),
            np.frombuffer(batch.column("count")[r].as_buffer(), np.uint32).astype(np.int64))


def _with_ends(classes, count):
    """(classes, first) of texts of ``count`` words, each with its end token."""
    first = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count + 1, out=first[1:])
    out = np.full(first[-1], END, np.uint16)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    out[inside] = classes
    return out, first


def _subset(classes, first, rows):
    size = np.diff(first)[rows]
    own = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(size, out=own[1:])
    return classes[np.repeat(first[rows] - own[:-1], size) + np.arange(own[-1])], own


def _dictionary(batches):
    """Block rows -> (word, block, pos, class, n): the dictionary as rows."""
    for batch in batches:
        for r in range(batch.num_rows):
            words = np.frombuffer(batch.column("words")[r].as_buffer(), np.int64)
            block = batch.column("block")[r].as_py()
            cls = np.frombuffer(batch.column("classes")[r].as_buffer(), np.uint16).astype(np.int32)
            n = np.frombuffer(batch.column("learned")[r].as_buffer(), np.int64)
            for i in range(0, len(words), 50_000):
                k = min(50_000, len(words) - i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[i:i + k]), pa.array(np.full(k, block)), pa.array(np.arange(i, i + k, dtype=np.int32)),
                     pa.array(cls[i:i + k]), pa.array(n[i:i + k])], ["word", "block", "pos", "class", "n"])


def _expect(shared, step):
    def run(batches):
        m = shared.value
        start, moves, counts, log = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES)), 0.0
        for batch in batches:
            for r in range(batch.num_rows):
                classes = np.frombuffer(batch.column("sequences")[r].as_buffer(), np.uint16)
                first = np.concatenate([[0], np.cumsum(np.frombuffer(batch.column("steps")[r].as_buffer(), np.uint32), dtype=np.int64)])
                for i, j in blocks(first, CHUNK):
                    s, v, c, g = step(m, classes[first[i]:first[j]], first[i:j + 1] - first[i])
                    start += s
                    moves += v
                    counts += c
                    log += g
        seen = np.flatnonzero(counts.any(0))
        key = np.concatenate([seen, CLASSES + np.arange(STATES + 2)])
        value = np.concatenate([counts[:, seen], moves.T, start[:, None], np.full((STATES, 1), log)], 1)
        value = np.rint(value * FIXED).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), *(pa.array(v) for v in value)], ["key", *(f"s{k}" for k in range(STATES))])

    return run


def fit(coded: DataFrame, model: Hmm, tolerance: float = TOLERANCE):
    """All rounds over the learnable texts of the blocks: (model, log-likelihood
    before each Baum-Welch round)."""
    sc = coded.sparkSession.sparkContext
    names = [f"s{k}" for k in range(STATES)]
    for step, least in ((mixed, START_TOLERANCE), (_expected, tolerance)):
        logs = []
        while len(logs) < 2 or logs[-1] - logs[-2] > least * abs(logs[-2]):
            sums = (coded.select("sequences", "steps")
                    .transform(map_arrow, _expect(sc.broadcast(model), step), "key long, " + ", ".join(f"{k} long" for k in names))
                    .groupBy("key").agg(*[F.sum(k).alias(k) for k in names]).toArrow())
            table = np.zeros((STATES, CLASSES + STATES + 2))
            table[:, sums.column("key").to_numpy()] = np.stack([sums.column(k).to_numpy() for k in names]) / FIXED
            logs.append(float(table[0, -1]))
            moves = np.eye(STATES) * STAY if step is mixed else table[:, CLASSES:CLASSES + STATES].T
            model = normalised(table[:, -2], moves, table[:, :CLASSES])
    return model, logs


def _score(shared):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        m, spread, base, total = shared.value
        parts = []
        for r in range(right.num_rows):
            index, count = _tokens(right, r)
            own = np.frombuffer(right.column("classes")[r].as_buffer(), np.uint16)
            c = np.zeros(len(own), np.int64)
            c[left.column("pos").to_numpy()] = left.column("c").to_numpy()
            lead = np.zeros(len(count) + 1, np.int64)
            np.cumsum(count, out=lead[1:])

            def sums(per_word, index=index, lead=lead):
                run = np.zeros(len(index) + 1)
                np.cumsum(per_word[index], out=run[1:])
                return run[lead[1:]] - run[lead[:-1]]

            plus = np.log10(c + 1.0)
            classes, first = _with_ends(own[index], count)
            words = sums(plus)
            known = np.rint(sums((c > 0).astype(float))).astype(np.int64)
            ends, end_known = base
            parts.append(pa.table({
                "doc_id": right.column("ids")[r].values, "held_out": right.column("held")[r].values,
                "n_tokens": pa.array(count + 1), "n_known": pa.array(known + end_known),
                "train_tokens": pa.array(np.full(len(count), total[0])),
                "base_score": pa.array(words + np.log10(ends + 1.0) - (count + 1) * np.log10(total[0] + total[1] + 1.0)),
                "score": pa.array(likelihoods(m, classes, first) + words - sums(np.log10(spread)[own])),
            }))
        return pa.concat_tables(parts).combine_chunks()

    return run


def score(docs: DataFrame, *, folds: int = 7, held: int = 2, tolerance: float = TOLERANCE,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (unigram), score (hidden Markov model), log10."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    ship(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), learnable(id_col, folds, held).alias("learn"),
                       held_out(id_col, folds, held).alias("held"), F.col(text_col).alias("text"))
    coded = cut(rows.transform(map_arrow, _encode, f"block long, ids array<{id_type}>, held array<boolean>, "
                               "sequences binary, steps binary, count binary, low binary, high binary, words binary, "
                               "classes binary, learned binary"), "coded")

    # counts of every word over the corpus, brought back to each dictionary
    by_word = Window.partitionBy("word")
    looked = cut(coded.select("block", "words", "classes", "learned")
                 .transform(map_arrow, _dictionary, "word long, block long, pos int, class int, n long")
                 .withColumn("c", F.sum("n").over(by_word))
                 .withColumn("one", F.row_number().over(by_word.orderBy("block")) == 1)
                 .select("block", "pos", "class", "c", "one"), "counts")
    per_class = (looked.filter("one and c > 0").groupBy("class")
                 .agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("types")).collect())  # CLASSES rows at most
    spread, base = np.ones(CLASSES), np.zeros(CLASSES)
    for r in per_class:
        spread[r["class"]] += r["tokens"] + r["types"]
        base[r["class"]] = r["tokens"]
    trained = rows.filter("learn").select("learn").count()
    n = sum(r["tokens"] for r in per_class) + trained
    v = sum(r["types"] for r in per_class) + (trained > 0)

    base[END] = trained
    model = seeded(base)
    if trained:
        model, _ = fit(coded, model, tolerance)

    shared = sc.broadcast((model, spread, (trained, int(trained > 0)), (n, v)))
    return (looked.select("block", "pos", "c").groupBy("block")
            .cogroup(coded.select("block", "ids", "held", "count", "low", "high", "classes").groupBy("block"))
            .applyInArrow(_score(shared), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
                                          "train_tokens long, base_score double, score double"))
