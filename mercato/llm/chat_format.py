"""Chat formatting: roles recovered from transcripts by a hidden Markov model.

A transcript is a sequence of messages (conversation, position, text) whose
speakers are unknown or only partly marked. Messages are split into lines; a
line's observation is its speaker marker (``User:``, ``### Assistant``,
``<|im_start|>system`` ...), its length, how its message is cut (length and
number of lines, on the first line), how it ends and how it begins. The hidden
state is the speaker's role. Between messages roles follow the turn-taking
matrix, between lines of one message the line matrix. Viterbi gives the most
likely roles of the whole conversation; lines of one role (up to the next
marker) make a turn, rendered canonically as

    <|im_start|>role
    text without its marker<|im_end|>

Training counts observations and moves in labelled messages, by Spark
aggregates whose results have a fixed number of rows.

Decoding never needs a conversation in one task: it is cut into chunks of
``CHUNK`` positions, each chunk gives the best score from every entering to
every leaving role (a 4 x 3 matrix), the matrices of a conversation are chained
in order, and every chunk is decoded between the roles fixed at its borders.
This is exactly the Viterbi path of the whole conversation.

Defined cases: a null text is one empty line; a null conversation id makes the
message a conversation of its own; null positions come first; messages with
the same position are ordered by text; repeated rows are turns each; an empty
table gives an empty result; a message with text before and after an inline
marker gives several turns, numbered by ``segment``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import cut, group_starts, map_arrow, whole_groups

ROLES = ("system", "user", "assistant")
#: Names that markers use for each role.
NAMES = {
    "system": ("system", "instructions"),
    "user": ("user", "human", "customer", "question", "q"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a"),
}
MARKER = (r"(?i)^\s*(?:<\|im_start\|>\s*(\w+)\s*|#{1,6}\s*(\w+)\s*:?\s*$|\[(\w+)\]\s*:?|\*{0,2}("
          + "|".join(n for ns in NAMES.values() for n in ns) + r")\*{0,2}\s*[:>]\*{0,2})\s*")
CHUNK = 1024
#: Feature columns and the number of values of each.
FEATURES = {"f_marker": len(ROLES) + 1, "f_length": 16, "f_message": 21, "f_count": 6, "f_end": 4, "f_begin": 4}


@dataclass
class Model:
    start: np.ndarray  # log P(first role)
    turn: np.ndarray   # log P(role | role of the message before)
    line: np.ndarray   # log P(role | role of the line before), same message
    emit: dict[str, np.ndarray]  # feature -> log P(value | role)


def marker_role(line):
    """0 for no known marker, else 1 + the role's number."""
    name = F.lower(F.coalesce(*[F.nullif(F.regexp_extract(line, MARKER, k), F.lit("")) for k in range(1, 5)], F.lit("")))
    role = F.lit(0)
    for k, r in enumerate(ROLES):
        role = F.when(name.isin(*NAMES[r]), k + 1).otherwise(role)
    return role


def lines_of(messages: DataFrame, conv_col: str, turn_col: str, text_col: str, role_col: str | None):
    """(messages with a key and number, their lines as features); both written."""
    known = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col(role_col)).cast("int") if role_col else F.lit(None)
    m = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        known.cast("int").alias("known")).withColumn("mid", F.monotonically_increasing_id())
    key = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.concat(F.lit("m"), F.col("mid").cast("string")))
    m = cut(m.withColumn("key", key), "messages")
    parts = F.split("text", "\n")
    x = m.select("key", "mid", "known", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"),
                 F.xxhash64("text").alias("tie"), F.length("text").alias("size"), F.size(parts).alias("n"),
                 F.posexplode(parts).alias("pos", "line"))

    def log2(c, top):
        return F.least(F.floor(F.log2(c + F.lit(1.0))), F.lit(top)).cast("int")

    first = F.col("pos") == 0
    end = F.substring(F.trim("line"), -1, 1)
    begin = F.substring(F.trim("line"), 1, 1)
    lines = x.select(
        "key", F.floor(F.col("turn") / CHUNK).alias("chunk"), "turn", "tie", "mid", "pos", "known",
        marker_role(F.col("line")).alias("f_marker"), log2(F.length("line"), 15).alias("f_length"),
        F.when(first, log2(F.col("size"), 19) + 1).otherwise(0).alias("f_message"),
        F.when(first, F.least(F.col("n"), F.lit(5))).otherwise(0).alias("f_count"),
        F.when(end == "?", 1).when(end.isin(".", "!"), 2).when(end == ":", 3).otherwise(0).alias("f_end"),
        F.when(begin.isin("-", "*", "#", "`"), 1).when(begin.rlike("[0-9]"), 2).when(begin == "", 3).otherwise(0).alias("f_begin"))
    return m, cut(lines, "lines")


def train(lines: DataFrame, learn: DataFrame | None = None) -> Model:
    """Log-probabilities (add-one) from the lines of labelled messages; with
    ``learn`` (a column ``key``) only those conversations."""
    x = lines.filter("known is not null")
    if learn is not None:
        x = x.join(learn.select("key").distinct(), "key", "left_semi")
    k = len(ROLES)
    emit = {}
    # one pass for all features: as many rows as (feature, role, value) triples
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("int").alias("v")) for f in FEATURES])).alias("p")
    counts = x.select("known", pairs).groupBy("known", "p.f", "p.v").count().collect()
    for f, n in FEATURES.items():
        c = np.ones((k, n))
        for r in counts:
            if r["f"] == f:
                c[r["known"] - 1, r["v"]] += r["count"]
        emit[f] = np.log(c / c.sum(1, keepdims=True))
    # moves between neighbouring positions of a conversation, and first roles
    heads = x.filter("pos = 0").groupBy("key", "turn").agg(F.min("known").alias("known"))
    nxt = heads.select("key", (F.col("turn") - 1).alias("turn"), F.col("known").alias("then"))
    moves = heads.join(nxt, ["key", "turn"]).groupBy("known", "then").count().collect()
    turn = np.ones((k, k))
    for r in moves:
        turn[r["known"] - 1, r["then"] - 1] += r["count"]
    start = np.ones(k)
    for r in heads.groupBy("key").agg(F.min(F.struct("turn", "known")).alias("h")).groupBy("h.known").count().collect():
        start[r["known"] - 1] += r["count"]
    line = np.full((k, k), 1e-4) + np.eye(k)  # a message rarely changes its speaker without a marker
    return Model(np.log(start / start.sum()), np.log(turn / turn.sum(1, keepdims=True)),
                 np.log(line / line.sum(1, keepdims=True)), emit)


_ORDER = ["key", "chunk", "turn", "tie", "mid", "pos"]


def _layout(t: pa.Table):
    """Chunks of a sorted table laid out step by step, as array operations."""
    starts = group_starts(t, ["key", "chunk"])
    size = np.diff(np.append(starts, t.num_rows))
    order = np.argsort(-size, kind="stable")
    steps = int(size.max()) if len(size) else 0
    return starts, size, order, steps


def _scores(m: Model, t: pa.Table):
    """Log emission of each line and role; whether the line begins a message."""
    e = sum(m.emit[f].T[t.column(f).to_numpy().astype(int)] for f in FEATURES)
    mid = t.column("mid").to_numpy()
    new = np.ones(t.num_rows, bool)
    new[1:] = mid[1:] != mid[:-1]
    # a marker inside a message begins a turn, with the turn-taking matrix
    return e, new | (t.column("f_marker").to_numpy() > 0)


def _matrices(shared):
    """Best score of each chunk from entering role (or the start) to last role."""
    k = len(ROLES)

    def run(batches):
        m = shared.value
        for t in whole_groups(batches, ["key", "chunk"]):
            e, new = _scores(m, t)
            starts, size, order, steps = _layout(t)
            v = np.zeros((len(starts), k + 1, k))
            for step in range(steps):
                live = order[:np.searchsorted(-size[order], -step, "left")]
                row = starts[live] + step
                if step == 0:
                    v[live, :k] = m.turn[None] + e[row, None]
                    v[live, k] = m.start[None] + e[row]
                else:
                    move = np.where(new[row, None, None], m.turn[None], m.line[None])
                    v[live] = (v[live][:, :, :, None] + move[:, None]).max(2) + e[row, None]
            yield pa.RecordBatch.from_arrays(
                [t.column("key").take(pa.array(starts)).combine_chunks(), t.column("chunk").take(pa.array(starts)).combine_chunks(),
                 pa.array([x.tobytes() for x in v], pa.binary())], ["key", "chunk", "best"])

    return run


def _chain(batches):
    """Chunk matrices of whole conversations, in order -> entering and last role."""
    k = len(ROLES)
    for t in whole_groups(batches, ["key"]):
        starts = np.append(group_starts(t, ["key"]), t.num_rows)
        best = np.frombuffer(b"".join(t.column("best").to_pylist())).reshape(-1, k + 1, k)
        enter, leave = np.full(t.num_rows, k), np.zeros(t.num_rows, int)
        for p, q in zip(starts[:-1], starts[1:], strict=True):
            v, back = best[p, k], []
            for c in range(p + 1, q):
                s = v[:, None] + best[c, :k]
                back.append(s.argmax(0))
                v = s.max(0)
            leave[q - 1] = v.argmax()
            for c in range(q - 1, p, -1):
                enter[c] = leave[c - 1] = back[c - p - 1][leave[c]]
        yield pa.RecordBatch.from_arrays(
            [t.column("key").combine_chunks(), t.column("chunk").combine_chunks(), pa.array(enter.astype(np.int32)),
             pa.array(leave.astype(np.int32))], ["key", "chunk", "enter", "leave"])


def _decode(shared):
    """Viterbi inside each chunk between its fixed borders -> role of each line."""
    def run(batches):
        m = shared.value
        for t in whole_groups(batches, ["key", "chunk"]):
            e, new = _scores(m, t)
            starts, size, order, steps = _layout(t)
            enter, leave = t.column("enter").to_numpy(), t.column("leave").to_numpy()
            first = np.concatenate([m.turn, m.start[None]])
            back = np.zeros((t.num_rows, len(ROLES)), np.int8)
            v = np.zeros((len(starts), len(ROLES)))
            lives = []
            for step in range(steps):
                live = order[:np.searchsorted(-size[order], -step, "left")]
                lives.append(live)
                row = starts[live] + step
                if step == 0:
                    v[live] = first[enter[row]] + e[row]
                else:
                    s = v[live][:, :, None] + np.where(new[row, None, None], m.turn[None], m.line[None])
                    back[row] = s.argmax(1)
                    v[live] = s.max(1) + e[row]
            role = np.zeros(t.num_rows, np.int32)
            role[starts + size - 1] = leave[starts]
            for step in range(steps - 1, 0, -1):
                row = starts[lives[step]] + step
                role[row - 1] = back[row, role[row]]
            mid = t.column("mid").to_numpy()
            head = new.copy()
            head[1:] |= role[1:] != role[:-1]
            # number of the turn inside its message
            count = np.cumsum(head)
            begin = np.ones(len(mid), bool)
            begin[1:] = mid[1:] != mid[:-1]
            segment = count - count[np.maximum.accumulate(np.where(begin, np.arange(len(mid)), 0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(mid), t.column("pos").combine_chunks(), pa.array(segment.astype(np.int32)), pa.array(role)],
                ["mid", "pos", "segment", "role"])

    return run


def parse(messages: DataFrame, model: Model | None = None, *, learn: DataFrame | None = None, conv_col: str = "conv_id",
          turn_col: str = "turn", text_col: str = "text", role_col: str | None = None) -> DataFrame:
    """One row a recovered turn: conv_id, turn, segment, role, n_lines, rendered.

    ``role_col`` holds known roles, used only to train when no ``model`` is
    given (on the conversations whose ``conv_id`` is in ``learn``, or all).
    """
    spark = messages.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts, lines = lines_of(messages, conv_col, turn_col, text_col, role_col)
    if model is None:
        keys = None if learn is None else learn.select(F.concat(F.lit("c"), F.col(conv_col).cast("string")).alias("key"))
        model = train(lines, keys)
    shared = spark.sparkContext.broadcast(model)
    lines = lines.drop("known")
    best = (lines.repartition(parts, "key", "chunk").sortWithinPartitions(*_ORDER)
            .transform(map_arrow, _matrices(shared), "key string, chunk long, best binary"))
    borders = (best.repartition(parts, "key").sortWithinPartitions("key", "chunk")
               .transform(map_arrow, _chain, "key string, chunk long, enter int, leave int"))
    roles = (lines.join(cut(borders, "borders"), ["key", "chunk"]).repartition(parts, "key", "chunk")
             .sortWithinPartitions(*_ORDER)
             .transform(map_arrow, _decode(shared), "mid long, pos int, segment int, role int"))
    own = texts.select("mid", "conv_id", "turn", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    plain = F.replace(F.regexp_replace("line", MARKER, ""), F.lit("<|im_"), F.lit("<| im_"))
    shown = F.when(marker_role(F.col("line")) > 0, plain).otherwise(F.replace("line", F.lit("<|im_"), F.lit("<| im_")))
    turns = (own.withColumn("shown", shown).join(roles, ["mid", "pos"]).groupBy("mid", "segment")
             .agg(F.first("conv_id").alias("conv_id"), F.first("turn").alias("turn"), F.min("role").alias("role"),
                  F.count(F.lit(1)).alias("n_lines"),
                  F.array_sort(F.collect_list(F.struct("pos", "shown"))).alias("body")))
    name = F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.col("role") + 1)
    return turns.select("conv_id", "turn", "segment", name.alias("role"), "n_lines",
                        F.concat(F.lit("<|im_start|>"), name, F.lit("\n"),
                                 F.trim(F.array_join("body.shown", "\n")), F.lit("<|im_end|>")).alias("rendered"))
