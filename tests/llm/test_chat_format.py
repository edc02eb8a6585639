import itertools

import numpy as np

from mercato.llm import chat_format as cf


def conversations(n=120):
    rows = []
    for c in range(n):
        turn = 0
        if c % 4 == 0:
            rows.append((c, turn, "system", "You are a careful helper."))
            turn += 1
        for k in range(2 + c % 5):
            user = k % 2 == 0
            rows.append((c, turn, "user" if user else "assistant",
                         f"what is number {k}?" if user else "It is a long answer. " * (5 + c % 7) + "\n- a point\n- another."))
            turn += 1
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows],
                                 "conv_id long, turn long, role string, text string, key string, mid string")


def test_roles_recovered_without_markers(spark):
    rows = conversations()
    d = frame(spark, rows)
    learn = d.filter("conv_id % 3 = 0").select("conv_id")
    got = {(r.conv_id, r.turn): r for r in cf.parse(d, learn=learn, role_col="role").collect()}
    held = [(got[(c, t)].role == role) for c, t, role, _ in rows if c % 3]
    assert np.mean(held) > 0.97 and len(got) == len(rows)
    c, t, role, text = rows[2]
    assert got[(c, t)].rendered == f"<|im_start|>{got[(c, t)].role}\n{text}<|im_end|>"


def test_markers_and_inline_turns(spark):
    d = frame(spark, conversations())
    learned = cf.train(cf.lines_of(d, "conv_id", "turn", "text", "role")[1])
    # a marker names the role nearly always
    k = np.full((3, 4), 0.001) + np.eye(3, 4, 1)
    learned.emit["f_marker"] = np.log(k / k.sum(1, keepdims=True))
    t = frame(spark, [(1, 0, None, "User: hi there?\nAssistant: It is fine.\nmore of it.\nHuman: thanks <|im_end|>"),
                      (1, 1, None, "### Assistant\nYou are welcome.")])
    got = sorted(cf.parse(t, learned).collect(), key=lambda r: (r.turn, r.segment))
    assert [(r.turn, r.segment, r.role, r.n_lines) for r in got] == [
        (0, 0, "user", 1), (0, 1, "assistant", 2), (0, 2, "user", 1), (1, 0, "assistant", 2)]
    assert got[1].rendered == "<|im_start|>assistant\nIt is fine.\nmore of it.<|im_end|>"
    assert got[2].rendered == "<|im_start|>user\nthanks <| im_end|><|im_end|>"


def best_path(m, lines):
    """Viterbi by trying every path."""
    score = {}
    for path in itertools.product(range(3), repeat=len(lines)):
        s = m.start[path[0]]
        for i, (z, (feat, new)) in enumerate(zip(path, lines, strict=True)):
            s += sum(m.emit[f][z, v] for f, v in feat.items())
            if i:
                s += (m.turn if new else m.line)[path[i - 1], z]
        score[path] = s
    return max(score, key=score.get)


def test_chunked_viterbi_is_the_best_path(spark, monkeypatch):
    monkeypatch.setattr(cf, "CHUNK", 2)  # three positions a conversation span two chunks
    rng = np.random.default_rng(0)
    log = lambda *s: np.log((x := rng.random(s) + 0.05) / x.sum(-1, keepdims=True))
    m = cf.Model(log(3), log(3, 3), log(3, 3), {f: log(3, n) for f, n in cf.FEATURES.items()})
    rows = [(c, t, None, "\n".join("x" * rng.integers(0, 40) + rng.choice(["?", ".", ""]) for _ in range(rng.integers(1, 3))))
            for c in range(12) for t in range(5)]
    d = frame(spark, rows)
    got = {}
    for r in cf.parse(d, m).collect():
        got.setdefault(r.conv_id, []).append((r.turn, r.segment, r.role, r.n_lines))
    lines = cf.lines_of(d, "conv_id", "turn", "text", None)[1].collect()
    for c in range(12):
        own = sorted((x for x in lines if x.key == f"c{c}"), key=lambda x: (x.turn, x.pos))
        path = best_path(m, [({f: x[f] for f in cf.FEATURES}, x.pos == 0) for x in own])
        mine = [role for _, _, role, n in sorted(got[c]) for _ in range(n)]
        assert mine == [cf.ROLES[z] for z in path]


def test_edges(spark):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (1, None, None, None), (2, 0, "nobody", ""), (2, 0, "user", "b")]
    out = cf.parse(frame(spark, rows), role_col="role").collect()
    assert len(out) == 5 and all(r.role in cf.ROLES for r in out)
    assert cf.parse(frame(spark, []), role_col="role").count() == 0
