"""The toxicity network: gradients, windows, scores by loops, and held-out accuracy."""
import math
import random
import zlib

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from faultline.llm import queries, toxicity  # noqa: E402

SF = "/root/testdata/sf0.001"


def made(seed, n, share=0.3):
    """Texts of invented words; toxic ones hold a few words of two stems."""
    rng = random.Random(seed)
    syllables = ["ta", "ro", "mi", "len", "sor", "ud", "ek", "va", "ny"]
    out = []
    for i in range(n):
        toxic = int(rng.random() < share)
        words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(20, 150))]
        if toxic:
            for _ in range(rng.randint(2, 6)):
                words[rng.randrange(len(words))] = rng.choice(["zapf", "grib"]) + rng.choice(["", "on", "ix"]) + rng.choice(["", ".", "!"])
        out.append((i, " ".join(words).capitalize(), toxic))
    return out


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in toxicity.initial(5).items()}
    words, rows = [b"", b"abc", b"defgh", b"hello", b"x"], np.array([0, 1, 2, 0, 4])
    tokens = np.zeros((3, toxicity.WINDOW), int)
    tokens[0, :5], tokens[1] = [1, 2, 3, 4, 1], rng.integers(1, 5, toxicity.WINDOW)      # the third one is all padding
    y = np.array([1, 0, 1.0])
    _, grads = toxicity.train_step(p, words, rows, tokens, y)
    for k, a in p.items():
        for _ in range(3):
            at = tuple(rng.integers(s) for s in a.shape)
            if k == "bytes":
                at = (ord("l"), at[1])
            old, d = a[at], 1e-3
            a[at] = old + d
            up = toxicity.train_step(p, words, rows, tokens, y)[0]
            a[at] = old - d
            down = toxicity.train_step(p, words, rows, tokens, y)[0]
            a[at] = old
            assert grads[k][at] == pytest.approx((up - down) / 2 / d, rel=5e-3, abs=2e-6), k


def test_windows_cover_whole_texts():
    for n in (0, 1, 23, 24, 25, 36, 37, 1000, 1001):
        starts = toxicity.window_starts(n).tolist()
        assert starts[0] == 0 and (n <= 24 and starts == [0] or starts[-1] == n - 24)
        assert all(0 < b - a <= 12 for a, b in zip(starts, starts[1:]))
    long = "x" * 100 + " Straße,ÄB " + "é" * 20
    got = toxicity.pieces(long)
    assert b"".join(got).decode() == ("x" * 100 + "straßeäb" + "é" * 20) and max(map(len, got)) == 16
    assert toxicity.pieces(None) == toxicity.pieces(" .,!\n") == []


def loops(p, vocabulary, text):
    """The highest window logit, unit by unit."""
    def sig(x):
        return 1 / (1 + math.exp(-x))

    def read(inputs, u):
        h, out = [0.0] * len(u), []
        n = len(u)
        for x in inputs:
            g = [sum(h[i] * u[i][j] for i in range(n)) for j in range(3 * n)]
            z = [sig(x[j] + g[j]) for j in range(n)]
            r = [sig(x[n + j] + g[n + j]) for j in range(n)]
            c = [math.tanh(x[2 * n + j] + r[j] * g[2 * n + j]) for j in range(n)]
            h = [c[j] + z[j] * (h[j] - c[j]) for j in range(n)]
            out.append(h)
        return out

    def layer(name, inputs, there):
        half = len(inputs[0]) // 2
        f = read([x[:half] for x in inputs], p[name + "_uf"].tolist())
        b = read([x[half:] for x in inputs[::-1]], p[name + "_ub"].tolist())[::-1]
        states = [x + y for x, y in zip(f, b)]
        e = [math.exp(float(np.dot(s, p[name + "_v"]))) if t else 0.0 for s, t in zip(states, there)]
        return [sum(w * s[j] for w, s in zip(e, states)) / sum(e) for j in range(len(states[0]))]

    def piece(w):
        chars = [0.0] * (2 * toxicity.CHAR_STATE)
        if w:
            padded = w + b"\0" * (-len(w) % 4)
            chars = layer("c", [(p["bytes"][c] @ p["c_w"] + p["c_b"]).tolist() for c in padded], [c > 0 for c in padded])
        return (np.array([*p["words"][vocabulary.get(w, 0)].tolist(), *chars]) @ p["w_w"] + p["w_b"]).tolist()

    words, best = toxicity.pieces(text), -math.inf
    for s in ([0] if len(words) <= 24 else [*range(0, len(words) - 24, 12), len(words) - 24]):
        window = words[s:s + 24] + [b""] * (24 - len(words[s:s + 24]))
        there = [bool(w) for w in window]
        there[0] = there[0] or not any(there)
        best = max(best, float(np.dot(layer("w", [piece(w) for w in window], there), p["out"]) + p["bias"][0]))
    return best


def test_scores_are_those_of_loops(monkeypatch):
    rows = made(2, 40)
    p, vocabulary = toxicity.train([toxicity._sampled(t, 10, i) for i, t, _ in rows], [y for *_, y in rows], rounds=2, steps=10)
    texts = [t for _, t, _ in rows[:4]] + [None, "", "hello", "x" * 90]
    want = [loops(p, vocabulary, t) for t in texts]
    got = toxicity.Scorer(p, vocabulary).highest(texts)
    assert [g[0] for g in got] == pytest.approx(want, abs=1e-4)
    monkeypatch.setattr(toxicity, "BLOCK", 3)                       # long texts in several blocks, and a full memory
    got = toxicity.Scorer(p, vocabulary, keep=20).highest(texts)
    assert [g[0] for g in got] == pytest.approx(want, abs=1e-4)
    assert [g[2] for g in got] == [len(toxicity.window_starts(len(toxicity.pieces(t)))) for t in texts]


def test_held_out_accuracy_and_cases(spark):
    rows = made(1, 900)
    held = {i for i, *_ in rows if i % 5 == 0}
    docs = [(i, t, "old") for i, t, _ in rows] + [(7, "zapf " * 40, "old")] * 50 + [(None, None, "old"), (2000, "", "old"), (2001, "? !", "old")]
    docs = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = [(i, y) for i, _, y in rows if i not in held] + [(3, None), (4, 2), (None, 1), (5000, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, rounds=5)
    got = toxicity.assess(docs, model)
    assert got.columns == ["doc_id", "text", "score", "windows"]
    got = got.collect()
    assert len(got) == 953 and all(0 <= r.score <= 1 and r.windows >= 1 for r in got)
    score = {r.doc_id: r.score for r in got}
    truth = {i: y for i, _, y in rows if i in held and i != 7}
    assert np.mean([(score[i] >= 0.5) == bool(y) for i, y in truth.items()]) > 0.95
    assert len({score[i] for i in (None, 2000, 2001)}) == 1 and score[None] < 0.5
    assert toxicity.assess(docs.limit(0), model).count() == 0
    nothing = toxicity.assess(docs, toxicity.fit(docs, labels.filter("toxic = 0")))
    assert {r.score for r in nothing.collect()} == {0.0}


def test_an_id_of_many_rows_is_one_training_text(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda windows, labels, rounds: seen.append(len(windows)) or (toxicity.initial(1), {}))
    docs = spark.range(20_000).selectExpr("case when id < 19000 then 1 else id end as doc_id", "concat('word ', id) as text")
    labels = spark.range(40).selectExpr("case when id = 0 then 1 else 19000 + id end as doc_id", "cast(id % 2 as int) as toxic")
    toxicity.fit(docs, labels)
    assert seen and seen[0] <= 40


def test_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op12_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)
