"""Search, language model, near-duplicates, secrets, mixing and the pipeline against brute force."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from faultline.llm import credentials, hamming, mixture, ppm, queries, simhash  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower() if (text or "").isascii() else re.sub(
        "[A-Z]", lambda m: m.group().lower(), text or "").encode())


# ------------------------------------------------------------------------------ search
def brute_nearest(rows, k):
    code = {}
    widths = Counter(len(v) for i, v in rows if i is not None and v is not None)
    width = min(widths, key=lambda w: (-widths[w], w))
    for i, v in rows:
        if i is not None and v is not None and len(v) == width:
            code[i] = np.array([x is not None and x > 0 for x in v])
    out = set()
    for q in code:
        if q % 100 == 0:
            near = sorted((int((code[q] != code[i]).sum()), i) for i in code if i != q)[:k]
            out |= {(q, n + 1, i, d) for n, (d, i) in enumerate(near)}
    return out


@pytest.mark.parametrize("segment_bits", [8, 16])
def test_nearest(spark, segment_bits):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 64))
    rows = [(i, (base[i % 40] + 0.3 * rng.normal(size=64)).tolist()) for i in range(390)]
    rows += [(1000 + i, base[0].tolist()) for i in range(60)] + [(0, rows[0][1])]       # many equal codes, a repeated row
    rows += [(None, base[1].tolist()), (2000, None), (2001, [1.0] * 10), (2100, [None] + base[2].tolist()[1:])]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, code string")
    got = {(r.query_id, r.rank, r.id, r.distance) for r in
           hamming.nearest(vectors, lambda i: i % 100 == 0, k=7, segment_bits=segment_bits).collect()}
    assert got == brute_nearest(rows, 7)


def test_nearest_of_several_widths(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)] + [(900, [1.0] * 17), (901, [1.0] * 8), (902, [])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.warns(UserWarning, match="3 vectors"):
        got = {tuple(r) for r in hamming.nearest(vectors, lambda i: i % 100 == 0, k=5, segment_bits=8).collect()}
    assert len(got) == 15 and got == brute_nearest(rows, 5)
    with pytest.warns(UserWarning, match="302 vectors"):
        assert hamming.nearest(vectors, lambda i: i % 100 == 0, k=5, segment_bits=8, width=17).count() == 0


def test_nearest_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert hamming.nearest(spark.createDataFrame([], schema), lambda i: i % 100 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, -1.0]), (5, [1.0, 1.0])], schema)
    assert [tuple(r) for r in hamming.nearest(two, lambda i: i % 100 == 0).collect()] == [(0, 1, 5, 1)]


# ------------------------------------------------------------------------------ language model
def brute_scores(rows, order=ppm.ORDER):
    def tokens(text):
        return [*words(text), b""]

    count = Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            count.update(tokens(t))
    trie = defaultdict(Counter)
    for w, c in count.items():
        s = b" " + w + b" "
        for i in range(1, len(s)):
            for k in range(min(order, i) + 1):
                trie[s[i - k:i]][s[i]] += c

    def symbol(context, x):
        out, known = 0.0, set()
        while context not in trie and context:
            context = context[1:]
        while True:
            left = {a: n for a, n in trie.get(context, {}).items() if a not in known}
            total = 2 * sum(left.values())
            if x in left:
                return out + math.log10((2 * left[x] - 1) / total)
            if left:
                out += math.log10(len(left) / total)
            known |= set(left)
            if not context:
                return out - math.log10(256 - len(known))
            context = context[1:]

    def token(w):
        s = b" " + w + b" "
        return sum(symbol(s[max(0, i - order):i], s[i]) for i in range(1, len(s)))

    def adaptive(ws, top):
        seen, out = [defaultdict(Counter) for _ in range(top + 1)], 0.0
        for t, w in enumerate(ws):
            for k in range(min(top, t), -1, -1):
                have = seen[k][tuple(ws[t - k:t])]
                if have:
                    total = sum(have.values()) + len(have)
                    if w in have:
                        out += math.log10(have[w] / total)
                        break
                    out += math.log10(len(have) / total)
            else:
                out += token(w)
            for k in range(min(top, t) + 1):
                seen[k][tuple(ws[t - k:t])][w] += 1
        return out
    n, v, out = sum(count.values()), len(count), []
    for i, t in rows:
        ws = tokens(t)
        three = [sum(map(token, ws)), adaptive(ws, 0), adaptive(ws, 1)]
        best = max(three)
        out.append((-1 if i is None else i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2, len(ws),
                    sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws),
                    best + math.log10(sum(10 ** (x - best) for x in three) / 3)))
    return sorted(out)


def same_scores(got, expected):
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5:] for g in got], [e[5:] for e in expected], rtol=1e-9, atol=1e-6)


def test_scores_are_those_of_the_model(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    same_scores(queries.op3_ppm_scores(spark, SF).collect(), brute_scores(rows))


def test_score_cases(spark):
    rows = [(i, " ".join(f"w{(i * j) % 13}" for j in range(i % 9))) for i in range(40)]
    rows += [(7, None), (7, None), (None, "a a A b"), (50, "x" * 3000), (51, "again " * 700), (52, " é\n\t")]
    table = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    same_scores(ppm.score(table).collect(), brute_scores(rows))
    assert ppm.score(table.limit(0)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = [(held, "ab")]                              # nothing to learn from
    same_scores(ppm.score(spark.createDataFrame(only, "doc_id long, text string")).collect(), brute_scores(only))


def test_rare_contexts_of_a_large_corpus_are_kept(spark):
    # over 2^22 training symbols; the rare words occur once each
    train, held = ([i for i in range(100) if (zlib.crc32(str(i).encode()) % 7 == 2) == h][:2] for h in (False, True))
    rows = [(train[0], " ".join(["x" * 3000] * 1600)), (train[1], "quartz jackdaw"), (held[0], "quartz jackdaw quarter")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    same_scores(ppm.score(table).collect(), brute_scores(rows))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_shorter_orders(spark, docs, order):
    rows = [(r.doc_id, r.text) for r in docs.limit(200).collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    same_scores(ppm.score(table, order=order).collect(), brute_scores(rows, order))


def test_model_predicts_held_out_text(spark):
    got = [r for r in queries.op3_ppm_scores(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    nats = -sum(r.score for r in got) / sum(r.n_tokens for r in got)
    assert nats < 4.4                                  # digits a token; 256 equal bytes would take over 12


# ------------------------------------------------------------------------------ near-duplicates
def brute_components(rows, max_bits=simhash.MAX_BITS):
    import xxhash
    fps = []
    for _, t in rows:
        w = words(t)
        grams = [b" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    f = np.array(fps, np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in zip(*np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= max_bits)):
        root[find(a)] = find(b)
    groups = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[find(k)].append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return [(i, fps[k], least[find(k)]) for k, (i, _) in enumerate(rows)], len(groups)


def key(row):
    return tuple(-1 if x is None else x for x in row)


def test_components(spark, docs):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = [(r.doc_id, int(r.fingerprint, 16), r.component_id) for r in queries.op4_simhash_components(spark, "/root/testdata/sf0.01").collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute_components(rows)[0]))


def test_component_cases(spark):
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in rng.integers(0, 500, 300)]
    rows = [(100 + i, " ".join(base[:k] + [f"new{i}"] + base[k + 1:])) for i, k in enumerate(rng.integers(0, 300, 60))]
    rows += [(7, None), (3, ""), (5, " \n"), (None, "one two"), (None, "one two"), (9, "a b c"), (9, "a b c"), (9, "other text of nine"),
             (None, " ".join(base)), (400, "x" * 200000)]
    table = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, root int, fp string")
    expected, groups = brute_components(rows)
    got = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in simhash.labelled(table).collect()]
    assert sorted(map(key, got)) == sorted(map(key, expected))
    kept = simhash.deduplicate(table)
    assert kept.columns == table.columns
    kept = kept.collect()
    ids = [r.doc_id for r in kept]
    assert len(ids) == groups                          # one row a component, also of an id with several
    assert {i for i in ids if i is not None} == {c for _, _, c in expected if c is not None}
    assert sum(i is None for i in ids) == 1
    assert sorted(r.text for r in kept if r.doc_id == 9) == ["a b c", "other text of nine"]
    assert simhash.labelled(table.limit(0)).count() == 0 and simhash.deduplicate(table.limit(0)).count() == 0


@pytest.mark.parametrize("pivots", [1, 6])
def test_links_between_groups(spark, pivots):
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 1 << 62, 60)
    fps = {int(c) for c in centres}
    for c in centres:                                  # chains: each step flips up to four bits
        x = int(c)
        for _ in range(30):
            for b in rng.integers(0, 63, rng.integers(1, 5)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    table = spark.createDataFrame([(x,) for x in fps], "fp long")
    stars = simhash.components(simhash.star_links(table, pivots=pivots))
    grouped = table.join(stars, table.fp == stars.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))
    edges = simhash.star_links(table, pivots=pivots).unionByName(simhash.cross_links(grouped))
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    f = np.array(fps, np.uint64)
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in zip(*np.nonzero(np.bitwise_count(f[:, None] ^ f[None, :]) <= 4)):
        a, b = sorted((find(fps[a]), find(fps[b])))
        root[b] = a
    assert {x: got.get(x, x) for x in fps} == {x: find(x) for x in fps}


# ------------------------------------------------------------------------------ secrets
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute_base(text):
    text, out = text or "", []
    for rank, kind, pattern, least, group in ((0, "assign", ASSIGN, 6, 2), (1, "access", re.compile("AKIA[A-Z0-9]+"), 20, 0),
                                              (2, "hex", re.compile("[0-9a-f]+"), 24, 0)):
        out += [(m.start(), rank, kind, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(out)]


def check_base(r, text):
    spans = brute_base(text)
    assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")), text
    assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert set(spans) <= set(r.spans.split(",")) | {""}


def test_base_spans(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op9_credential_linking(spark, "/root/testdata/sf0.01").collect()}
    for r in rows:
        check_base(got[r.doc_id], r.text)


def test_span_cases(spark, tmp_path):
    secret = "deadbeef" * 4
    texts = ["", None, "secret=token:abcdefg", "TOKEN : \"abcdef", "token=abc", f"é🎉 {secret} {secret}x", "AKIA" + "A" * 16 + " AKIAB",
             "password=" + secret, "api_key='A+/_.=-b' apikey=x1y2z3 passwd  =  q", "token=password=abcdefgh",
             "host=db.example.com user_name=bob password=hunter22", "see http://example.com/page for the user_name=bob",
             "see 10.0.0.1", "10.0.0.1 " + "x " * 300 + "password=hunter22", "client_id=abc Zx9Kq2Lm8Np4Rt6Vw0Yb3c",
             "Zx9Kq2Lm8Np4Rt6Vw0Yb3c alone", ("password=hunter22 " * 3000), "key " + "f" * 30000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "token=abcdef12"), (3, texts[3])]
    spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kind string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op9_credential_linking(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        check_base(by[i], t)
    kinds = {i: [s.split(":")[0] for s in by[i].spans.split(",") if s] for i in range(len(texts))}
    assert kinds[10] == ["endpoint", "ident", "assign"]  # the complementary part is there
    assert kinds[11] == kinds[12] == [] and kinds[13] == ["assign"] and kinds[15] == []
    assert kinds[14] == ["ident", "blob"]
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    clean = {r.doc_id: r for r in credentials.redact(credentials.scan(table)).collect()}
    assert clean[10].text == "[SECRET] [SECRET] [SECRET]" and clean[11].text == texts[11] and clean[1].text is None
    assert clean[7].text == "[SECRET]" and clean[5].text == "é🎉 [SECRET] [SECRET]x"
    assert credentials.scan(table.limit(0)).count() == 0
    assert credentials.scan(table).columns == [*table.columns, "sec_spans"]


def test_scan_runs_no_python(spark, docs):
    plan = credentials.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# ------------------------------------------------------------------------------ mixing
def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, list(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def check_mix(rows, got):
    sizes = defaultdict(int)
    for _, source, text in rows:
        sizes[source] += len(words(text))
    target, taken, largest = brute_targets(sizes), defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, target[r.source], rel_tol=1e-9, abs_tol=1e-6)
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6
    return sum(taken.values()), 1.5 * sum(sizes.values())


def mixed(table):
    return mixture.mix(table).withColumnsRenamed({"mix_size": "size", "mix_source_size": "source_size", "mix_target": "target"}).withColumn(
        "taken", F.col("mix_copies") * F.col("size"))


def test_mix(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixed(docs)
    taken, wanted = check_mix([(r.doc_id, r.source, r.text) for r in docs.collect()], got.collect())
    assert abs(taken - wanted) < 0.02 * wanted
    again = {(r.doc_id, r.taken) for r in mixed(docs.repartition(7)).collect()}
    assert {(r.doc_id, r.taken) for r in got.collect()} == again


def test_mix_cases(spark):
    rows = [(1, "a", "x y z"), (1, "a", "x y z"), (2, None, "w " * 500), (3, "b", None), (4, "b", ""), (None, "é", "q r"),
            (5, "é", "s"), (6, "", "t " * 90000)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, source string, text string, w int, target string")
    got = mixture.mix(table)
    assert got.columns[:5] == table.columns
    check_mix(rows, mixed(table.drop("target")).collect())
    assert mixture.mix(table.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, "a", None)], "doc_id long, source string, text string")
    assert [(r.mix_target, r.mix_copies) for r in mixture.mix(nothing).collect()] == [(0.0, 0)]


def test_meetings_keep_words_and_expectations():
    rng = np.random.default_rng(3)
    for _ in range(500):
        a, b, s, t = *rng.uniform(0.01, 0.99, 2), *rng.integers(1, 50, 2).tolist()
        x, y = mixture._meet(a, b, s, t, rng.random())
        assert math.isclose(a * s + b * t, x * s + y * t, rel_tol=1e-6)
        assert x in (0.0, 1.0) or y in (0.0, 1.0)
    draws = np.array([mixture._meet(0.3, 0.6, 4, 7, u) for u in rng.random(20000)])
    assert np.allclose(draws.mean(axis=0), [0.3, 0.6], atol=0.015)


# ------------------------------------------------------------------------------ pipeline
def test_pipeline(spark, docs):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from faultline.llm.common import saved
    now, before = docs, {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        after = saved(stage(spark, now, SF), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        rows = after.collect()
        ids = [r.doc_id for r in rows]
        assert set(ids) <= set(before)
        if name == "quality_rules":
            verdict = {r.doc_id: r.kept for r in queries.op7_quality_rules(spark, SF).collect()}
            assert set(ids) == {i for i, kept in verdict.items() if kept}
        if name == "simhash_near_dedup":
            kept = [(i, r.text) for i, r in before.items()]
            assert sorted(ids) == sorted({c for _, _, c in brute_components(kept)[0]})
        if name == "secret_scan":
            assert len(ids) == len(before) and not any(brute_base(r.text) for r in rows)
        if name == "mixing":
            assert max(Counter(ids).values()) <= 2
        now, before = after, {r.doc_id: r for r in rows}
    assert now.count() == len(ids) and all(r.n_tokens == len(r.ids) for r in now.collect())
