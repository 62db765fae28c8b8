"""Language ID, transcripts, language model and the pipeline: held-out accuracy, gradients, brute force."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm_edge import edge, no_rows  # noqa: F401
import corpus_pipeline
from scorewright.llm import gated_lm, langid, queries, transcripts
from scorewright.llm.common import documents, fold

D, D2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def crc(i, m):
    return zlib.crc32(b"" if i is None else str(i).encode()) % m


# language ID -----------------------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    rows = queries.op5_byte_cnn_language(spark, D2).join(documents(spark, D2).select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == 1000 and all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97


def test_language_edge(edge, no_rows):
    settings = langid.Settings(steps=40, window=64)
    model = langid.fit(edge, fold("doc_id", 5) != 9, settings=settings)
    rows = langid.predict(edge, model, pred_col="kept").collect()
    assert len(rows) == edge.count() and all(r["word"] == "x" and r["_predicted"] == "x" for r in rows)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["kept"] in model.langs and r["score"] > 0) if letters else (r["kept"], r["score"]) == ("und", 0.0)
    assert langid.predict(no_rows, model).count() == 0 and langid.fit(no_rows, F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.predict(edge, None).collect()} == {"und"}


def test_network_tables_equal_the_convolution():
    s = langid.Settings(steps=3, window=32, filters=3)
    rng = np.random.default_rng(0)
    windows = rng.integers(0, 256, (20, 32)).astype(np.uint8)
    model = langid.train(windows, np.arange(20) % 2, ["a", "b"], s)
    one = {w: [t for j, span, t in bank] for w, bank in model.tables.items()}
    x = windows[0].astype(int)
    pooled = []
    for w, bank in model.tables.items():
        z = [sum(t[x[p + j] * 256 + x[p + j + 1]] if span == 2 else t[x[p + j]] for j, span, t in bank) for p in range(32 - w + 1)]
        pooled.append(np.maximum(np.max(z, axis=0), 0))
    e = np.exp(np.concatenate(pooled) @ model.weights + model.bias)
    assert np.allclose(langid.probabilities(model, windows[:1])[0], e / e.sum(), atol=1e-5) and one


def test_language_uses_the_whole_text():
    """A text whose windows are mostly of one class is of that class, wherever they stand."""
    windows = np.array([[97] * 16] * 8 + [[98] * 16] * 8, np.uint8)
    model = langid.train(windows, np.array([0] * 8 + [1] * 8), ["a", "b"], langid.Settings(window=16, steps=60))
    best, _ = langid.classify(model, [b"a" * 16 + b"b" * 160, b"b" * 16 + b"a" * 160])
    assert best.tolist() == [1, 0]


# transcripts -----------------------------------------------------------------------------------------

def true_lines(spark, path):
    """(conv_id, its lines' (role, begins)) from the labelled turns."""
    out = {}
    for r in spark.read.parquet(f"{path}/conversations.parquet").orderBy("conv_id", "turn").collect():
        out.setdefault(r["conv_id"], []).extend((r["role"], k == 0) for k in range(len(r["text"].split("\n"))))
    return out


def test_lines_held_out_accuracy(spark):
    """Role and beginning of every line of transcripts not learned from; the model sees lines only."""
    raw = queries.raw_transcripts(spark.read.parquet(f"{D2}/conversations.parquet"))
    model, truth, got = transcripts.fit(raw.filter(fold("conv_id", 5) != 0)), true_lines(spark, D2), {}
    for r in transcripts.label_lines(raw, model).orderBy("line").collect():
        got.setdefault(r["conv_id"], []).append((r["role"], r["begins"]))
    assert {c: len(x) for c, x in got.items()} == {c: len(x) for c, x in truth.items()}
    held = [(a, b) for c in truth if crc(c, 5) == 0 for a, b in zip(got[c], truth[c])]
    assert len(held) > 100 and np.mean([a[0] == b[0] for a, b in held]) > 0.95 and np.mean([a == b for a, b in held]) > 0.95


def test_transcript_query(spark):
    """Turns put together again: all lines of a transcript, in order; most turns exactly as they were said."""
    said = spark.read.parquet(f"{D2}/conversations.parquet").collect()
    rows = queries.op4_transcript_roles(spark, D2).collect()
    text = lambda some, cut: {c: "\n".join(cut(r) for r in sorted((r for r in some if r["conv_id"] == c), key=lambda r: r["turn"])) for c in {r["conv_id"] for r in some}}
    whole = {(r["conv_id"], r["role"], r["text"].strip()) for r in said}
    got = {(r["conv_id"], r["role"], r["text"].split("\n", 1)[1]) for r in rows}
    assert all(r["text"].startswith(f"<|{r['role']}|>\n") for r in rows) and len(got & whole) > 0.85 * len(whole)
    assert {c: t.split() for c, t in text(rows, lambda r: r["text"].split("\n", 1)[1]).items()} == {c: t.split() for c, t in text(said, lambda r: r["text"]).items()}


def test_where_a_transcript_is_cut_into_parts_says_nothing(spark):
    """The same lines whole, or cut at other places, give the same turns; one text holds several of them."""
    one = "User: hi\nAssistant: yo\nand more\n\nUser: ok?\nso\nAI: fine"
    model = transcripts.fit(queries.raw_transcripts(spark.read.parquet(f"{D2}/conversations.parquet")))
    lines, seen = one.split("\n"), []
    for cuts in ([], [1], [2, 3, 5], range(1, len(lines))):
        at = [0, *cuts, len(lines)]
        df = spark.createDataFrame([(7, k, "\n".join(lines[a:b])) for k, (a, b) in enumerate(zip(at, at[1:]))], "conv_id long, part long, text string").repartition(3)
        seen.append([(r["turn"], r["role"], r["text"]) for r in transcripts.recover(df, model).orderBy("turn").collect()])
    assert seen[0] == [(0, "user", "User: hi"), (1, "assistant", "Assistant: yo\nand more\n"), (2, "user", "User: ok?\nso"), (3, "assistant", "AI: fine")]
    assert all(x == seen[0] for x in seen)


def brute_viterbi(emits, step):
    scores, back = np.array(step[-1]) + emits[0], []
    for e in emits[1:]:
        options = scores[:, None] + np.array(step[:-1])
        back.append(options.argmax(axis=0))
        scores = options.max(axis=0) + e
    path = [int(scores.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1], int(scores.max())


def path_score(path, emits, step):
    return sum(step[a][b] + int(e[b]) for a, b, e in zip([len(step) - 1, *path], path, emits))


def test_chunked_viterbi_finds_a_best_path(spark, monkeypatch):
    monkeypatch.setattr(transcripts, "CHUNK", 8)
    monkeypatch.setattr(transcripts, "FAN", 3)
    conv = queries.raw_transcripts(spark.read.parquet(f"{D2}/conversations.parquet"))
    model = transcripts.fit(conv)
    long = conv.select((F.col("conv_id") % 2).alias("conv_id"), (F.col("turn") + 10 * F.col("conv_id")).alias("part"), "text")
    told = transcripts.label_lines(long, model).orderBy("line").collect()
    shown = {r["line"]: r["v"] for r in transcripts.label_lines(long, model).select("line", transcripts.shown(F.col("text")).alias("v")).collect()}
    for c in (0, 1):
        own = [r for r in told if r["conv_id"] == c]
        emits = model.lines()[[shown[r["line"]] for r in own]]
        _, best = brute_viterbi(emits, model.step)
        assert len(own) > 300 and path_score([transcripts.STATES.index((r["role"], r["begins"])) for r in own], emits, model.step) == best


def test_transcript_edge(spark):
    rows = [(1, 0, "User: hi?", "user"), (1, 0, "User: hi?", "user"), (1, None, "x", None), (None, 1, "[system] be brief", "system"), (None, None, None, None),
            (2, 5, "", "assistant"), (2, -700, "AI: " + "long text. " * 5000, "assistant"), (2, 10 ** 12, "ok\n\nUser: z\n", "other")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string, role string")
    model = transcripts.fit(df)
    parts = df.withColumnRenamed("turn", "part").withColumns({c: F.lit("x") for c in ("line", "row", "key", "begins")})
    lines = transcripts.label_lines(parts, model).collect()
    assert Counter((r["conv_id"], r["text"]) for r in lines) == Counter((i, x) for i, _, t, _ in rows for x in (t or "").split("\n"))
    got = transcripts.recover(parts, model).select("conv_id", "turn", "role", "text", transcripts.render(F.col("text"), F.col("role")).alias("out")).collect()
    assert sum(len(r["text"].split("\n")) for r in got) == len(lines) and all(r["out"].startswith(f"<|{r['role']}|>\n") for r in got)
    first = Counter(r["conv_id"] for r in got if r["turn"] == 0)
    assert first == {1: 1, 2: 1, None: 2}
    empty = df.limit(0)
    assert transcripts.recover(parts.limit(0), transcripts.fit(empty)).count() == 0 and transcripts.recover(parts, transcripts.fit(empty)).count() > 0


# language model --------------------------------------------------------------------------------------

def small_model():
    s = gated_lm.tiny()
    return s, gated_lm.Gru.start(s, gated_lm.Counts([f"w{i}" for i in range(40)], np.arange(40, 0, -1), 10, 850, 60))


def test_gradients_and_lanes():
    s, m = small_model()
    rng = np.random.default_rng(0)
    docs = [np.append(rng.integers(0, 42, rng.integers(0, 12)), 1).astype(np.int32) for _ in range(9)]
    lanes = gated_lm.Lanes(docs, 4)
    together = m.score(lanes)[lanes.place]
    alone = []
    for d in docs:
        own = gated_lm.Lanes([d], 1)
        alone.append(m.score(own)[own.place])
    assert np.allclose(together, np.concatenate(alone), atol=1e-5)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, begins, live, _ = lanes.window(0, lanes.length)
    state = np.zeros((x.shape[1], s.hidden))
    _, g, _ = m.gradients(x, begins, live, state)
    for k, v in m.p.items():
        at = tuple(rng.integers(0, n) for n in v.shape)
        ends = []
        for e in (1e-4, -1e-4):
            v[at] += e
            ends.append(m.gradients(x, begins, live, state)[0])
            v[at] -= e
        assert abs((ends[0] - ends[1]) / 2e-4 - g[k][at]) < 1e-5


def test_work_arrays_are_reused_and_results_outlive_them():
    """Windows of other widths use the same memory; what a call returned is not written over by the next."""
    known, s = gated_lm.Counts([f"w{i}" for i in range(30)], np.arange(30, 0, -1), 5, 470, 31), gated_lm.tiny()
    docs = [np.append(np.arange(2, 2 + n, dtype=np.int32), np.int32(1)) for n in (25, 3, 14, 1, 9)]
    lanes, model = gated_lm.Lanes(docs, 4), gated_lm.Gru.start(s, known)
    told, state = [], np.zeros((len(lanes.used), s.hidden), np.float32)
    for a in range(0, lanes.length, s.train_window):
        x, begins, live, _ = lanes.window(a, a + s.train_window)
        loss, g, after = model.gradients(x, begins, live, state[:x.shape[1]])
        fresh = gated_lm.Gru.start(s, known).gradients(x, begins, live, state[:x.shape[1]])
        told.append((g, after, *fresh[1:]))
        assert loss == fresh[0] and "gx" in model.kept
        state = after
    assert len(told) > 2
    for g, after, other, other_after in told:
        assert np.array_equal(after, other_after) and all(np.array_equal(g[k], other[k]) for k in g)
    first = model.score(lanes)
    assert np.array_equal(first, gated_lm.Gru.start(s, known).score(lanes)) and np.array_equal(first, model.score(lanes))


def test_probabilities_sum_to_one():
    s, m = small_model()
    h = np.random.default_rng(1).normal(size=(1, s.hidden)).astype(np.float32)
    n = s.classes * s.members
    assert abs(np.exp(m.log_probability(np.repeat(h, n, 0), np.arange(n))).sum() - 1) < 1e-4


def check_counts(rows, got, modulus=7, out=2):
    tok = lambda t: [*(t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split(), None]
    c = Counter()
    for i, t in rows:
        if crc(i, modulus) != out:
            c.update(tok(t))
    n, v = sum(c.values()), len(c)
    expected = Counter((i, len(tok(t)), sum(c[w] > 0 for w in tok(t)), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(t)), 5)) for i, t in rows)
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == expected


def test_lm_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, D2).collect()]
    got = queries.op2_gated_lm(spark, D2).collect()
    check_counts(rows, got)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in rows if crc(i, 7) == 2}
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)      # better than the counts on texts not learned from


def test_lm_trains_on_every_training_document_once(spark, monkeypatch):
    train = documents(spark, D2).filter(fold("doc_id", 7) != 2).select("text", F.xxhash64(F.col("doc_id").cast("string")).alias("tie"))
    average, learned = gated_lm._average, []

    def counted(parts):
        learned.append(parts.filter("i = 0").agg(F.sum("w")).first()[0])
        return average(parts)

    monkeypatch.setattr(gated_lm, "_average", counted)
    s = gated_lm.tiny(replica_tokens=100_000, lanes=64, train_window=32)
    known = gated_lm.head_of(gated_lm.count_words(train.select("text"), s), s)
    gated_lm.fit(train, known, s)
    assert learned == [known.total]


def test_lm_score_word_by_word(spark, edge, monkeypatch):
    """Every score recomputed token by token in plain loops from the fitted parameters and the counts."""
    fit, kept = gated_lm.fit, []

    def watched(texts, known, s):
        kept[:] = [fit(texts, known, s), known]
        return kept[0]

    monkeypatch.setattr(gated_lm, "fit", watched)
    s = gated_lm.tiny(head=30, classes=4, members=4)
    rows = Counter((r["doc_id"], r["text"]) for r in edge.collect() if len(r["text"] or "") < 5000)
    df = spark.createDataFrame([k for k, n in rows.items() for _ in range(n)], "doc_id long, text string")
    got = gated_lm.score(df, fold("doc_id", 7) != 2, settings=s).collect()
    net, known = kept
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    tok = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    count = Counter(w for (i, t), n in rows.items() if crc(i, 7) != 2 for w in tok(t) for _ in range(n))
    modelled = {w.encode(): k + 2 for k, w in enumerate(known.words[:s.classes * s.members - 2])}
    rest = {w: c for w, c in count.items() if w not in modelled}
    sig, h = (lambda z: 1 / (1 + np.exp(-z))), s.hidden

    def by_hand(t):
        state, total = np.zeros(h), 0.0
        for w in [*tok(t), None]:
            y = gated_lm.END if w is None else modelled.get(w, gated_lm.UNKNOWN)
            zc = state @ p["C"] + p["cb"]
            zm = p["O"][y // s.members] @ state + p["ob"][y // s.members]
            total += zc[y // s.members] - np.log(np.exp(zc).sum()) + zm[y % s.members] - np.log(np.exp(zm).sum())
            if y == gated_lm.UNKNOWN:
                total += math.log((count[w] + 1) / (sum(rest.values()) + len(rest) + 1))
            g = p["E"][y] @ p["Wx"] + p["b"]
            gate = sig(g[:2 * h] + state @ p["Uzr"])
            cand = np.tanh(g[2 * h:] + (gate[h:] * state) @ p["Uh"])
            state = cand + gate[:h] * (state - cand)
        return total / math.log(10)

    texts = {i: [t for j, t in rows if j == i] for i, _ in rows}
    assert len(got) == sum(rows.values())
    for r in got:
        assert min(abs(by_hand(t) - r["score"]) for t in texts[r["doc_id"]]) < 1e-3


def test_lanes_of_a_long_text_among_short_ones():
    """Memory follows the tokens: a dense (time, lane) grid of these would hold 77 million cells."""
    import tracemalloc

    s, m = small_model()
    s = gated_lm.replace(s, lanes=256, score_lanes=256, score_window=64, train_window=32)
    m = gated_lm.Gru(s, m.p)
    docs = [np.ones(30_000, np.int32)] + [np.ones(20, np.int32)] * 300
    tracemalloc.start()
    lanes = gated_lm.Lanes(docs, 256)
    out = m.score(lanes)[lanes.place]
    gated_lm.Gru(s, m.p).train(docs[:1] + docs[-20:])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 36_000 and peak < 12 << 20


def test_average_of_many_large_replicas(spark):
    """Sums far beyond 64 bits: as many tokens as a few TB of text hold, with large parameters."""
    weights = [10 ** 11, 3 * 10 ** 11, 10 ** 12]
    rows = [(i, int(round(v * gated_lm.FIXED)) * w, w) for w, vs in zip(weights, ((30.0, -2.0), (20.0, 1.0), (-1.0, 7.5))) for i, v in enumerate(vs)]
    df = spark.createDataFrame([(i, str(v), w) for i, v, w in rows], "i int, v string, w long").select("i", F.col("v").cast("decimal(38,0)").alias("v"), "w")
    want = [(30 + 60 - 10) / 14, (-2 + 3 + 75) / 14]
    assert np.allclose(gated_lm._average(df), want, rtol=1e-9)


def test_lm_edge_with_most_words_outside_the_head(edge, no_rows):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = gated_lm.score(edge, fold("doc_id", 7) != 2, settings=gated_lm.tiny(head=3, group_bytes=500)).collect()
    check_counts(rows, got)
    assert all(r["score"] < 0 for r in got)
    assert gated_lm.score(no_rows, F.lit(True), settings=gated_lm.tiny()).count() == 0
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in gated_lm.score(edge, F.lit(False), settings=gated_lm.tiny()).collect())


# pipeline --------------------------------------------------------------------------------------------

def run_stages(spark, docs, path):
    """As the contract runs them: each result written, then read again."""
    out = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        at = f"{path}/{k}-{name}"
        stage(spark, docs, D).write.parquet(at)
        docs = spark.read.parquet(at)
        out.append(docs)
    return out


def test_pipeline_stages(spark, tmp_dir):
    from test_llm_dedup import brute_components, brute_fingerprint
    from test_llm_text import brute_spans, check_packing

    docs = documents(spark, D)
    lang, exact, near, secret, packed = run_stages(spark, docs, tmp_dir)
    assert all(df.columns == docs.columns for df in (lang, exact, near, secret))
    first = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = [r["doc_id"] for r in lang.collect()]
    assert sorted(kept) == sorted(i for i, t in first.items() if any(map(str.isalpha, t or "")))
    top = {}
    for i in kept:
        top[first[i]] = max(i, top.get(first[i], i))
    assert sorted(r["doc_id"] for r in exact.collect()) == sorted(top.values())
    ids = sorted(top.values())
    assert sorted(r["doc_id"] for r in near.collect()) == sorted(set(brute_components([brute_fingerprint(first[i]) for i in ids], ids)))
    for r in secret.collect():
        if not brute_spans(first[r["doc_id"]]):
            assert r["text"] == first[r["doc_id"]]
        else:
            assert not brute_spans(r["text"]) and r["text"] != first[r["doc_id"]]
    pieces = packed.collect()
    again = corpus_pipeline.run(spark, D).collect()
    key = lambda r: tuple(r)
    assert sorted(map(key, again)) == sorted(map(key, pieces))
    from scorewright.llm import packing

    check_packing([(r["doc_id"], r["text"]) for r in secret.collect()], packing.pack(secret, with_ids=True).collect())


def test_language_stage_keeps_what_has_letters(spark):
    """Texts that mix languages or hold code stay, and without a labelled row to learn from all lettered ones do."""
    rows = [(i, t, g) for i, (t, g) in enumerate([("der Hund the dog le chien el perro " * 30, None), ("for (int i = 0; i < n; i++) { x[i] += 1; }", None),
                                                   ("12 34 !!", "en"), ("", "en"), (None, "de"), ("Ω", None)])]
    stage = dict(corpus_pipeline.STAGES)["language_id"]
    none = spark.createDataFrame([(i, t, None) for i, t, _ in rows], "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in stage(spark, none, D).collect()) == [0, 1, 5]
    some = documents(spark, D).select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(i + 10 ** 6, t, g) for i, t, g in rows], "doc_id long, text string, lang string"))
    assert sorted(r["doc_id"] - 10 ** 6 for r in stage(spark, some, D).filter("doc_id >= 1000000").collect()) == [0, 1, 5]


def test_pipeline_edge_and_empty(spark, edge, tmp_dir):
    stages = run_stages(spark, edge, f"{tmp_dir}/edge")
    assert [df.columns for df in stages[:4]] == [edge.columns] * 4
    texts = [r["text"] for r in stages[1].collect()]
    assert len(texts) == len(set(texts)) and stages[4].agg(F.sum("length")).first()[0] > 0
    assert [df.count() for df in run_stages(spark, edge.limit(0), f"{tmp_dir}/none")] == [0] * 5


def test_words_are_looked_up_as_they_stand():
    """Training needs the modelled words alone; the words of the head beyond them are the unknown word either way."""
    s = gated_lm.tiny()
    words = [f"w{i}" for i in range(100)]
    known = gated_lm.Counts(words, np.arange(200, 100, -1), 3, 20_000, 101)
    modelled = s.classes * s.members - 2
    whole = gated_lm.Lexicon(known, s)
    few = gated_lm.Lexicon(gated_lm.replace(known, words=words[:modelled], counts=known.counts[:modelled]), s)
    texts = gated_lm.pa.array(["W0 w99  nowhere w61", None, "w62\tw1"])
    (size, rank, flat), (size2, rank2, _) = whole.read(texts), few.read(texts)
    assert flat.to_pylist() == ["w0", "w99", "nowhere", "w61", "w62", "w1"] and size.tolist() == size2.tolist() == [4, 0, 2]
    assert rank.tolist() == [0, 99, 100, 61, 62, 1]
    assert [d.tolist() for d in whole.documents(size, rank)] == [d.tolist() for d in few.documents(size2, rank2)] == [[2, 0, 0, 63, 1], [1], [0, 3, 1]]


def test_tokens_lie_by_class_in_whole_blocks():
    s, m = small_model()
    k = np.array([3, 1, 3, 3, 0, 3, 3])
    token, place, left, classes = m._by_class(k, 4)
    assert classes == [(0, 0, 4), (1, 4, 8), (3, 8, 16)] and token[place].tolist() == list(range(7))
    assert token[8:13].tolist() == [0, 2, 3, 5, 6] and left.tolist() == [1, 2, 3, 5, 6, 7, 13, 14, 15]
    assert m._by_class(k)[2].tolist() == [] and m._by_class(k)[3] == [(0, 0, 1), (1, 1, 2), (3, 2, 7)]


def test_sums_are_plain_only_where_no_state_can_leave_their_range():
    s, m = small_model()
    rng = np.random.default_rng(5)
    states, y = rng.uniform(-1, 1, (200, s.hidden)).astype(np.float32), rng.integers(0, s.classes * s.members, 200)
    assert m._plain()
    plain = m.log_probability(states, y)
    m._plain = lambda: False
    assert np.array_equal(plain, m.log_probability(states, y))
    big = gated_lm.Gru(s, {**m.p, "C": m.p["C"] * 0 + 30})
    assert not big._plain() and np.isfinite(big.log_probability(states, y)).all()
