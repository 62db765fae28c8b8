"""Language ID: a byte convolutional network (multi-width filters, max pooling, softmax) in numpy.

``fit`` trains on a bounded, documented sample of labelled rows: at most ``docs_per_lang`` documents of
each of the ``max_langs`` most frequent languages, chosen by hash of the id, and ``windows_per_doc``
windows of each.  ``predict`` applies the network to every fixed-length window of every whole text and
averages the windows' class probabilities, weighted by the bytes they hold.

Inside the network a filter of width w over byte embeddings is linear before pooling, so for
prediction each filter bank becomes lookup tables over byte pairs: no matrix product per byte.

Cases: null text, or text without a letter (Unicode L*) -> ``und`` with score 0.0.  Repeated rows are
predicted alike.  An empty table gives an empty result; no labelled row at all -> every row ``und``.
Ties go to the first language in sorted order.  Other columns pass through; a column that has the name
of an output column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, prepare

UND = "und"


@dataclass(frozen=True)
class Settings:
    window: int = 256
    widths: tuple[int, ...] = (2, 3, 4)
    filters: int = 8
    embed: int = 8
    steps: int = 500
    batch: int = 128
    rate: float = 0.01
    docs_per_lang: int = 400
    windows_per_doc: int = 4
    max_langs: int = 200
    seed: int = 7


@dataclass
class Model:
    """``tables[width]`` lists the lookup tables of a bank: (offset, span, table over 256**span)."""

    langs: list[str]
    window: int
    tables: dict
    weights: np.ndarray
    bias: np.ndarray


def to_windows(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts (zero-padded at a text's end), bytes held by each, windows per text."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    counts = np.maximum(1, -(-lengths // window))
    flat = b"".join([t.ljust(int(n) * window, b"\0") for t, n in zip(texts, counts)])
    held = np.full(int(counts.sum()), window, dtype=np.int64)
    held[np.cumsum(counts) - 1] = lengths - (counts - 1) * window
    return np.frombuffer(flat, dtype=np.uint8).reshape(-1, window), held, counts


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], s: Settings) -> Model:
    """Adam on the cross-entropy; windows are cut at random lengths so short texts are learned too."""
    rng = np.random.default_rng(s.seed)
    p = {"E": rng.normal(0, 0.5, (256, s.embed)).astype(np.float32),
         "W": rng.normal(0, 0.3, (len(s.widths) * s.filters, len(langs))).astype(np.float32),
         "b": np.zeros(len(langs), np.float32)}
    for w in s.widths:
        p[f"K{w}"] = rng.normal(0, 0.4, (w * s.embed, s.filters)).astype(np.float32)
        p[f"c{w}"] = np.zeros(s.filters, np.float32)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    by_lang = [np.flatnonzero(labels == k) for k in range(len(langs))]
    per = max(1, s.batch // len(langs))
    for step in range(1, s.steps + 1):
        pick = np.concatenate([rng.choice(ix, per) for ix in by_lang])
        x = windows[pick].copy()
        cut = rng.integers(12, s.window + 1, len(pick))
        cut[rng.random(len(pick)) < 0.5] = s.window
        x[np.arange(s.window)[None, :] >= cut[:, None]] = 0
        n, emb = len(pick), p["E"][x]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        pooled, kept = [], {}
        for w in s.widths:
            t = s.window - w + 1
            cols = np.concatenate([emb[:, j:j + t] for j in range(w)], axis=2)
            z = cols @ p[f"K{w}"]
            at = z.argmax(axis=1)
            top = np.take_along_axis(z, at[:, None, :], axis=1)[:, 0] + p[f"c{w}"]
            kept[w] = (cols, at, top)
            pooled.append(np.maximum(top, 0))
        h = np.concatenate(pooled, axis=1)
        d = _softmax(h @ p["W"] + p["b"])
        d[np.arange(n), labels[pick]] -= 1
        d /= n
        g["W"], g["b"] = h.T @ d, d.sum(axis=0)
        dh = d @ p["W"].T
        for i, w in enumerate(s.widths):
            cols, at, top = kept[w]
            dt = dh[:, i * s.filters:(i + 1) * s.filters] * (top > 0)
            g[f"c{w}"] = dt.sum(axis=0)
            rows = np.arange(n)[:, None]
            best = cols[rows, at]                                    # (n, filters, w * embed)
            g[f"K{w}"] = np.einsum("nfk,nf->kf", best, dt)
            back = dt[:, :, None] * p[f"K{w}"].T[None]               # (n, filters, w * embed)
            for j in range(w):
                np.add.at(g["E"], x[rows, at + j], back[:, :, j * s.embed:(j + 1) * s.embed])
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v2[k] = 0.999 * v2[k] + 0.001 * g[k] ** 2
            p[k] -= s.rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    tables = {}
    for w in s.widths:
        one = [p["E"] @ p[f"K{w}"][j * s.embed:(j + 1) * s.embed] for j in range(w)]
        one[0] = one[0] + p[f"c{w}"]
        bank = [(j, 2, (one[j][:, None, :] + one[j + 1][None, :, :]).reshape(65536, s.filters)) for j in range(0, w - 1, 2)]
        if w % 2:
            bank.append((w - 1, 1, one[w - 1]))
        tables[w] = bank
    return Model(langs, s.window, tables, p["W"], p["b"])


def probabilities(model: Model, windows: np.ndarray, step: int = 1024) -> np.ndarray:
    """Class probabilities of each window; ``step`` windows at a time bound the memory."""
    out = np.empty((len(windows), len(model.langs)), np.float32)
    for a in range(0, len(windows), step):
        x = windows[a:a + step]
        pair = (x[:, :-1].astype(np.uint16) << 8) | x[:, 1:]
        pooled = []
        for w, bank in model.tables.items():
            t = model.window - w + 1
            z = None
            for j, span, table in bank:
                part = np.take(table, (pair if span == 2 else x)[:, j:j + t], axis=0)
                z = part if z is None else np.add(z, part, out=z)
            pooled.append(np.maximum(z.max(axis=1), 0))
        out[a:a + step] = _softmax(np.concatenate(pooled, axis=1) @ model.weights + model.bias)
    return out


def classify(model: Model, texts: list[bytes], group_bytes: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Class index and score of each text, over all its windows."""
    best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    a = 0
    while a < len(texts):
        b, size = a, 0
        while b < len(texts) and (b == a or size + len(texts[b]) <= group_bytes):
            size += len(texts[b])
            b += 1
        windows, held, counts = to_windows(texts[a:b], model.window)
        weighted = probabilities(model, windows).astype(np.float64) * held[:, None]
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        total = np.add.reduceat(weighted, starts, axis=0) / np.maximum(1, np.add.reduceat(held, starts))[:, None]
        best[a:b], score[a:b] = total.argmax(axis=1), np.clip(total.max(axis=1), 0, 1)
        a = b
    return best, score


def fit(docs: DataFrame, train_rows: Column, *, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", settings: Settings = Settings()) -> Model | None:
    """Train on the bounded sample of the rows ``train_rows`` selects; None when there is none."""
    s = settings
    rows = docs.filter(train_rows & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col).cast("string"), F.length(text_col)).alias("h"))
    freq = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.max_langs).collect()
    if not freq:
        return None
    # uniform hash below a share of each language: twice the bound expected, then cut to the bound
    share = F.lit(-1.0)
    for r in freq:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, 2.0 * s.docs_per_lang / r["count"]))).otherwise(share)
    u = F.pmod(F.col("h"), F.lit(1 << 20)) / float(1 << 20)
    size, win = F.octet_length("text"), s.window
    cut = F.transform(F.sequence(F.lit(0), F.lit(s.windows_per_doc - 1)), lambda k: F.substring(
        F.col("text").cast("binary"),
        (F.pmod(F.xxhash64("h", k), F.greatest(F.lit(1), F.ceil(size / win))) * win + 1).cast("int"), F.lit(win)))
    got = rows.filter(u < share).select("lang", "h", F.array_distinct(cut).alias("cuts")) \
        .orderBy("h", "lang", "cuts").limit(2 * s.docs_per_lang * len(freq) + 64).collect()
    langs, used = sorted({r["lang"] for r in got}), {}
    cuts, labels = [], []
    for r in got:
        used[r["lang"]] = used.get(r["lang"], 0) + 1
        if used[r["lang"]] <= s.docs_per_lang:
            cuts += [bytes(c) for c in r["cuts"]]
            labels += [langs.index(r["lang"])] * len(r["cuts"])
    windows, _, _ = to_windows(cuts, win)
    return train(windows, np.array(labels), langs, s)


def predict(docs: DataFrame, model: Model | None, *, text_col: str = "text", pred_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its score."""
    spark = docs.sparkSession
    prepare(spark)
    if model is None:
        return docs.withColumns({pred_col: F.lit(UND), score_col: F.lit(0.0)})
    shipped = spark.sparkContext.broadcast(model)                    # a few MB, fixed by the settings

    @F.pandas_udf("lang string, score double")
    def score_batch(texts: pd.Series) -> pd.DataFrame:
        net = shipped.value
        lang, score = np.full(len(texts), UND, dtype=object), np.zeros(len(texts))
        some = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
        if some:
            best, value = classify(net, [texts.iloc[i].encode("utf-8", "surrogatepass") for i in some])
            lang[some], score[some] = np.array(net.langs, dtype=object)[best], value
        return pd.DataFrame({"lang": lang, "score": score})

    got = fresh(docs, "_predicted")
    both = docs.withColumn(got, score_batch.asNondeterministic()(F.col(text_col)))
    return both.withColumns({pred_col: F.col(f"{got}.lang"), score_col: F.col(f"{got}.score")}).drop(got)
