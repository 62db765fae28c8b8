"""LM scoring: a gated recurrent language model in numpy, with exact corpus counts beside it.

Counts.  Every word of every training document is counted (lower case A-Z; one end token per document);
the table stays distributed.  The most frequent words (at most ``head``, cut at a count) go to the tasks;
all other words are looked up by a join, so every count is exact whatever the vocabulary's size.

Model.  A gated recurrent unit reads the document.  The next word's probability is factored: class, then
member of the class (classes are blocks of words of like frequency; output biases start at the counts'
logarithms).  Words outside the ``classes * members`` modelled ones are the unknown word, times their share of
the counts of all unmodelled words (add-one, with one place for the never seen), so a score is a
probability of the whole text.

Training.  Truncated backpropagation through time: windows of ``train_window`` tokens, state carried from
window to window (for ``segment`` tokens of a document; then from zero, so long documents take no longer).  Every training document is learned from once, whole: replicas of about ``replica_tokens``
tokens train side by side from the same start and are averaged, token-weighted, in integer arithmetic.

Scoring.  Documents are laid end to end in lanes and run side by side, window by window; the state is
carried across windows and cleared where a document begins, so a score covers the whole document.

Cases: null text counts as empty (one token, the end).  Repeated rows and null ids each keep their row; copies of
a row with one id and text are dealt over the replicas by their place in the staged training table.  Words of one
count are ranked by their bytes.  Very long texts: a lane is as long as the longest text, but only live lanes are
laid out, so memory follows the tokens.
Without training documents all counts are zero and the model is its start.  An empty table gives an empty
result.  Only the id and text columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, scratch, staged

UNKNOWN, END = 0, 1
FIXED = 1 << 20
BLOCK = 16
ROWS = 4096


@dataclass(frozen=True)
class Settings:
    head: int = 300_000
    classes: int = 56
    members: int = 56
    embed: int = 16
    hidden: int = 16
    replica_tokens: int = 1_000_000
    lanes: int = 512
    update_tokens: int = 8192
    segment: int = 1024
    train_window: int = 16
    score_lanes: int = 512
    score_window: int = 64
    rate: float = 0.02
    clip: float = 1.0
    group_bytes: int = 1 << 24
    seed: int = 3


@dataclass
class Counts:
    """``words`` by falling count; ``total`` tokens and ``distinct`` ones, the end included (``ends``)."""

    words: list[str]
    counts: np.ndarray
    ends: int
    total: int
    distinct: int


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, pa.StringArray]:
    """Words per text, and all words end to end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    some = pc.binary_length(flat).to_numpy() > 0
    before = np.concatenate([[0], np.cumsum(some)])
    return np.diff(before[offsets - offsets[0]]), flat.filter(pa.array(some))


def groups(column: pa.Array, group_bytes: int) -> Iterator[tuple[int, int]]:
    """(start, length) of slices of about ``group_bytes``, at least one text each."""
    size, a = pc.fill_null(pc.binary_length(column), 0).to_numpy(), 0
    while a < len(column):
        n = max(1, int(np.searchsorted(np.cumsum(size[a:] + 1), group_bytes)))
        yield a, n
        a += n


def count_words(texts: DataFrame, s: Settings) -> DataFrame:
    """(word, c) over the text column; the number of texts under the empty word (their ends)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, n in groups(batch.column(0), s.group_bytes):
                words = tokens_of(batch.column(0).slice(a, n))[1].dictionary_encode()
                c = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
                yield pa.RecordBatch.from_arrays([pa.concat_arrays([words.dictionary, pa.array([""], pa.string())]),
                                                  pa.array(np.append(c, n), pa.int64())], names=["word", "c"])

    return texts.mapInArrow(run, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def head_of(table: DataFrame, s: Settings) -> Counts:
    """Totals and the most frequent words: all above a count that at most ``head`` words reach."""
    words = table.filter("word != ''")
    level = F.floor(F.log2("c") * 16).cast("int")
    by_level = sorted(words.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect(), reverse=True)
    ends = table.filter("word = ''").agg(F.sum("c")).first()[0] or 0
    least, room = None, s.head
    for r in by_level:
        room -= r["n"]
        if room < 0:
            break
        least = r["level"]
    top = words.filter(level >= least).toArrow() if least is not None else pa.table({"word": pa.array([], pa.string()), "c": pa.array([], pa.int64())})
    top = top.combine_chunks().sort_by([("c", "descending"), ("word", "ascending")])
    return Counts(top["word"].to_pylist(), top["c"].to_numpy().astype(np.int64), int(ends),
                  sum(r["c"] for r in by_level) + int(ends), sum(r["n"] for r in by_level) + (ends > 0))


class Gru:
    """Parameters and passes.  Token ids: unknown, end, then words by falling count; class = id // members."""

    def __init__(self, s: Settings, params: dict[str, np.ndarray]):
        self.s, self.p, self.kept = s, params, {}

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """A work array, its old content still in it, from call to call in the same memory: large new arrays cost page faults."""
        size, kind = math.prod(shape), self.p["C"].dtype
        if name not in self.kept or self.kept[name].size < size or self.kept[name].dtype != kind:
            self.kept[name] = np.empty(size, kind)
        return self.kept[name][:size].reshape(shape)

    @staticmethod
    def start(s: Settings, known: Counts) -> Gru:
        rng, h, n = np.random.default_rng(s.seed), s.hidden, s.classes * s.members
        modelled = known.counts[:n - 2]
        c = np.zeros(n)
        c[UNKNOWN], c[END] = known.total - known.ends - modelled.sum() + 1, known.ends + 1
        c[2:2 + len(modelled)] = modelled
        by = c.reshape(s.classes, s.members)
        log = lambda x: np.where(x > 0, np.log(np.maximum(x, 1e-9)), -30.0)
        draw = lambda *shape: rng.normal(0, 0.15, shape)
        p = {"E": draw(n, s.embed), "Wx": draw(s.embed, 3 * h), "b": np.zeros(3 * h), "Uzr": draw(h, 2 * h), "Uh": draw(h, h),
             "C": draw(h, s.classes) * 0.3, "cb": log(by.sum(axis=1)) - np.log(c.sum()), "O": draw(s.classes, s.members, h) * 0.3,
             "ob": log(by) - log(by.sum(axis=1, keepdims=True))}
        p["b"][:h] = 1.0                                             # keep the state at first
        return Gru(s, {k: v.astype(np.float32) for k, v in p.items()})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def with_flat(self, values: np.ndarray, copy: bool = True) -> Gru:
        out, at = {}, 0
        for k in sorted(self.p):
            n = self.p[k].size
            out[k] = values[at:at + n].reshape(self.p[k].shape).astype(np.float32, copy=copy)
            at += n
        return Gru(self.s, out)

    def _plain(self) -> bool:
        """Whether no logit can leave the range of plain sums of exponentials, whatever the state (its entries lie within 1)."""
        p = self.p
        return max(float((np.abs(w).sum(axis=axis) + np.abs(b)).max()) for w, b, axis in ((p["C"], p["cb"], 0), (p["O"], p["ob"], 2))) < 59

    def _by_class(self, k: np.ndarray, block: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Tokens of classes ``k`` laid by class, each class in whole blocks of rows: the token of each row (their number in
        rows left over), the row of each token, the rows left over, and (class, from, to) of each class that has any."""
        n, order, size = len(k), np.argsort(k.astype(np.int16), kind="stable"), np.bincount(k, minlength=self.s.classes)    # short keys sort by digits
        room = -(-size // block) * block
        end = np.cumsum(room)
        row = np.repeat(end - room - (np.cumsum(size) - size), size) + np.arange(n)
        token, place = np.full(int(room.sum()), n), np.empty(n, np.int64)
        token[row], place[order] = order, row
        return token, place, np.flatnonzero(token == n), [(c, int(end[c] - room[c]), int(end[c])) for c in np.flatnonzero(size).tolist()]

    def log_probability(self, states: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural log probability of each token after each state."""
        p, s, n = self.p, self.s, len(y)
        k, plain = y // s.members, self._plain()
        out = np.empty(n, states.dtype)
        for a in range(0, n, ROWS):                                    # rows that stay in the cache
            z = np.matmul(states[a:a + ROWS], p["C"], out=self._room("z", min(ROWS, n - a), s.classes))
            z += p["cb"]
            out[a:a + ROWS] = z[np.arange(len(z)), k[a:a + ROWS]]
            out[a:a + ROWS] -= _log_sum(z, plain)
        order, place, _, classes = self._by_class(k)
        held, member, told = _rows(states, order), _rows(y % s.members, order), np.empty(n, out.dtype)
        for c, a, b in classes:
            z = np.matmul(held[a:b], p["O"][c].T, out=self._room("z", b - a, s.members))
            z += p["ob"][c]
            told[a:b] = z[np.arange(b - a), member[a:b]]
            told[a:b] -= _log_sum(z, plain)
        out += _rows(told, place)
        return out

    def _gates(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of both gates, of the candidate, and the inputs of all three by token id, each in an array of its own: rows
        without gaps take a third of the time.  Those of the gates are halved: sigmoid(z) = tanh(z / 2) / 2 + 1 / 2."""
        p, h = self.p, self.s.hidden
        into, gates = (np.ascontiguousarray(p[k].reshape(len(p[k]), -1, h).transpose(1, 0, 2)) for k in ("Wx", "Uzr"))
        half = np.array([0.5, 0.5, 1], into.dtype).reshape(3, 1, 1)
        table = np.matmul(p["E"], into * half, out=self._room("table", 3, len(p["E"]), h))
        table += p["b"].reshape(3, 1, h) * half
        return gates * half[:2], p["Uh"], table

    def _inputs(self, table: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The tokens' inputs (gates and candidate, time, lane)."""
        out = self._room("gx", 3, *x.shape, self.s.hidden)
        for rows, to in zip(table, out):
            np.take(rows, x, axis=0, out=to, mode="clip")             # ids are fewer than tokens
        return out

    def score(self, lanes: Lanes) -> np.ndarray:
        """Log probability of every token, in the lanes' own layout."""
        p, h, s = self.p, self.s.hidden, self.s
        _warm()
        gates, over, table = self._gates()
        state, out = np.zeros((len(lanes.used), h), np.float32), np.zeros(len(lanes.ids), np.float32)
        for a in range(0, lanes.length, s.score_window):
            x, begins, live, at = lanes.window(a, a + s.score_window)
            width, new = live.sum(axis=1).tolist(), begins.any(axis=1).tolist()
            inputs, end = self._inputs(table, x), 0
            before, both, turned = (self._room(name, *shape) for name, shape in (("states", (sum(width), h)), ("gates", (2, x.shape[1], h)), ("candidates", x.shape[1:] + (h,))))
            state = state[:x.shape[1]]
            for t, n in enumerate(width):
                state = state[:n]
                if new[t]:
                    state = state * ~begins[t, :n, None]
                before[end:end + n] = state
                end += n
                gate = np.matmul(state, gates, out=both[:, :n])
                gate += inputs[:2, t, :n]
                _half_tanh(gate)
                np.multiply(gate[1], state, out=turned[:n])
                cand = turned[:n] @ over
                cand += inputs[2, t, :n]
                np.tanh(cand, out=cand)
                state = state - cand
                state *= gate[0]
                state += cand
            out[at[live]] = self.log_probability(before, x[live])
        return out

    def gradients(self, x: np.ndarray, begins: np.ndarray, live: np.ndarray, state: np.ndarray,
                  told: bool = True) -> tuple[float, dict, np.ndarray]:
        """Loss (0 unless ``told``), gradients over a window (time, lane) and the state after it; ``live``: tokens that count."""
        p, s, h, (steps, lanes) = self.p, self.s, self.s.hidden, x.shape
        g = {k: np.zeros_like(v) if k in ("E", "O", "ob") else v for k, v in p.items()}
        gates, over, table = self._gates()
        gx, both = self._inputs(table, x), self._room("gates", 2, steps, lanes, h)
        room, ns = self._room("states", steps * lanes + 1, h), self._room("candidates", steps, lanes, h)
        states = room[:-1].reshape(steps, lanes, h)
        new = begins.any(axis=1)
        for t in range(steps):
            if new[t]:
                state = state * ~begins[t, :, None]
            states[t] = state
            gate = np.matmul(state, gates, out=both[:, t])
            gate += gx[:2, t]
            _half_tanh(gate)
            cand = np.matmul(gate[1] * state, over, out=ns[t])
            cand += gx[2, t]
            np.tanh(cand, out=cand)
            state = state - cand
            state *= gate[0]
            state += cand
        zs, rs = both
        at = np.flatnonzero(live.ravel())
        y, count, every = _rows(x.ravel(), at), max(1, len(at)), len(at) == steps * lanes
        if not every:
            np.take(room, at, axis=0, out=self._room("hs", len(at) + 1, h)[:-1], mode="clip")
            room = self._room("hs", len(at) + 1, h)
        room[-1], hs = 0, room[:-1]                                  # the last is the row of no token
        z = np.matmul(hs, p["C"], out=self._room("z", len(hs), s.classes))
        z += p["cb"]
        k, one, plain = y // s.members, 1 / count, self._plain()
        spot = np.arange(len(y)) * s.classes + k
        loss = -z.ravel()[spot].sum(dtype=np.float64) if told else 0.0
        d, total = _softmax(z, one, plain)
        loss += total().sum(dtype=np.float64) if told else 0.0
        d.reshape(-1)[spot] -= one
        g["C"], g["cb"], dh = hs.T @ d, np.ones(len(d), d.dtype) @ d, d @ p["C"].T
        token, place, left, classes = self._by_class(k, BLOCK)
        held, z, dheld = (self._room(name, len(token), width) for name, width in (("held", h), ("z", s.members), ("dheld", h)))
        np.take(room, token, axis=0, out=held, mode="clip")
        O, ob, gO, gob = p["O"], p["ob"], g["O"], g["ob"]
        for c, a, b in classes:
            part = z[a:b]
            np.matmul(held[a:b], O[c].T, out=part)
            part += ob[c]
        spot = place * s.members + y % s.members
        loss -= z.ravel()[spot].sum(dtype=np.float64) if told else 0.0
        d, total = _softmax(z, one, plain)
        loss += total()[place].sum(dtype=np.float64) if told else 0.0
        d.reshape(-1)[spot] -= one
        d[left] = 0
        for c, a, b in classes:
            part = d[a:b]
            np.matmul(part, O[c], out=dheld[a:b])
            np.matmul(part.T, held[a:b], out=gO[c])
            np.add.reduce(part, axis=0, out=gob[c])
        dh += _rows(dheld, place)
        dout = dh if every else self._room("dout", steps * lanes, h)
        if not every:
            dout[:] = 0
            dout[at] = dh
        dout = dout.reshape(steps, lanes, h)
        dgx, back = self._room("gx", steps, lanes, 3 * h), np.zeros((lanes, h), np.float32)    # in the place of the inputs, which are used up
        slope, reach, close = 1 - ns * ns, rs * (1 - rs), zs * (1 - zs)                    # of all steps at once
        reach *= states
        slope *= 1 - zs
        close *= states - ns
        into, over = np.ascontiguousarray(p["Uzr"].T), np.ascontiguousarray(p["Uh"].T)
        for t in range(steps - 1, -1, -1):
            dn, both = dgx[t, :, 2 * h:], dgx[t, :, :2 * h]
            np.multiply(back, slope[t], out=dn)
            drs = dn @ over
            np.multiply(back, close[t], out=both[:, :h])
            np.multiply(drs, reach[t], out=both[:, h:])
            back = back * zs[t]
            drs *= rs[t]
            back += drs
            back += both @ into
            back += dout[t]
            if new[t]:
                back *= ~begins[t, :, None]
        flat = dgx.reshape(-1, 3 * h)
        g["Uzr"] = states.reshape(-1, h).T @ flat[:, :2 * h]
        g["Uh"] = (rs * states).reshape(-1, h).T @ flat[:, 2 * h:]
        back, ids = flat @ p["Wx"].T, x.ravel().astype(np.int64)
        g["Wx"], g["b"] = _rows(p["E"], ids).T @ flat, flat.sum(axis=0)
        known = np.flatnonzero(ids)                                  # the unknown word, by far the most frequent, is summed by itself
        np.add.reduce(_rows(back, np.flatnonzero(ids == UNKNOWN)).astype(np.float64), axis=0, out=(total := np.zeros(s.embed)))
        ids, back = ids[known], np.ascontiguousarray(_rows(back, known).T)
        for c in range(s.embed):
            g["E"][:, c] = np.bincount(ids, weights=back[c], minlength=len(g["E"]))
        g["E"][UNKNOWN] = total
        return float(loss) / count, g, state

    def train(self, docs: list[np.ndarray]) -> Gru:
        """One pass over the documents (ids, end last) in lanes; Adam, gradients cut at ``clip``."""
        s = self.s
        # a long document is learned in segments side by side: one alone in its lane would hold up all others
        lanes = Lanes([d[a:a + s.segment] for d in docs for a in range(0, len(d), s.segment)], s.lanes)
        values = self.flat()
        model, m, v2, part = self.with_flat(values, copy=False), np.zeros_like(values), np.zeros_like(values), np.empty_like(values)
        state = np.zeros((len(lanes.used), s.hidden), np.float32)
        step, held, tokens = 0, np.zeros_like(values), 0
        for a in range(0, lanes.length, s.train_window):
            x, begins, live, _ = lanes.window(a, a + s.train_window)
            _, g, state = model.gradients(x, begins, live, state[:x.shape[1]], told=False)
            n = int(live.sum())
            held += np.multiply(np.concatenate([g[k].ravel() for k in sorted(g)]), n, out=part)
            tokens += n
            if tokens < s.update_tokens and a + s.train_window < lanes.length:
                continue                                             # few lanes are left: wait for as many tokens as usual
            grad, share = held / tokens, min(1.0, tokens / s.update_tokens)
            held[:], tokens, step = 0, 0, step + 1
            grad *= min(1.0, s.clip / (float(np.sqrt(grad @ grad)) + 1e-9))
            m *= 0.9
            m += np.multiply(grad, 0.1, out=part)
            v2 *= 0.99
            v2 += np.multiply(np.multiply(grad, grad, out=part), 0.01, out=part)
            np.sqrt(np.multiply(v2, 1 / (1 - 0.99 ** step), out=part), out=part)
            part += 1e-6
            np.divide(m, part, out=part)
            values -= np.multiply(part, s.rate * share / (1 - 0.9 ** step), out=part)
        return model


def _half_tanh(z: np.ndarray) -> None:
    """Sigmoid of twice each entry, in its place."""
    np.tanh(z, out=z)
    z *= 0.5
    z += 0.5


def _rows(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """``values[at]`` for places that all lie in it: without a check of each, several times faster."""
    return np.take(values, at, axis=0, mode="clip")


@cache
def _warm() -> None:
    """One larger product, once per process: until then the matrix library takes three times as long for each thin one."""
    np.ones((ROWS, 64), np.float32) @ np.ones((64, 64), np.float32)


def _log_sum(z: np.ndarray, plain: bool) -> np.ndarray:
    """Logarithm of each row's sum of exponentials; ``z`` is used up.  Rows are shifted by their greatest entry only
    where plain sums leave the range of the numbers; ``plain``: they are known not to."""
    if plain or float(z.max(initial=0)) < 60 and float(z.min(initial=0)) > -80:
        return np.log(np.exp(z, out=z) @ np.ones(z.shape[1], z.dtype))
    top = z.max(axis=1)
    z -= top[:, None]
    return top + np.log(np.exp(z, out=z).sum(axis=1))


def _softmax(z: np.ndarray, weight: float, plain: bool) -> tuple[np.ndarray, Callable[[], np.ndarray]]:
    """The probabilities of each row times ``weight``, in the place of ``z``, and what tells the row's ``_log_sum``."""
    top = None
    if not plain and (float(z.max(initial=0)) >= 60 or float(z.min(initial=0)) <= -80):
        top = z.max(axis=1)
        z -= top[:, None]
    np.exp(z, out=z)
    total = z @ np.ones(z.shape[1], z.dtype)
    z *= (weight / total)[:, None]
    return z, lambda: np.log(total) if top is None else top + np.log(total)


class Lanes:
    """Documents (ids, end last) end to end in at most ``lanes`` lanes of like length, the longest lane first.

    Lanes are ragged: one array holds them one after the other, and ``window`` lays out only the lanes that are
    live in it, so memory follows the tokens, whatever the longest document."""

    def __init__(self, docs: list[np.ndarray], lanes: int):
        size = np.array([len(d) for d in docs], np.int64)
        lanes = max(1, min(lanes, len(docs)))
        heap, lane, first = [(0, i) for i in range(lanes)], np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        for i in np.argsort(-size, kind="stable"):
            used, k = heapq.heappop(heap)
            lane[i], first[i] = k, used
            heapq.heappush(heap, (used + int(size[i]), k))
        used = np.zeros(lanes, np.int64)
        np.maximum.at(used, lane, first + size)
        order = np.argsort(-used, kind="stable")
        new = np.empty(lanes, np.int64)
        new[order] = np.arange(lanes)
        lane, self.used = new[lane], used[order]
        self.start = np.cumsum(self.used) - self.used
        total, begin = int(size.sum()), self.start[lane] + first
        self.place = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(total)      # of every token, document by document
        self.ids, self.begins = np.zeros(max(1, total), np.int32), np.zeros(max(1, total), bool)
        if len(docs):
            self.ids[self.place] = np.concatenate(docs)
            self.begins[begin] = True
        self.length = int(self.used[0]) if len(docs) else 0

    def window(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, begin marks, live marks and places (time, lane) of the lanes that go on past ``a``."""
        lanes = int(np.searchsorted(-self.used, -a, side="left"))
        t = np.arange(a, min(b, self.length))[:, None]
        at, live = self.start[None, :lanes] + t, t < self.used[None, :lanes]
        if lanes and self.used[lanes - 1] >= min(b, self.length):       # as a rule all are live
            return _rows(self.ids, at), _rows(self.begins, at), live, at
        at = np.where(live, at, 0)
        return np.where(live, self.ids[at], 0), self.begins[at] & live, live, at


class Lexicon:
    """Head words to ids and counts, for whole batches."""

    def __init__(self, known: Counts, s: Settings):
        self.words, self.modelled = pa.array(known.words, pa.string()), s.classes * s.members - 2
        self.counts = np.append(known.counts, 0)                     # the last entry stands for words outside the head

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.StringArray]:
        """Words per text; per word its rank in the head (or their number); the words."""
        size, words = tokens_of(texts)
        return size, pc.fill_null(pc.index_in(words, value_set=self.words), len(self.words)).to_numpy(), words

    def documents(self, size: np.ndarray, rank: np.ndarray) -> list[np.ndarray]:
        """Model ids of each text, its end last."""
        ids = np.where(rank < min(self.modelled, len(self.words)), rank + 2, UNKNOWN).astype(np.int32)
        return [np.append(d, np.int32(END)) for d in np.split(ids, np.cumsum(size)[:-1])] if len(size) else []


def _average(parts: DataFrame) -> np.ndarray:
    """Token-weighted mean of the replicas' parameters, summed as integers of 38 digits (any order gives the same)."""
    rows = parts.groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"), F.sum("w").alias("w")).select(
        "i", (F.col("v").cast("double") / (F.col("w").cast("double") * FIXED)).alias("v")).toArrow().sort_by("i")
    return rows["v"].to_numpy()


def _replica(shipped):
    """Group function: train on a replica's documents (about ``replica_tokens`` tokens), in an order that no shuffle changes."""

    def run(part):
        start, lex = shipped.value
        texts = part.sort_by([("tie", "ascending"), ("text", "ascending")])["text"].combine_chunks()
        size, rank, _ = lex.read(texts)
        docs = lex.documents(size, rank)
        tokens = sum(map(len, docs))
        flat = np.round(start.train(docs).flat().astype(np.float64) * FIXED).astype(np.int64) * tokens
        return pa.table({"i": pa.array(np.arange(len(flat)), pa.int32()), "v": pa.array(flat), "w": pa.array(np.full(len(flat), tokens), pa.int64())})

    return run


def fit(texts: DataFrame, known: Counts, s: Settings) -> Gru:
    """Train on all ``texts`` (tie, text) once, in replicas of about ``replica_tokens`` tokens that are averaged.

    ``tie`` tells equal texts apart, so copies are dealt over the replicas like any other documents."""
    spark = texts.sparkSession
    model, modelled = Gru.start(s, known), s.classes * s.members - 2
    lexicon = Lexicon(replace(known, words=known.words[:modelled], counts=known.counts[:modelled]), s)    # all others are the unknown word
    if not known.total:
        return model
    replicas = max(1, round(known.total / s.replica_tokens))
    shipped = spark.sparkContext.broadcast((model, lexicon))
    parts = texts.withColumn("replica", F.pmod(F.xxhash64("tie", "text"), F.lit(replicas)).cast("int")).groupBy("replica").applyInArrow(
        _replica(shipped), "i int, v long, w long")
    values = _average(parts)
    return model.with_flat(values) if len(values) else model


def score(docs: DataFrame, train_rows: Column, *, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per row: id, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities of the whole text)."""
    spark, s = docs.sparkSession, settings
    prepare(spark)
    with scratch(spark) as keep:
        return _score(docs, train_rows, id_col, text_col, s, keep)


def _score(docs: DataFrame, train_rows: Column, id_col: str, text_col: str, s: Settings, keep) -> DataFrame:
    spark = docs.sparkSession
    # staged once: numbers of rows hold still, whatever is run again
    train = staged(docs.filter(train_rows).select(F.col(text_col).alias("text"),
                                                  F.xxhash64(F.col(id_col).cast("string"), F.monotonically_increasing_id()).alias("tie")), "lm_train")
    table = keep(staged(count_words(train.select("text"), s), "lm_counts"))
    known = head_of(table, s)
    model = fit(train, known, s)
    shipped = spark.sparkContext.broadcast((model, Lexicon(known, s)))   # at most head words and the parameters
    scale, modelled = np.log(10), known.counts[:s.classes * s.members - 2]
    rest_total, rest_distinct = known.total - known.ends - int(modelled.sum()), known.distinct - (known.ends > 0) - len(modelled)
    base_log, rest_log, end_log = (float(np.log10(x)) for x in (known.total + known.distinct + 1, rest_total + rest_distinct + 1, known.ends + 1))
    ends_known = int(known.ends > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, lex = shipped.value
        part, row = TaskContext.get().partitionId(), 0
        count_log = np.log10(lex.counts + 1.0)
        limit = min(lex.modelled, len(lex.words))
        for batch in batches:
            for a, n in groups(batch.column(1), s.group_bytes):
                size, rank, words = lex.read(batch.column(1).slice(a, n))
                ids = lex.documents(size, rank)
                lanes = Lanes(ids, s.score_lanes)
                log_p = net.score(lanes)[lanes.place].astype(np.float64)
                full = np.cumsum(size + 1)
                text = np.repeat(np.arange(n), size)
                by = lambda w: np.bincount(text, weights=w, minlength=n)
                known_log, outside = count_log[rank], rank >= limit
                tail = np.flatnonzero(rank == len(lex.words))
                rare = words.take(pa.array(tail)).dictionary_encode()
                words, kinds = rare.dictionary, max(1, len(rare.dictionary))
                pair, times = np.unique(text[tail] * kinds + rare.indices.to_numpy(), return_counts=True)
                rows = (part << 40) + np.arange(row, row + n)
                m, none = len(pair), pa.nulls
                columns = [
                    np.concatenate([rows, rows[pair // kinds]]),
                    pa.concat_arrays([batch.column(0).slice(a, n), none(m, batch.column(0).type)]),
                    *(pa.concat_arrays([pa.array(c, t), none(m, t)]) for c, t in (
                        (size + 1, pa.int64()), ((by(rank < len(lex.words)) + ends_known).astype(np.int64), pa.int64()),
                        (by(known_log) + end_log, pa.float64()),
                        (np.add.reduceat(log_p, full - size - 1) / scale + by(known_log * outside), pa.float64()),
                        (by(outside).astype(np.int64), pa.int64()))),
                    pa.concat_arrays([none(n, pa.string()), words.take(pa.array(pair % kinds)).cast(pa.string())]),
                    pa.concat_arrays([none(n, pa.int64()), pa.array(times, pa.int64())])]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns],
                                                 names=["row", "id", "n_tokens", "known", "base", "score", "outside", "word", "times"])
                row += n

    light = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = light.schema["id"].dataType.simpleString()
    seen = keep(staged(light.mapInArrow(run, f"row long, id {kind}, n_tokens long, known long, base double, score double, outside long, word string, times long"), "lm_scored"))
    # words outside the head meet their counts; those never counted add log10(0 + 1) = 0, so an inner join is all
    tail = (seen.filter("word is not null").select("row", "word", "times").join(table.filter("word != ''"), "word")
            .groupBy("row").agg(F.sum("times").alias("t_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("t_log")))
    zero = F.lit(0.0)
    return seen.filter("word is null").join(tail, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.coalesce("t_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("t_log", zero) - F.col("n_tokens") * base_log).alias("base_score"),
        (F.col("score") + F.coalesce("t_log", zero) - F.col("outside") * rest_log).alias("score"))


def tiny(**changes) -> Settings:
    """Settings for small tests."""
    return replace(Settings(classes=8, members=8, embed=6, hidden=8, lanes=8, score_lanes=4, score_window=5, train_window=6, update_tokens=40, head=100), **changes)
