"""BPE encoding and decoding by speculation and verification.

For the words of a batch that are not known yet: greedy longest match proposes tokens; a vectorised
check tests every adjacent pair of proposals; only words with an incompatible pair are merged exactly,
rule by rule (many words side by side).

Why the check is enough: a sequence of tokens is the BPE encoding of its text if each token encodes to
itself and no rule would join across a boundary earlier than the rules that build the tokens beside it.
On the left of a boundary stand, one after the other, the nodes of the left token's right spine, on the
right those of the right token's left spine; each node lives from the rank of the rule that makes it to
the rank of the rule that uses it.  A boundary breaks if a rule joins two nodes that live at the same
time, of lower rank than the rules that end them (at equal rank the leftmost pair goes first).

The tokenizer file is the kind with word ends: NFC, lower case, white space dropped, words by a fixed
pattern, bytes as printable characters, ``</w>`` at a word's end.  Known words are kept per worker in a
bounded table; when it is full, those not in use just then are forgotten (no effect on results).

Cases: null text counts as empty (no tokens, empty decoded text).  The added tokens' own strings in a
text are taken as those tokens, as the library does.  Repeated rows are encoded alike, an empty table
gives an empty result, very long texts go whole.  Other columns pass through; one that has the name of
an output column is replaced.
"""

from __future__ import annotations

import gc
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import prepare, read_text, tokenizer_file

END = "</w>"
KNOWN_LIMIT = 500_000


class Ragged:
    """Id lists by key, end to end in one array."""

    def __init__(self):
        self.place: dict = {}
        self.data, self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, keys: list, data: np.ndarray, size: np.ndarray) -> None:
        self.place.update(zip(keys, range(len(self.place), len(self.place) + len(keys))))
        self.start = np.concatenate([self.start, len(self.data) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.data = np.concatenate([self.data, data.astype(np.int32)])

    def places(self, keys: list, n: int) -> np.ndarray:
        return np.fromiter(map(self.place.__getitem__, keys), np.int64, n)

    def take(self, at: np.ndarray) -> np.ndarray:
        """The lists at these places, end to end."""
        size = self.size[at]
        before = np.cumsum(size) - size
        return self.data[np.repeat(self.start[at] - before, size) + np.arange(int(size.sum()))]

    def only(self, keys: list) -> Ragged:
        at, out = self.places(keys, len(keys)), Ragged()
        out.add(keys, self.take(at), self.size[at])
        return out


class WordBpe:
    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.vocab = model["vocab"]
        size = max([*self.vocab.values(), *self.added.values()]) + 1
        self.tokens = [""] * size
        for t, i in chain(self.vocab.items(), self.added.items()):
            self.tokens[i] = t
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern).findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        none = np.iinfo(np.int64).max
        self.size, self.never = size, none
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for n, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if self.rank[z] >= 0:
                raise ValueError(f"two rules make {a + b!r}: the compatibility check needs one")
            self.rules[x, y] = (n, z)
            self.rank[z], self.left[z], self.right[z] = n, x, y
        codes = np.array([x * size + y for x, y in self.rules], np.int64)
        ranks = np.array([n for n, _ in self.rules.values()], np.int64)
        by = np.argsort(codes)
        self.codes, self.ranks = codes[by], ranks[by]
        made = self.made = np.array([z for _, z in self.rules.values()])
        own = np.zeros(size, bool)
        own[made] = self.compatible(self.left[made], self.right[made], self.rank[made])
        for z in made:                               # in rank order: parts come before what they make
            own[z] &= (self.rank[self.left[z]] < 0 or own[self.left[z]]) and (self.rank[self.right[z]] < 0 or own[self.right[z]])
        good = {t: i for t, i in self.vocab.items() if self.rank[i] < 0 or own[i]}
        self.last = {t[:-len(END)]: i for t, i in good.items() if t.endswith(END)}
        self.inner = {t: i for t, i in good.items() if not t.endswith(END)}
        self.longest_last, self.reach = max(map(len, self.last)), {}
        for t in self.inner:
            self.reach[t[:2]] = max(len(t), self.reach.get(t[:2], 1))
        self.known, self.known_words = Ragged(), Ragged()
        self.failed = self.proposed = 0

    def _rule_rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        code = x * self.size + y
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, self.ranks[at], self.never)

    def compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens a and b stay apart side by side (only rules of lower rank than ``before`` count)."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        x_end = np.full(len(x), self.never) if before is None else before.copy()
        y_end = x_end.copy()
        good, live = np.ones(len(x), bool), np.arange(len(x))
        while len(live):
            q = self._rule_rank(x, y)
            # at equal rank the pair further left goes first: the left token's own rule, but not the right one's
            broken = (q < x_end) & (q <= y_end) & (q != self.never)
            if before is not None:
                broken &= q < before[live]
            good[live[broken]] = False
            rx, ry = self.rank[x], self.rank[y]
            go = ~broken & ((rx >= 0) | (ry >= 0))
            x, y, x_end, y_end, rx, ry, live = (v[go] for v in (x, y, x_end, y_end, rx, ry, live))
            back_x = rx > ry
            x_end, y_end = np.where(back_x, rx, x_end), np.where(back_x, y_end, ry)
            x, y = np.where(back_x, self.right[x], x), np.where(back_x, y, self.left[y])
        return good

    def _propose(self, word: str) -> list[int]:
        """Greedy longest match over the word's letters and its end."""
        out, at, n, inner, last, reach = [], 0, len(word), self.inner, self.last, self.reach
        while at < n:
            hit = last.get(word[at:]) if n - at <= self.longest_last else None
            if hit is not None:
                out.append(hit)
                break
            # no token with these first two letters is longer; the last letter belongs to a token with the end
            for k in range(min(reach.get(word[at:at + 2], 1), n - at - 1), 0, -1):
                hit = inner.get(word[at:at + k])
                if hit is not None:
                    break
            if hit is None:
                raise ValueError(f"no token for {word[at:at + 1]!r}")
            out.append(hit)
            at += k
        return out

    def merge(self, words: list[str]) -> list[list[int]]:
        """Exact merging of all ``words`` side by side: per round each joins its leftmost pair of lowest rank."""
        vocab, never = self.vocab, self.never
        done: list[list[int]] = [[]] * len(words)
        ids = np.fromiter(chain.from_iterable([vocab[c] for c in w[:-1]] + [vocab[w[-1] + END]] for w in words), np.int64)
        size = np.array([len(w) for w in words], np.int64)
        word = np.arange(len(words))
        first = np.cumsum(size) - size
        rank = np.full(len(ids), never)                  # of the pair that starts here; never at a word's end
        rank[:-1] = self._rule_rank(ids[:-1], ids[1:])
        rank[first + size - 1] = never
        while len(word):
            low = np.minimum.reduceat(rank, first)
            ended = low == never
            if ended.any():
                for i in np.flatnonzero(ended):
                    done[word[i]] = ids[first[i]:first[i] + size[i]].tolist()
                stay = np.repeat(~ended, size)
                ids, rank, word, size, low = ids[stay], rank[stay], word[~ended], size[~ended], low[~ended]
                first = np.cumsum(size) - size
                if not len(word):
                    break
            hits = np.flatnonzero(rank == np.repeat(low, size))
            owner = np.searchsorted(first, hits, "right") - 1
            at = hits[np.concatenate([[True], owner[1:] != owner[:-1]])]
            ids[at] = self.made[low]
            drop = np.ones(len(ids), bool)
            drop[at + 1] = False
            last = at + 2 == first + size                # nothing follows in the word
            ids, rank = ids[drop], rank[drop]
            size = size - 1
            first = np.cumsum(size) - size
            at = at - np.arange(len(at))
            rank[at] = never
            after = at[~last]
            rank[after] = self._rule_rank(ids[after], ids[after + 1])
            before = at[at > first] - 1
            rank[before] = self._rule_rank(ids[before], ids[before + 1])
        return done

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words (as byte letters): propose, verify all pairs at once, repair."""
        proposed = [self._propose(w) for w in words]
        lengths = np.fromiter(map(len, proposed), np.int64, len(words))
        flat = np.fromiter(chain.from_iterable(proposed), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pair, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        good = self.compatible(pair // self.size, pair % self.size)[back]
        bad = np.unique(owner[inner[~good]]).tolist()
        if bad:
            for i, ids in zip(bad, self.merge([words[i] for i in bad])):
                proposed[i] = ids
        self.proposed += len(words)
        self.failed += len(bad)
        return proposed

    def _letters(self, chunk: str) -> list[str | int]:
        """The words of a piece of text without white space, as byte letters; added tokens as ids."""
        if chunk.isascii() and chunk.isalpha():      # one word, its letters are their own bytes
            return [chunk.lower()]
        parts = self.special.split(chunk) if self.special and "<" in chunk else [chunk]
        out: list[str | int] = []
        for p in parts:
            if p in self.added:
                out.append(self.added[p])
            elif p.isascii():
                found = self.words(p.lower())
                out += found if p.isprintable() else [w.translate(self.letters) for w in found]
            else:                                    # lower() treats a final sigma apart, the library doesn't
                if not unicodedata.is_normalized("NFC", p):
                    p = unicodedata.normalize("NFC", p)
                p = p.replace("\u03a3", "\u03c3").lower()
                out += [w.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters) for w in self.words(p)]
        return out

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The texts' ids end to end, and how many each has.

        Pieces are split at ASCII white space; other white space in a piece is dropped by the word pattern."""
        split = pc.ascii_split_whitespace(texts)
        pieces = split.flatten().dictionary_encode()
        chunks = pieces.dictionary.to_pylist()
        if len(self.known.place) > KNOWN_LIMIT:
            self.known, self.known_words = self.known.only([c for c in chunks if c in self.known.place]), Ragged()
        new = [c for c in chunks if c not in self.known.place]
        if new:
            parts = [self._letters(c) for c in new]
            flat = list(chain.from_iterable(parts))
            missing = set(flat) - self.known_words.place.keys()
            words = [w for w in missing if isinstance(w, str)]
            if words:
                ids = self.encode_words(words)
                size = np.fromiter(map(len, ids), np.int64, len(ids))
                self.known_words.add(words, np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum())), size)
            ids = [w for w in missing if isinstance(w, int)]         # added tokens
            self.known_words.add(ids, np.array(ids, np.int64), np.ones(len(ids), np.int64))
            at = self.known_words.places(flat, len(flat))
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            total = np.concatenate([[0], np.cumsum(self.known_words.size[at])])[ends]
            self.known.add(new, self.known_words.take(at), np.diff(total, prepend=0))
        at = self.known.places(chunks, len(chunks))[pieces.indices.to_numpy()]
        total = np.concatenate([[0], np.cumsum(self.known.size[at])])
        offsets = split.offsets.to_numpy()
        return self.known.take(at), np.diff(total[offsets - offsets[0]])

    def decode_batch(self, ids: pa.ListArray) -> pa.Array:
        """The tokens, special ones too, with a space between (the file names no decoder)."""
        tokens = pa.array(self.tokens, pa.string()).take(ids.values)
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, tokens), " ")


_MODELS: dict[str, WordBpe] = {}


def model_of(vocabulary: str) -> WordBpe:
    """One model per worker process and tokenizer file."""
    if vocabulary not in _MODELS:
        _MODELS.clear()
        _MODELS[vocabulary] = WordBpe(vocabulary)
    return _MODELS[vocabulary]


def _run(shipped, text_at: int, with_decoded: bool, group_bytes: int = 1 << 22):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(shipped.value)
        gc.freeze()                                  # the model's tables hold no cycles: not worth walking again
        for batch in batches:
            column, a = pc.fill_null(batch.column(text_at), ""), 0
            size = pc.binary_length(column).to_numpy()
            while a < len(column):                   # by bytes, at least one text
                n = max(1, int(np.searchsorted(np.cumsum(size[a:]), group_bytes)))
                texts = column.slice(a, n)
                ids, lengths = model.encode_batch(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(ids))
                out = [*batch.slice(a, len(texts)).columns, lists]
                if with_decoded:
                    out.append(model.decode_batch(lists))
                yield pa.RecordBatch.from_arrays(out, names=[f"c{i}" for i in range(len(out))])
                a += len(texts)

    return run


def encode(docs: DataFrame, *, text_col: str = "text", vocabulary_path: str | None = None, ids_col: str = "ids",
           decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the token ids of the text and, if asked for, the text decoded from them."""
    spark = docs.sparkSession
    prepare(spark)
    vocabulary = read_text(vocabulary_path or tokenizer_file("word_bpe_49k.json"))
    shipped = spark.sparkContext.broadcast(vocabulary)               # one tokenizer file
    new = [ids_col] + [decoded_col] * (decoded_col is not None)
    keep = [c for c in docs.columns if c.lower() not in {n.lower() for n in new} or c == text_col]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep])
    fields = [T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(rows.schema.fields)]
    fields += [T.StructField(f"c{len(keep)}", T.ArrayType(T.IntegerType(), True))]
    fields += [T.StructField(f"c{len(keep) + 1}", T.StringType())] * (decoded_col is not None)
    out = rows.mapInArrow(_run(shipped, keep.index(text_col), decoded_col is not None), T.StructType(fields))
    return out.toDF(*keep, *new)
