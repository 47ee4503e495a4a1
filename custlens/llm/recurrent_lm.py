"""A gated recurrent language model over whole documents.

Tokens are words and one end per document. The output is factored by class: frequent words are grouped into classes of
equal size by frequency, and a word's probability is that of its class times its share in the class, both given the
state. All other words fall into classes by their shape (length, last character, letters beyond ASCII); there the share of a
word is its count in the training documents plus one, over the class, so every corpus count enters the score. A
document is scored from its first token to its end: the state is carried across the windows in which it is worked on.

Counts come from all training documents. Every document is then encoded once; training and scoring read the written
symbols. The weights are trained in tasks, each on its own documents by truncated backpropagation, and averaged after
every round; each training document takes part in one of the rounds (``share`` of them where that is set lower), so
training grows with the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.llm.arrow import pieces, table, utf8
from custlens.session import stage

END = b""  # no word is empty

_LETTER = np.zeros(256, np.int64)
_LETTER[list(b".")] = 1
_LETTER[list(b",")] = 2
_LETTER[list(b"!?;:\"')]|*#%&$")] = 3
SHAPES = 24
_TOP = np.float32(60)  # states are bounded, so logits stay far below; exp must not overflow
HASHED_WORDS = 500_000  # of a shuffle partition: a hash table of some 50 MB by estimate
_TRAINING_TOKENS = 400_000  # that share the lanes of a batch


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space, A-Z in lower case, each text's end behind its words; how many tokens each text has."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    words = split.flatten().cast(pa.binary())
    here = np.flatnonzero(pc.binary_length(words))  # white space at the ends of a text leaves empty words
    number = np.diff(np.searchsorted(here, split.offsets)) + 1
    place = np.full(len(here) + len(number), len(words))  # of the end
    is_word = np.ones(len(place), bool)
    is_word[np.cumsum(number) - 1] = False
    place[is_word] = here
    return pa.concat_arrays([words, pa.array([END], pa.binary())]).take(pa.array(place)), number


def shapes(words: pa.Array) -> np.ndarray:
    """Classes of words outside the vocabulary; the end counts as a short one."""
    data, starts = utf8(words)
    long, ends = np.diff(starts), starts[1:]
    beyond = np.concatenate([[0], np.cumsum(data > 127)])
    size = (long > 7).astype(np.int64) + (long > 12)
    last = _LETTER[np.append(data, np.uint8(0))[ends - 1]]
    return np.where(long > 0, (size * 4 + last) * 2 + (beyond[ends] > beyond[starts[:-1]]), 0)


@dataclass
class Settings:
    words_per_class: int = 50
    classes: int = 40
    hidden: int = 24
    lookup: int = 50_000  # words whose counts are sent to every task; the others meet their counts in a join
    share: float = 1.0  # of the training documents, for the weights
    rounds: int = 2
    batch: int = 256  # lanes side by side
    window: int = 16
    rate: float = 0.03


@dataclass
class Vocabulary:
    """Frequent words in order of frequency, with counts; what a task needs to know of all others."""

    settings: Settings
    words: list[bytes]
    counts: list[int]
    total: int
    distinct: int
    rest: np.ndarray  # log of count and distinct words of each shape, plus one
    mass: np.ndarray  # tokens by shape

    def __post_init__(self):
        s = self.settings
        self.n = min(len(self.words), s.classes * s.words_per_class)
        self.symbols = s.classes * s.words_per_class + SHAPES
        first = s.classes * s.words_per_class
        # Codes below ``symbols`` are frequent words or bare shapes; above, other words of known count.
        self.listed = pa.array(self.words, pa.binary())
        extra = self.listed[self.n :]
        self.code = np.concatenate([np.arange(self.n), self.symbols + np.arange(len(extra)), [-1]])
        c = np.array(self.counts, float)
        self.log_count = np.zeros(self.symbols + len(extra))
        self.log_count[: self.n] = np.log10(c[: self.n] + 1)
        self.log_count[self.symbols :] = np.log10(c[self.n :] + 1)
        self.is_known = np.zeros(self.symbols + len(extra), bool)
        self.is_known[: self.n] = self.is_known[self.symbols :] = True
        self.symbol = np.arange(self.symbols + len(extra))
        self.symbol[self.symbols :] = first + shapes(extra)
        self.kind = np.int16 if self.symbols < 1 << 14 else np.int32  # of written symbols
        self.base_norm = np.log10(self.total + self.distinct + 1)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Codes of tokens; which of them are outside the lookup."""
        out = self.code[pc.fill_null(pc.index_in(words, value_set=self.listed), -1).to_numpy()]
        missing = out < 0
        out[missing] = self.symbols - SHAPES + shapes(words.filter(pa.array(missing)))
        return out, missing


class Network:
    """Gated recurrent units with a class-factored output, in numpy."""

    NAMES = ("embed", "wx", "wh", "bias", "wc", "bc", "wo", "bo")

    def __init__(self, vocabulary: Vocabulary):
        s = vocabulary.settings
        h, c, m = s.hidden, s.classes, s.words_per_class
        draw = np.random.default_rng(11)
        self.classes, self.size, self.hidden = c, m, h
        self.embed = draw.normal(0, 0.3, (vocabulary.symbols, h)).astype(np.float32)
        self.wx = draw.normal(0, h**-0.5, (h, 3 * h)).astype(np.float32)
        self.wh = draw.normal(0, h**-0.5, (h, 3 * h)).astype(np.float32)
        self.bias = np.zeros(3 * h, np.float32)
        counts = np.zeros(c * m)
        counts[: vocabulary.n] = np.array(vocabulary.counts[: vocabulary.n], float) + 1
        by_class = counts.reshape(c, m)
        mass = np.concatenate([by_class.sum(axis=1), vocabulary.mass + 1])
        # Without training the model is the corpus' own word frequencies.
        self.bc = np.log(np.maximum(mass, 1e-6) / mass.sum()).astype(np.float32)
        self.bo = np.log(np.maximum(by_class, 1e-6) / np.maximum(by_class.sum(axis=1, keepdims=True), 1e-6)).astype(np.float32)
        self.wc = np.zeros((h, c + SHAPES), np.float32)
        self.wo = np.zeros((c, h, m), np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def set_flat(self, values: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, values[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        first = self.classes * self.size
        return np.where(symbols < first, symbols // self.size, self.classes + symbols - first)

    def step(self, gates: np.ndarray, h: np.ndarray):
        """Next state from the input's gates (bias included) and the state. Fastest where columns are contiguous."""
        n = self.hidden
        u = (self.wh.T @ h.T).T
        zr = gates[:, : 2 * n] + u[:, : 2 * n]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += np.float32(1)
        np.reciprocal(zr, out=zr)
        z, r = zr[:, :n], zr[:, n:]
        new = r * u[:, 2 * n :]
        new += gates[:, 2 * n :]
        np.tanh(new, out=new)
        out = h - new
        out *= z
        out += new
        return out, z, r, new, u[:, 2 * n :]

    def log_probability(self, states: np.ndarray, symbols: np.ndarray, gradient=None) -> np.ndarray:
        """Natural log probability of each symbol (of its class only, for shapes); adds gradients of the negated sum."""
        states = np.ascontiguousarray(states)
        e = states @ self.wc
        e += self.bc
        reach = max(states.max(initial=0), -states.min(initial=0))  # of a state; mostly it tells that no logit needs the bound
        if (np.abs(self.wc).sum(axis=0) * reach + self.bc).max() > _TOP - 1:
            np.minimum(e, _TOP, out=e)
        kind = self.class_of(symbols)
        chosen = np.arange(len(symbols)) * e.shape[1] + kind  # place in the flat array
        out = e.ravel()[chosen].astype(np.float64)
        np.exp(e, out=e)
        total = e @ np.ones(e.shape[1], np.float32)  # a product is the faster sum over short rows
        out -= np.log(total)
        back = None
        if gradient is not None:
            e /= total[:, None]
            e.ravel()[chosen] -= 1
            gradient["wc"] += states.T @ e
            gradient["bc"] += np.ones(len(e), np.float32) @ e
            back = e @ self.wc.T
        # Words inside their classes: rows in order of class, so that a class is one product and the rest is done for all at once.
        order = np.argsort(kind.astype(np.int16 if self.classes < 1 << 14 else np.int64), kind="stable")
        of_class = kind.take(order)
        edges = np.searchsorted(of_class, np.arange(self.classes + 1)).tolist()
        order, of_class = order[: edges[-1]], of_class[: edges[-1]]
        own = states.take(order, axis=0)
        spans = [(c, slice(*edges[c : c + 2])) for c in range(self.classes) if edges[c] < edges[c + 1]]
        e = np.empty((len(order), self.size), np.float32)
        for c, here in spans:
            np.matmul(own[here], self.wo[c], out=e[here])
        e += self.bo.take(of_class, axis=0)
        if (np.abs(self.wo).sum(axis=1) * reach + self.bo).max() > _TOP - 1:
            np.minimum(e, _TOP, out=e)
        chosen = np.arange(len(order)) * self.size + (symbols.take(order) - of_class * self.size)
        found = e.ravel()[chosen].astype(np.float64)
        np.exp(e, out=e)
        total = e @ np.ones(self.size, np.float32)
        found -= np.log(total)
        out[order] += found
        if gradient is not None and spans:
            e /= total[:, None]
            e.ravel()[chosen] -= 1
            below = np.empty_like(own)
            wo, bo = gradient["wo"], gradient["bo"]
            for c, here in spans:
                part = e[here]
                wo[c] += own[here].T @ part
                bo[c] += np.add.reduce(part, axis=0)
                np.matmul(part, self.wo[c].T, out=below[here])
            back[order] += below
        return out if gradient is None else (out, back)

    def score(self, documents: list[np.ndarray], rows: int = 16_384) -> np.ndarray:
        """Natural log probability of each document (an array of symbols)."""
        lengths = np.array([len(d) for d in documents], np.int64)
        order = np.argsort(-lengths, kind="stable")
        sorted_lengths = lengths[order]
        flat = np.concatenate([documents[i] for i in order]) if len(order) else np.zeros(0, np.int64)
        starts = np.cumsum(sorted_lengths) - sorted_lengths
        inputs = self.embed @ self.wx + self.bias
        h = np.zeros((self.hidden, len(order)), np.float32).T
        total = np.zeros(len(order))
        at, longest = 0, int(sorted_lengths[0]) if len(order) else 0
        every, actives = np.arange(len(order)), np.searchsorted(-sorted_lengths, -np.arange(longest), side="left").tolist()
        while at < longest:
            held, targets, owners, kept = [], [], [], 0
            while at < longest and kept < rows:
                active = actives[at]
                place = starts[:active] + at
                gates = np.asfortranarray(inputs.take(flat[place - 1], axis=0)) if at else np.broadcast_to(self.bias, (active, len(self.bias)))
                h = self.step(gates, h[:active])[0]
                held.append(h)
                targets.append(flat[place])
                owners.append(every[:active])
                kept += active
                at += 1
            found = self.log_probability(np.concatenate(held), np.concatenate(targets))
            total += np.bincount(np.concatenate(owners), weights=found, minlength=len(total))
        out = np.empty(len(order))
        out[order] = total
        return out

    def train(self, documents: list[np.ndarray], settings: Settings, moments: dict) -> None:
        """One pass over documents, put one behind the other and cut into lanes of equal length, a window at a time.

        The state is carried from window to window, gradients are not; a document starts with an empty state. Where the
        cut between two lanes goes through a document, the second one knows the token before it and no state. Lanes are
        at least 16 windows long, so that few documents still give that many steps.
        """
        # In a drawn order: lanes that end in short documents alone would leave the weights fitted to those.
        order = np.random.default_rng(3).permutation(len(documents))
        stream = np.concatenate([documents[i] for i in order])
        ends = np.cumsum([len(documents[i]) for i in order])
        told = np.concatenate([[-1], stream[:-1]])  # the token before, if it is of the same document
        told[ends[:-1]] = -1
        lanes = min(settings.batch, max(1, len(stream) // (16 * settings.window)))
        longest = -(-len(stream) // lanes)
        blank = lanes * longest - len(stream)
        everything = np.concatenate([stream, np.full(blank, -1)]).reshape(lanes, longest).T
        before = np.concatenate([told, np.full(blank, -1)]).reshape(lanes, longest).T
        h = np.zeros((lanes, self.hidden), np.float32)
        for low in range(0, longest, settings.window):
            h = self._window(everything[low : low + settings.window], before[low : low + settings.window], h, settings.rate, moments)

    def _window(self, symbols: np.ndarray, before: np.ndarray, h: np.ndarray, rate: float, moments: dict) -> np.ndarray:
        """Fit one window (steps, lanes), with -1 for what is not there; the state behind it."""
        steps, lanes = symbols.shape
        n = self.hidden
        going_on = (before >= 0).astype(np.float32)
        told = np.concatenate([self.embed, np.zeros((1, n), np.float32)]).take(before, axis=0)
        # (step, feature, lane): what a step works on is contiguous.
        gates = self.wx.T @ told.transpose(0, 2, 1)
        gates += self.bias[:, None]
        states, saved = np.empty((steps, n, lanes), np.float32), []
        inputs = np.empty((steps, n, lanes), np.float32)
        h = h.T
        for t in range(steps):
            h = np.multiply(h, going_on[t], out=inputs[t])
            new_h, z, r, new, u = self.step(gates[t].T, h.T)
            saved.append((z.T, r.T, new.T, u.T))
            states[t] = h = new_h.T
        gradient = {name: np.zeros_like(getattr(self, name)) for name in ("wc", "bc", "wo", "bo")}
        seen = np.flatnonzero(symbols.ravel() >= 0)
        here = slice(None) if len(seen) == symbols.size else seen
        _, back = self.log_probability(states.transpose(0, 2, 1).reshape(-1, n)[here], symbols.ravel()[here], gradient)
        if len(seen) == symbols.size:
            d_states = back
        else:
            d_states = np.zeros((steps * lanes, n), np.float32)
            d_states[seen] = back
        d_states = np.ascontiguousarray(d_states.reshape(steps, lanes, n).transpose(0, 2, 1))
        d_gates = np.empty((steps, 3 * n, lanes), np.float32)
        d_inner = np.empty((steps, 3 * n, lanes), np.float32)
        carry = np.zeros((n, lanes), np.float32)
        for t in reversed(range(steps)):
            z, r, new, u = saved[t]
            d = np.add(d_states[t], carry, out=carry)
            d_z = d * z  # the state's own part, then the gate's
            out, inner = d_gates[t], d_inner[t]
            d_new = np.multiply(d - d_z, 1 - new * new, out=out[2 * n :])
            np.multiply(d_z * (inputs[t] - new), 1 - z, out=out[:n])
            np.multiply(d_new * u * r, 1 - r, out=out[n : 2 * n])
            inner[: 2 * n] = out[: 2 * n]
            np.multiply(d_new, r, out=inner[2 * n :])
            carry = self.wh @ inner
            carry += d_z
            carry *= going_on[t]
        gradient["wh"] = (inputs @ d_inner.transpose(0, 2, 1)).sum(axis=0)
        gradient["bias"] = (d_gates @ np.ones(lanes, np.float32)).sum(axis=0)
        gradient["wx"] = (told.transpose(0, 2, 1) @ d_gates.transpose(0, 2, 1)).sum(axis=0)
        d_told = (self.wx @ d_gates).transpose(0, 2, 1).reshape(-1, n)
        flat = before.ravel()
        by_row = np.argsort(flat.astype(np.int16 if len(self.embed) < 1 << 15 else np.int64), kind="stable")
        flat = flat.take(by_row)
        # Sums over runs of equal symbols; the run before all others stands for no symbol.
        firsts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        firsts = firsts[flat[firsts] >= 0]
        rows = flat[firsts]
        gradient["embed"], gradient["rows"] = np.zeros_like(self.embed), rows
        if len(rows):
            gradient["embed"][rows] = np.add.reduceat(d_told.take(by_row, axis=0), firsts, axis=0)
        self._update(gradient, len(seen), rate, moments)
        return h.T

    def _update(self, gradient: dict, n: int, rate: float, moments: dict) -> None:
        """A step of Adam. Words that did not occur in the window keep their embedding and its moments."""
        moments["step"] = step = moments.get("step", 0) + 1
        scale = np.float32(rate / (1 - 0.9**step))
        spread = np.float32(1 / (1 - 0.99**step))
        for name in self.NAMES:
            weights = getattr(self, name)
            if name not in moments:
                moments[name] = (np.zeros_like(weights), np.zeros_like(weights))
            m_all, v_all = moments[name]
            place = gradient["rows"] if name == "embed" else slice(None)
            g, m, v = gradient[name][place], m_all[place], v_all[place]
            g /= np.float32(max(n, 1))
            step = g - m
            step *= np.float32(0.1)
            m += step
            g *= g
            np.subtract(g, v, out=step)
            step *= np.float32(0.01)
            v += step
            if name == "embed":
                m_all[place], v_all[place] = m, v
            root = np.multiply(v, spread, out=step)
            np.sqrt(root, out=root)
            root += np.float32(1e-6)
            change = np.multiply(m, scale, out=g)
            change /= root
            weights[place] -= change


def word_counts(docs: DataFrame, text_col: str = "text", most_bytes: int = 32_000_000) -> DataFrame:
    """``word`` (bytes; empty for the end), ``c`` over all rows of ``docs``, added up in the tasks first."""

    def count(batches):
        held, size = [], 0
        for batch in chain((p for b in batches for p in pieces(b, "_text")), [None]):
            if batch is not None:
                held.append(tokens(batch.column(0))[0])
                size += held[-1].nbytes
            if held and (batch is None or size >= most_bytes):
                found = pc.value_counts(pa.chunked_array(held))
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], names=["word", "c"])
                held, size = [], 0

    partial = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(count, "word binary, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, settings: Settings) -> list:
    """At most ``lookup`` rows of the most frequent words, most frequent first.

    A histogram of the counts (32 classes to a doubling) gives the least count that fits, so that no more rows than these come
    to the driver. The words of the model itself are complete in any case.
    """
    octave = F.floor(F.log2("c") * 32).cast("int")
    least, held = None, 0
    for r in sorted(counts.groupBy(octave.alias("k")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.k):
        if held + r.n > settings.lookup:
            break
        least, held = r.k, held + r.n
    needed = min(settings.lookup, settings.classes * settings.words_per_class)
    if held >= needed:
        return sorted(counts.filter(octave >= least).collect(), key=lambda r: (-r.c, bytes(r.word)))
    return counts.orderBy(F.desc("c"), "word").limit(needed).collect()


def vocabulary_of(counts: DataFrame, settings: Settings) -> Vocabulary:
    """The most frequent words (a bounded number) and the totals of all others by shape."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = frequent_words(counts, settings)
    words, numbers = [bytes(r.word) for r in top], [r.c for r in top]
    schema = pa.schema([("shape", pa.int32()), ("c", pa.int64()), ("n", pa.int64())])

    def by_shape(batches):
        sums, n = np.zeros(SHAPES, np.int64), np.zeros(SHAPES, np.int64)
        for batch in batches:
            kind = shapes(batch.column(0))
            np.add.at(sums, kind, batch.column(1).to_numpy())
            n += np.bincount(kind, minlength=SHAPES)
        yield table(schema, shape=list(range(SHAPES)), c=sums, n=n)

    rest = np.zeros((SHAPES, 2))
    for s, c, n in counts.mapInArrow(by_shape, "shape int, c long, n long").groupBy("shape").agg(F.sum("c"), F.sum("n")).collect():
        rest[s] = c, n
    frequent = words[: settings.classes * settings.words_per_class]
    for s, c in zip(shapes(pa.array(frequent, pa.binary())).tolist(), numbers):
        rest[s] -= c, 1
    return Vocabulary(settings, words, numbers, total, distinct, np.log10(rest.sum(axis=1) + 1), rest[:, 0])


def drawn(texts: DataFrame, settings: Settings, number: int) -> DataFrame:
    """The texts of a round; rounds share none, and together they have ``share`` of all."""
    low, high = (settings.share / settings.rounds * (number + i) * 1_000_000 for i in (0, 1))
    return texts.filter((F.col("_draw") >= low) & (F.col("_draw") < high))


def encoded_documents(docs: DataFrame, vocabulary: Vocabulary, id_col: str, text_col: str) -> DataFrame:
    """All documents as symbols (integers of the vocabulary's kind, in bytes), with what does not depend on the state; written once.

    ``_draw`` places a training document in a round. ``rest`` holds the words outside the lookup and how often they occur.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_col].dataType.simpleString()
    columns = (
        f"_row long, _id {kind}, held_out boolean, _draw long, n_tokens long, n_known long, base double, within double, symbols binary, "
        "rest array<struct<word: binary, n: int>>"
    )

    def run(batches):
        words = shared.value
        first = TaskContext.get().partitionId() << 33
        for batch in (p for b in batches for p in pieces(b, "_text")):
            told, n_tokens = tokens(batch.column(3))
            codes, missing = words.encode(told)
            starts = np.cumsum(n_tokens) - n_tokens
            logs = words.log_count[codes]
            chosen = words.symbol[codes]
            others = chosen >= words.symbols - SHAPES
            n_known = np.add.reduceat(words.is_known[codes], starts, dtype=np.int64)
            base = np.add.reduceat(logs, starts) - n_tokens * words.base_norm
            logs[others] -= words.rest[chosen[others] - (words.symbols - SHAPES)]
            logs[~others] = 0
            within = np.add.reduceat(logs, starts)
            edges = np.append(starts, len(codes)).astype(np.int32) * np.dtype(words.kind).itemsize
            symbols = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(edges), pa.py_buffer(chosen.astype(words.kind))])
            # Words outside the lookup, counted by document.
            unknown = told.filter(pa.array(missing)).dictionary_encode()
            distinct = max(len(unknown.dictionary), 1)
            owners = np.repeat(np.arange(batch.num_rows), n_tokens)[missing]
            keys, times = np.unique(owners * distinct + unknown.indices.to_numpy(), return_counts=True)
            ends = np.searchsorted(keys, np.arange(batch.num_rows + 1) * distinct)
            rows = np.arange(first, first + batch.num_rows)
            first += batch.num_rows
            rare = unknown.dictionary.take(pa.array(keys % distinct))
            entries = pa.StructArray.from_arrays([rare, pa.array(times, pa.int32())], names=["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows, pa.int64()), batch.column(0), batch.column(1), batch.column(2), pa.array(n_tokens, pa.int64()),
                    pa.array(n_known, pa.int64()), pa.array(base, pa.float64()), pa.array(within, pa.float64()),
                    symbols, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries),
                ],
                names=["_row", "_id", "held_out", "_draw", "n_tokens", "n_known", "base", "within", "symbols", "rest"],
            )

    draw = F.pmod(F.xxhash64(id_col, text_col), F.lit(1_000_000))
    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("held_out"), draw.alias("_draw"), F.col(text_col).cast("string").alias("_text"))
    encoded = stage(rows.mapInArrow(run, columns), "encoded", compression="zstd")
    shared.destroy()
    return encoded


def train_network(documents: DataFrame, vocabulary: Vocabulary) -> Network:
    """Rounds of training in tasks on ``(symbols, _draw)``; after each the weights are averaged by the number of tokens."""
    spark = documents.sparkSession
    settings = vocabulary.settings
    network = Network(vocabulary)
    flat = network.flat()
    block = 1024
    words = spark.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("block", pa.int32()), ("n", pa.int64()), ("w", pa.list_(pa.float64()))])
    for number in range(settings.rounds):
        now = spark.sparkContext.broadcast(flat)

        def run(batches, now=now):
            own = Network(words.value)
            own.set_flat(now.value)
            moments: dict = {}
            held: list[np.ndarray] = []
            n = waiting = 0
            for batch in batches:
                for symbols in batch.column(0):
                    held.append(np.frombuffer(symbols.as_py(), words.value.kind))
                    n, waiting = n + len(held[-1]), waiting + len(held[-1])
                    if waiting >= _TRAINING_TOKENS:
                        own.train(held, settings, moments)
                        held, waiting = [], 0
            if held:
                own.train(held, settings, moments)
            if n:
                trained = own.flat().astype(np.float64) * n
                parts = [trained[i : i + block] for i in range(0, len(trained), block)]
                yield table(schema, block=list(range(len(parts))), n=[n] * len(parts), w=parts)

        def add(group: pa.Table) -> pa.Table:
            n = sum(group.column("n").to_pylist())
            mean = np.sum(np.stack([np.asarray(x) for x in group.column("w").to_pylist()]), axis=0) / n
            return pa.Table.from_batches([table(schema, block=[group.column("block")[0].as_py()], n=[n], w=[mean])])

        averaged = drawn(documents, settings, number).select("symbols").mapInArrow(run, "block int, n long, w array<double>").groupBy("block").applyInArrow(add, "block int, n long, w array<double>")
        parts = sorted((r.block, r.w) for r in averaged.collect())  # the size of the model
        if parts:
            flat = np.concatenate([np.asarray(w) for _, w in parts]).astype(np.float32)
    network.set_flat(flat)
    return network


def held_out(id_col: str) -> Column:
    """Rows that are not learnt from. A null id reads as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def score_documents(docs: DataFrame, settings: Settings | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    Scores are log10 probabilities of the whole text: ``base_score`` by add-one counts, ``score`` by the network. Null and
    empty texts are an end alone. Repeated rows get the same. Without training documents every count is zero. No rows
    give no rows; other columns are not looked at.
    """
    settings = settings or Settings()
    spark = docs.sparkSession
    learnt = docs.filter(~held_out(id_col))
    counts = stage(word_counts(learnt, text_col), "word-counts", compression="zstd")
    vocabulary = vocabulary_of(counts, settings)
    encoded = encoded_documents(docs, vocabulary, id_col, text_col)
    network = train_network(encoded.filter(~F.col("held_out")), vocabulary)
    shared = spark.sparkContext.broadcast(network)
    kind = docs.schema[id_col].dataType.simpleString()

    symbol_kind = vocabulary.kind

    def run(batches):
        net = shared.value
        for batch in (p for b in batches for p in pieces(b, "symbols", 16_000_000)):
            symbols = [np.frombuffer(x.as_py(), symbol_kind) for x in batch.column(batch.num_columns - 1)]
            score = net.score(symbols) / np.log(10) + batch.column(batch.num_columns - 2).to_numpy()
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(score, pa.float64())], names=[*batch.schema.names[:-2], "score"])

    columns = f"_row long, _id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double"
    carried = encoded.select("_row", "_id", "held_out", "n_tokens", "n_known", "base", "within", "symbols")
    scored = stage(carried.mapInArrow(run, columns), "scored", compression="zstd")
    shared.destroy()
    # What is missing of words outside the lookup is the log of their counts plus one: nothing for a count of zero.
    # A hash table of few words spares sorting those of all documents; a large one could not be spilled.
    few = vocabulary.distinct <= HASHED_WORDS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    logs = counts.select("word", F.log10(F.col("c") + 1).alias("log"))
    rare = encoded.select("_row", F.inline("rest")).join(logs.hint("shuffle_hash") if few else logs, "word")
    found = rare.groupBy("_row").agg(F.sum(F.col("n") * F.col("log")).alias("_more"), F.sum("n").alias("_known"))
    more, known = F.coalesce("_more", F.lit(0.0)), F.coalesce("_known", F.lit(0))
    return scored.join(found, "_row", "left").select(
        F.col("_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + known).alias("n_known"),
        F.lit(int(vocabulary.total)).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
