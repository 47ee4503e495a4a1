"""Benchmark decontamination by winnowing.

Of every window of ``w`` neighbouring word k-grams the one with the smallest hash (the rightmost of equals) is a
fingerprint. Two texts that share ``w + k - 1`` words in a row share a whole window, and so its fingerprint. With k = 5
and w = 6 every shared window of ten words is found; documents are looked up by fingerprint and only around the hits
whole windows are compared, word by word. Items of fewer words have no such window: their n words are one n-gram,
looked up at every position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.llm.arrow import pieces, table, utf8
from custlens.session import stage

K, W = 5, 6
WINDOW = K + W - 1
BYTES_PER_SLICE = 16_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_INVERSE = pow(_BASE, -1, 1 << 64)


class Words:
    """Lower-cased words of many texts: ``starts`` and ``ends`` in the bytes, ``edges`` of each text in the words."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        low = _LOWER[data]
        inside = _WORD[low]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = offsets[:-1] < offsets[1:]
        at = offsets[:-1][filled]
        first[at] = inside[at]
        at = offsets[1:][filled] - 1
        last[at] = inside[at]
        self.low = low
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.edges = np.searchsorted(self.starts, offsets)

    @classmethod
    def _grow(cls, n: int) -> None:
        if len(cls._powers) <= n:
            for name, base in (("_powers", _BASE), ("_inverses", _INVERSE)):
                factors = np.full(n + 1, base, np.uint64)
                factors[0] = 1
                setattr(cls, name, np.cumprod(factors))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, from one running sum over the bytes. Equal hashes are only a hint."""
        self._grow(len(self.low))
        total = np.zeros(len(self.low) + 1, np.uint64)
        np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * self._powers[: len(self.low)], out=total[1:])
        hashed = (total[self.ends] - total[self.starts]) * self._inverses[self.starts]
        return (hashed ^ (hashed >> np.uint64(29))) * np.uint64(_STEP)

    def text(self, start: int, n: int) -> bytes:
        return b" ".join([self.low[a:b].tobytes() for a, b in zip(self.starts[start : start + n].tolist(), self.ends[start : start + n].tolist())])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; positions without n words behind them are left out."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + hashes[i : i + size]
    return (out ^ (out >> np.uint64(31))) * np.uint64(_STEP)


def fits(words: Words, n: int) -> np.ndarray:
    """Positions from which n words of the same text follow."""
    behind = np.repeat(words.edges[1:], np.diff(words.edges))
    return np.flatnonzero(behind - np.arange(len(behind)) >= n)


def winnow(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the chosen k-grams of the windows that begin at ``begins``, and their hashes."""
    if not len(begins):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = grams(hashes, K) & ~np.uint64(7)
    size = len(g) - W + 1
    least = g[W - 1 : W - 1 + size].copy()  # the low bits say how far left of the window's end
    for back in range(1, W):
        np.minimum(least, g[W - 1 - back : W - 1 - back + size] | np.uint64(back), out=least)
    chosen = np.unique(begins + W - 1 - (least[begins] & np.uint64(7)).astype(np.int64))
    return chosen, g[chosen]


class Windows:
    """Windows of benchmark items: their texts, the items they occur in, and their fingerprints."""

    def __init__(self, found: pa.Table):
        self.items: dict[bytes, list[str]] = {}
        self.short: dict[int, np.ndarray] = {}
        sizes: dict[int, list[bytes]] = {}
        for window, n, item in zip(found.column("window").to_pylist(), found.column("n").to_pylist(), found.column("item").to_pylist()):
            text = window.encode()
            if text not in self.items:
                self.items[text] = []
                sizes.setdefault(n, []).append(text)
            self.items[text].append(item)
        self.fingerprints = np.zeros(0, np.uint64)
        for n, texts in sizes.items():
            words = Words(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
            hashes = words.hashes()
            if n == WINDOW:
                self.fingerprints = np.unique(winnow(hashes, words.edges[:-1])[1])
            else:
                self.short[n] = np.unique(grams(hashes, n)[words.edges[:-1]])

    def occurrences(self, words: Words) -> dict[int, int]:
        """Begin of every window in the texts that is a window of an item, and its number of words."""
        hashes = words.hashes()
        found: dict[int, int] = {}
        begins = fits(words, WINDOW)
        if len(self.fingerprints) and len(begins):
            chosen, marks = winnow(hashes, begins)
            hits = chosen[_among(marks, self.fingerprints)]
            near = np.unique((hits[:, None] - np.arange(W)[None, :]).ravel())
            possible = np.zeros(len(hashes) + 1, bool)
            possible[begins] = True
            near = near[near >= 0]
            for at in near[possible[near]].tolist():
                if words.text(at, WINDOW) in self.items:
                    found[at] = WINDOW
        shorter: dict[int, list[int]] = {}
        for n, marks in self.short.items():
            begins = fits(words, n)
            if len(begins):
                for at in begins[_among(grams(hashes, n)[begins], marks)].tolist():
                    if words.text(at, n) in self.items:
                        shorter.setdefault(at, []).append(n)
        return found, shorter


def _among(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are in the ascending array; a bit table of their high bits turns most away."""
    high = np.zeros(1 << 20, bool)
    high[(ascending >> np.uint64(44)).astype(np.int64)] = True
    maybe = np.flatnonzero(high[(values >> np.uint64(44)).astype(np.int64)])
    place = np.minimum(np.searchsorted(ascending, values[maybe]), len(ascending) - 1)
    out = np.zeros(len(values), bool)
    out[maybe] = ascending[place] == values[maybe]
    return out


def scan(batch: pa.RecordBatch, windows: Windows, text_col: str):
    """Per row: number of words, ascending disjoint stretches of hit words, and the items."""
    data, offsets = utf8(batch.column(batch.schema.get_field_index(text_col)))
    words = Words(data, offsets)
    long, short = windows.occurrences(words)
    spans = sorted([(at, n) for at, n in long.items()] + [(at, n) for at, sizes in short.items() for n in sizes])
    rows = np.searchsorted(words.edges, [at for at, _ in spans], side="right") - 1
    runs: list[list[list[int]]] = [[] for _ in range(batch.num_rows)]
    items: list[set[str]] = [set() for _ in range(batch.num_rows)]
    for (at, n), row in zip(spans, rows.tolist()):
        items[row].update(windows.items[words.text(at, n)])
        begin = at - int(words.edges[row])
        mine = runs[row]
        if mine and begin <= mine[-1][1]:
            mine[-1][1] = max(mine[-1][1], begin + n)
        else:
            mine.append([begin, begin + n])
    return np.diff(words.edges), runs, items


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``window`` (its words, joined by spaces), ``n`` words, ``item`` (id as text), each once."""
    schema = pa.schema([("window", pa.string()), ("n", pa.int32()), ("item", pa.string())])

    def cut(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                words = Words(*utf8(part.column(1)))
                for item, a, b in zip(part.column(0).to_pylist(), words.edges[:-1].tolist(), words.edges[1:].tolist()):
                    n = min(WINDOW, b - a)
                    for low in range(a, b - n + 1, 4096) if n else ():
                        texts = [words.text(i, n).decode() for i in range(low, min(low + 4096, b - n + 1))]
                        yield table(schema, window=texts, n=[n] * len(texts), item=[item] * len(texts))

    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_item"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(cut, "window string, n int, item string").distinct()


def _slices(benchmark: DataFrame) -> list[Windows]:
    """All windows, in as many parts as keep each below a fixed number of bytes, so that each can be broadcast."""
    found = stage(benchmark_windows(benchmark), "windows")
    size = found.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 64)).first()[0] or 0
    n = -(-size // BYTES_PER_SLICE)
    for i in range(n):
        part = F.pmod(F.xxhash64("window", "item"), F.lit(n)) == i
        yield Windows(found.filter(part).toArrow())


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``runs``.

    ``runs`` are the stretches of hit words (from, to). Null and empty texts have no words; items without words or
    with a null text have no window; a null item id reads as the empty string; repeated items count once. An empty
    benchmark leaves every document clean. Other columns are not looked at. The benchmark is broadcast in slices of
    bounded size, one pass over the documents for each.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    columns = f"_id {kind}, _text string, n_words long, runs array<array<long>>, items array<string>"
    nothing = "CAST(0 AS LONG) AS n_words", "CAST(array() AS array<array<long>>) AS runs", "CAST(array() AS array<string>) AS items"
    state = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).selectExpr("*", *nothing)
    empty = Windows(pa.table({"window": pa.array([], pa.string()), "n": pa.array([], pa.int32()), "item": pa.array([], pa.string())}))

    def marked(state: DataFrame, shared: Broadcast) -> DataFrame:
        def mark(batches):
            for batch in batches:
                for part in pieces(batch, "_text"):
                    n_words, runs, items = scan(part, shared.value, "_text")
                    old_runs, old_items = part.column(3).to_pylist(), part.column(4).to_pylist()
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            part.column(1),
                            pa.array(n_words, pa.int64()),
                            pa.array([_union(a, b) if a else b for a, b in zip(old_runs, runs)], pa.list_(pa.list_(pa.int64()))),
                            pa.array([sorted(b.union(a)) for a, b in zip(old_items, items)], pa.list_(pa.string())),
                        ],
                        names=["_id", "_text", "n_words", "runs", "items"],
                    )

        return state.mapInArrow(mark, columns)

    shared = None
    for windows in _slices(benchmark):
        if shared is not None:
            state = stage(state, "hits", compression="zstd")
            shared.destroy()  # written: nothing reads this slice again
        shared = spark.sparkContext.broadcast(windows)
        state = marked(state, shared)
    if shared is None:
        state = marked(state, spark.sparkContext.broadcast(empty))
    return state.select(
        F.col("_id").alias(id_col),
        "n_words",
        F.aggregate("runs", F.lit(0).cast("long"), lambda total, run: total + run[1] - run[0]).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.concat_ws(",", "items"), "UTF-8"), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        "runs",
    )


def _union(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted(map(tuple, [*a, *b])):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, columns unchanged.

    What is left after a slice of the benchmark is written before the next slice is broadcast, so that one slice is held
    at a time. Null and empty texts stay; an empty benchmark leaves all rows.
    """
    spark = docs.sparkSession
    shared = None
    for windows in _slices(benchmark):
        if shared is not None:
            docs = stage(docs, "clean", compression="zstd")
            shared.destroy()  # written: nothing reads this slice again
        shared = spark.sparkContext.broadcast(windows)

        def clean(batches, shared=shared):
            for batch in batches:
                for part in pieces(batch, text_col):
                    _, runs, _ = scan(part, shared.value, text_col)
                    yield part.filter(pa.array([not r for r in runs], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
