"""Secrets in texts: fixed patterns, and probabilistic automata inferred from what the patterns find.

The base patterns find credentials whose surroundings or prefix give them away. They are the labelled examples of a
grammar: for each kind a prefix tree of their character classes is built and states with statistically compatible
futures are merged (bounds on the share of each outgoing class, of ending, and on the distribution of what is left to
come), which leaves a small probabilistic automaton of the format. Every other run of credential characters in every text
is then scored by its likelihood in the automata against a first-order model of all such runs, and runs that are far
likelier in a known format are added.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.llm.arrow import pieces, table, utf8
from custlens.session import stage

# The base patterns, in the order of their kinds.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
ADDED = "format"

TRAINING_VALUES = 2_000  # class strings of a kind that an automaton is inferred from
TRAINING_LENGTH = 256  # characters of the longest of them
SHORTEST = min(LEAST.values())  # characters of a candidate
_WORDS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

# Character classes: digits, letters of hex numbers and others by vowel, consonant and case, signs of base64 and names, the dot.
_GROUPS = (b"0123456789", b"ae", b"bcdf", b"iou", b"ghjklmnpqrstvwxyz", b"ABCDEF", b"GHIJKLMNOPQRSTUVWXYZ", b"+/_=-", b".")
CLASSES = len(_GROUPS)  # as a class: no credential character
DOT = CLASSES - 1
_CLASS = np.full(256, CLASSES, np.int64)
for _group, _characters in enumerate(_GROUPS):
    _CLASS[list(_characters)] = _group
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base patterns: leftmost non-overlapping matches, too short ones dropped."""
    found = [("assign", m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    found += [("access", m.start(), m.end(), m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", m.start(), m.end(), m.group()) for m in HEX.finditer(text) if m.end() - m.start() >= LEAST["hex"]]
    return found


def _runs(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of flagged bytes within a text, of at least so many bytes."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    at = offsets[:-1][filled]
    first[at] = inside[at]
    at = offsets[1:][filled] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def _inside(classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes of candidates: credential characters, and dots with such a character on both sides in the same text."""
    inside = classes < DOT
    dots = np.flatnonzero(classes == DOT)
    filled = offsets[:-1] < offsets[1:]
    dots = dots[~np.isin(dots, np.concatenate([offsets[:-1][filled], offsets[1:][filled] - 1]))]
    inside[dots[inside[dots - 1] & inside[dots + 1]]] = True
    return inside


@dataclass
class Automaton:
    """Transitions and log probabilities by state and class; the last column is the end, the last state lies beyond the format."""

    steps: np.ndarray
    logs: np.ndarray


def infer(counts: dict[bytes, int], alpha: float = 0.05, classes: int = CLASSES) -> Automaton:
    """Merge compatible states of the prefix tree of class strings (each byte a class, with its number of occurrences).

    Two states are compatible if the Hoeffding bound allows equal shares of every class and of ending, there and in what
    follows, and the bound of Dvoretzky, Kiefer and Wolfowitz equal distributions of the number of characters to come.
    Of several settled states that a new one is compatible with, it joins the one whose distribution is nearest. States are
    taken in order of depth, frequent ones first, so that few examples are pooled before the next depth is looked at.
    """
    children: list[dict[int, int]] = [{}]
    passed: list[list[int]] = [[0] * classes]
    ended = [0]
    depth = [0]
    left: list[dict[int, int]] = [defaultdict(int)]
    for string in sorted(counts):
        n, state = counts[string], 0
        left[0][len(string)] += n
        for i, c in enumerate(string, 1):
            passed[state][c] += n
            if c not in children[state]:
                children[state][c] = len(children)
                children.append({})
                passed.append([0] * classes)
                ended.append(0)
                depth.append(i)
                left.append(defaultdict(int))
            state = children[state][c]
            left[state][len(string) - i] += n
        ended[state] += n
    margin = (0.5 * np.log(2 / alpha)) ** 0.5

    def seen(a: int) -> int:
        return ended[a] + sum(passed[a])

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > margin * (n1**-0.5 + n2**-0.5)

    def apart(a: int, b: int) -> float:
        """Largest difference of the shares of strings with at most so many characters to come."""
        n1, n2, f1, f2, most = seen(a), seen(b), 0, 0, 0.0
        for length in sorted(left[a].keys() | left[b].keys()):
            f1 += left[a].get(length, 0)
            f2 += left[b].get(length, 0)
            most = max(most, abs(f1 / n1 - f2 / n2))
        return most

    def compatible(a: int, b: int) -> bool:
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            n1, n2 = seen(a), seen(b)
            if differ(ended[a], n1, ended[b], n2) or any(differ(x, n1, y, n2) for x, y in zip(passed[a], passed[b])):
                return False
            pairs += [(children[a][c], children[b][c]) for c in children[a].keys() & children[b].keys()]
        return True

    def nearest(state: int) -> int | None:
        """The settled state that this one joins."""
        limits = [margin * (seen(state) ** -0.5 + seen(s) ** -0.5) for s in settled]
        near = sorted((d, i) for i, d in enumerate(apart(s, state) for s in settled) if d <= limits[i])
        return next((settled[i] for _, i in near if compatible(settled[i], state)), None)

    def fold(a: int, b: int) -> None:
        """Add the tree below b to the automaton at a."""
        pairs = [(a, b)]
        while pairs:
            a, b = pairs.pop()
            ended[a] += ended[b]
            for length, n in left[b].items():
                left[a][length] += n
            for c in range(classes):
                passed[a][c] += passed[b][c]
            for c, child in children[b].items():
                if c in children[a]:
                    pairs.append((children[a][c], child))
                else:
                    children[a][c] = child

    settled = [0]
    while True:
        known = set(settled)
        fringe = [(s, c, t) for s in settled for c, t in sorted(children[s].items()) if t not in known]
        if not fringe:
            break
        source, c, state = max(fringe, key=lambda x: (-depth[x[2]], seen(x[2]), -x[2]))
        other = nearest(state)
        if other is None:
            settled.append(state)
        else:
            children[source][c] = other
            fold(other, state)
    # A class that a state never met leads on where most of its strings go, or beyond the format, where all is equally likely.
    number = {s: i for i, s in enumerate(settled)}
    beyond = len(settled)
    steps = np.full((beyond + 1, classes), beyond, np.int64)
    logs = np.full((beyond + 1, classes + 1), -np.log(classes + 1))
    for s, i in number.items():
        shares = np.array([*passed[s], ended[s]]) + 0.5
        logs[i] = np.log(shares / shares.sum())
        if children[s]:
            steps[i] = number[children[s][max(children[s], key=lambda c: passed[s][c])]]
        for c, child in children[s].items():
            steps[i, c] = number[child]
    return Automaton(steps, logs)


def walk(steps: np.ndarray, logs: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Log probability of each stretch of classes. Stretches are worked on together, longest first."""
    order = np.argsort(starts - ends, kind="stable")
    starts, lengths = starts[order], (ends - starts)[order]
    state = np.zeros(len(starts), np.int64)
    total = np.zeros(len(starts))
    active = len(starts)
    for i in range(int(lengths[0]) if len(lengths) else 0):
        active = int(np.searchsorted(-lengths[:active], -i, side="left"))
        c = data[starts[:active] + i]
        total[:active] += logs[state[:active], c]
        state[:active] = steps[state[:active], c]
    total += logs[state, -1]
    out = np.empty(len(starts))
    out[order] = total
    return out


@dataclass
class Grammar:
    """Automata by kind, the model of ordinary runs, and the log likelihood ratio that a run must reach for each kind."""

    automata: dict[str, Automaton]
    ordinary: np.ndarray
    least: dict[str, float]

    def ratios(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
        steps = np.tile(np.arange(1, CLASSES + 1), (CLASSES + 1, 1))  # the state is the class before
        usual = walk(steps, self.ordinary, data, starts, ends)
        return {k: walk(a.steps, a.logs, data, starts, ends) - usual for k, a in self.automata.items()}

    def accepts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), bool)
        for kind, ratio in self.ratios(data, starts, ends).items():
            out |= ratio >= self.least[kind]
        return out


def _scan(column: pa.Array):
    """Base spans by row, and the other candidates as stretches of bytes with their rows."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    raw = data.tobytes()
    low = raw.lower()
    wanted = np.zeros(n, bool)
    for word, where in [*((w, low) for w in _WORDS), (b"AKIA", raw)]:
        at = where.find(word)
        while at >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            wanted[row] = True
            at = where.find(word, int(offsets[row + 1]))
    starts, _ = _runs(_HEX[data], offsets, LEAST["hex"])
    wanted[np.searchsorted(offsets, starts, side="right") - 1] = True
    spans: list[list[tuple[str, int, int, str]]] = [[] for _ in range(n)]
    classes = _CLASS[data]
    starts, ends = _runs(_inside(classes, offsets), offsets, SHORTEST)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    free = np.ones(len(starts), bool)
    base = points[offsets]
    first, last = points[starts] - base[rows], points[ends] - base[rows]
    edges = np.searchsorted(rows, np.arange(n + 1))
    for row in np.flatnonzero(wanted).tolist():
        spans[row] = base_spans(raw[offsets[row] : offsets[row + 1]].decode())
        here = slice(edges[row], edges[row + 1])
        for _, a, b, _ in spans[row]:
            free[here] &= (last[here] <= a) | (first[here] >= b)
    return spans, classes, starts[free], ends[free], rows[free], first[free], last[free]


def learn(docs: DataFrame, text_col: str = "text", values: int = TRAINING_VALUES, false: float = 0.02) -> Grammar:
    """Infer the formats from base findings in ``docs``.

    States are merged on at most ``values`` distinct class strings of each kind, the most frequent ones (then those with
    the smallest hash) of up to ``TRAINING_LENGTH`` characters; the model of ordinary runs and the number of findings count
    all texts. By chance, at most exp(-t) of N ordinary runs reach a log likelihood ratio of t, so the ratio that a kind
    with n findings asks for is log(N / (``false`` * n)): for each kind at most that share of its findings is false.
    """
    schema = pa.schema([("kind", pa.string()), ("value", pa.binary()), ("n", pa.int64())])
    size = CLASSES + 1

    def gather(batches):
        pairs = np.zeros((size, size), np.int64)
        for batch in batches:
            for part in pieces(batch, "_text"):
                spans, classes, starts, ends, _, _, _ = _scan(part.column(0))
                found: dict[tuple[str, bytes], int] = defaultdict(int)
                for kind, _, _, value in (s for row in spans for s in row):
                    found[kind, _CLASS[list(value.rstrip(".").encode())].astype(np.uint8).tobytes()] += 1
                if found:
                    yield table(schema, kind=[k for k, _ in found], value=[v for _, v in found], n=list(found.values()))
                if len(starts):
                    pairs[0] += np.bincount(classes[starts], minlength=size)
                    inside = np.zeros(len(classes) + 1, np.int8)
                    inside[starts] += 1
                    inside[ends - 1] -= 1
                    step = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))  # all but the last character of each run
                    follow = np.bincount(classes[step] * size + classes[step + 1], minlength=CLASSES * size)
                    pairs[1:] += follow.reshape(CLASSES, size)
                    pairs[1:, CLASSES] += np.bincount(classes[ends - 1], minlength=CLASSES)
        a, b = np.nonzero(pairs)
        if len(a):
            yield table(schema, kind=["ordinary"] * len(a), value=[bytes(p) for p in zip(a.tolist(), b.tolist())], n=pairs[a, b])

    counted = docs.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(gather, "kind string, value binary, n long")
    counted = stage(counted.groupBy("kind", "value").agg(F.sum("n").alias("n")), "formats")
    ordinary = np.zeros((size, size))
    for r in counted.filter("kind = 'ordinary'").collect():  # at most one row for each pair of classes
        ordinary[r.value[0], r.value[1]] += r.n
    runs = max(1.0, ordinary[0].sum())
    ordinary = np.log((ordinary + 0.5) / (ordinary + 0.5).sum(axis=1, keepdims=True))
    findings = counted.filter("kind <> 'ordinary'")
    totals = {r.kind: r.n for r in findings.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    # Ranked by a window: a task hands on its own best only, and nothing but the wanted strings reaches the driver.
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), F.xxhash64("value"), "value"))
    examples: dict[str, dict[bytes, int]] = defaultdict(dict)
    for r in findings.filter(F.length("value").between(1, TRAINING_LENGTH)).withColumn("place", place).filter(F.col("place") <= values).collect():
        examples[r.kind][bytes(r.value)] = r.n
    automata = {kind: infer(examples[kind]) for kind in KINDS if kind in examples}
    return Grammar(automata, ordinary, {kind: float(np.log(runs / (false * totals[kind]))) for kind in automata})


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans`` of every row.

    Spans are ``kind:start:end`` in code points, ordered by start, then kind (assign, access, hex, format). Added spans never
    touch base spans. Null and empty texts have none. Repeated rows get the same. No rows give no rows; without any base
    finding nothing is added. Other columns are not looked at.
    """
    spark = docs.sparkSession
    grammar = spark.sparkContext.broadcast(learn(docs, text_col))
    import hashlib

    def scan(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                spans, classes, starts, ends, rows, first, last = _scan(part.column(1))
                good = np.flatnonzero(grammar.value.accepts(classes, starts, ends))
                listed = [[(a, KINDS.index(k), f"{k}:{a}:{b}") for k, a, b, _ in row] for row in spans]
                base = [",".join(x for _, _, x in sorted(row)) for row in listed]
                for row, a, b in zip(rows[good].tolist(), first[good].tolist(), last[good].tolist()):
                    listed[row].append((a, len(KINDS), f"{ADDED}:{a}:{b}"))
                counts = {k: [sum(s[0] == k for s in row) for row in spans] for k in KINDS}
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        *(pa.array(counts[k], pa.int64()) for k in KINDS),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                        pa.array([",".join(x for _, _, x in sorted(row)) for row in listed], pa.string()),
                    ],
                    names=["_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    columns = f"_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(scan, columns).withColumnRenamed("_id", id_col)
