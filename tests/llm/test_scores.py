"""Learned operators: the quality ranking, the language model, the secret formats."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import plain
from conftest_llm import ODD

from custlens.llm import quality, recurrent_lm, secret_scan


def prose(draw, n=60):
    return " ".join(draw.choice(["the", "of", "and", "stone", "river", "walks", "slowly", "under", "heavy"]) + draw.choice(["", "", ",", "."]) for _ in range(n))


def junk(draw, n=60):
    word = draw.choice(["BUY", "now", "x9"])
    return draw.choice([" ".join([word] * n), " ".join(f"{word}{draw.choice('#$%|')}{draw.choice('#$%|')}" for _ in range(n))])


def held(i, folds):
    return zlib.crc32(str(i).encode()) % folds


def test_quality_ranks_held_out_documents(spark, docs):
    draw = random.Random(1)
    rows = [(i, prose(draw) if i % 3 else junk(draw)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(1, None, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_scores(docs(rows), labels).toPandas()
    assert len(got) == 400 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert all(got.held_out == [held(i, 5) == 0 for i in got.doc_id])
    assert (got.predicted == (got.doc_id % 3 > 0)).mean() > 0.98
    kept = quality.keep_good(docs(rows), labels)
    assert {r.doc_id for r in kept.collect()} == set(got[got.predicted == 1].doc_id)


def test_pair_weights_are_the_minimum_of_the_loss():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 3))
    good = (x @ [1, -2, 0.5] + draw.logistic(size=300) > -1).astype(int)
    ranking = quality.fit(x, good, pairs=4000)
    z = np.clip((x - ranking.mean) / ranking.scale, -8, 8)
    pick = np.random.default_rng(7)
    difference = z[pick.choice(np.flatnonzero(good == 1), 4000)] - z[pick.choice(np.flatnonzero(good == 0), 4000)]
    loss = lambda w: np.log1p(np.exp(-difference @ w)).mean() + 0.5e-3 * w @ w
    for step in np.eye(3) * 0.01:
        assert loss(ranking.weights) < min(loss(ranking.weights + step), loss(ranking.weights - step))
    assert abs((ranking.score(x) < 0.3).mean() - (good == 0).mean()) < 0.01


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (7, 0), (7, 1), (None, 1)], "doc_id long, quality int")
    for frame in (labels, labels.filter("quality = 1"), labels.limit(0)):
        got = quality.quality_scores(odd, frame).collect()
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
        assert quality.quality_scores(nothing, frame).count() == 0 == quality.keep_good(nothing, frame).count()


def lm_base(pairs):
    told = [(i, plain.SPACED.findall(plain.lower(t).encode()) + [b""]) for i, t in pairs]
    counts = Counter(w for i, words in told if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2 for w in words)
    total, distinct = sum(counts.values()), len(counts)
    return total, [
        (i, len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)) for i, w in told
    ]


SMALL = recurrent_lm.Settings(words_per_class=5, classes=4, hidden=8, lookup=30, share=1.0, rounds=3, batch=4, rate=0.03)


def check_base(rows, pairs):
    total, want = lm_base(pairs)
    assert {r.train_tokens for r in rows} == {total}
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows), key=str)
    assert got == sorted(((i, n, k, round(b, 6)) for i, n, k, b in want), key=str)


def test_language_model_counts_and_learns(docs):
    draw = random.Random(5)
    languages = [["ein", "haus", "und", "der", "fluss"], ["la", "maison", "et", "le", "fleuve"], ["the", "house", "and", "of", "river"]]
    rows = []
    for i in range(500):
        words = draw.choice(languages)
        rows.append((i, " ".join(draw.choice(words) if draw.random() < 0.9 else f"{draw.choice(words)}{draw.randrange(40)}" for _ in range(30))))
    got = recurrent_lm.score_documents(docs(rows), SMALL).collect()
    check_base(got, rows)
    held_rows = [r for r in got if r.held_out]
    assert len(held_rows) == sum(held(i, 7) == 2 for i, _ in rows)
    assert sum(r.score for r in held_rows) > sum(r.base_score for r in held_rows) + 0.15 * sum(r.n_tokens for r in held_rows)


def test_language_model_of_odd_rows(odd, nothing):
    rows = recurrent_lm.score_documents(odd, SMALL).collect()
    check_base(rows, ODD)
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert recurrent_lm.score_documents(nothing, SMALL).count() == 0


def small_network():
    settings = SMALL
    words = [b"", *(f"w{i}".encode() for i in range(19))]
    vocabulary = recurrent_lm.Vocabulary(settings, words, list(range(40, 20, -1)), 700, 60, np.full(24, 1.5), np.full(24, 4.0))
    network = recurrent_lm.Network(vocabulary)
    draw = np.random.default_rng(2)
    network.set_flat(network.flat() + draw.normal(0, 0.2, network.flat().size))
    return vocabulary, network


def test_state_is_carried_over_windows():
    vocabulary, network = small_network()
    draw = np.random.default_rng(4)
    documents = [draw.integers(0, vocabulary.symbols, n) for n in (1, 70, 3, 200, 3, 0)]
    together = network.score(documents, rows=64)
    for document, score in zip(documents, together):
        h, total = np.zeros((1, network.hidden), np.float32), 0.0
        for t, symbol in enumerate(document):
            gates = (network.embed[document[t - 1]] @ network.wx if t else 0) + network.bias
            h = network.step(np.atleast_2d(gates), h)[0]
            total += network.log_probability(h, np.array([symbol]))[0]
        assert abs(total - score) < 1e-3 * max(1, abs(total))


def test_classes_and_shares_add_up_to_one():
    vocabulary, network = small_network()
    h = np.random.default_rng(1).normal(size=(1, network.hidden)).astype(np.float32)
    every = np.arange(vocabulary.symbols)
    total = np.exp(network.log_probability(np.repeat(h, len(every), axis=0), every)).sum()
    assert abs(total - 1) < 1e-5


def test_backpropagation_against_differences():
    vocabulary, network = small_network()
    settings = recurrent_lm.Settings(**{**SMALL.__dict__, "window": 100})
    draw = np.random.default_rng(9)
    documents = [draw.integers(0, vocabulary.symbols, n) for n in (6, 4)]
    caught = {}
    network._update = lambda gradient, n, rate, moments: caught.update(gradient)
    network.train(documents, settings, {})
    for name in network.NAMES:
        value = getattr(network, name)
        flat = np.argsort(-np.abs(caught[name].ravel()))[:4]
        for i in flat:
            at = np.unravel_index(i, value.shape)
            old, losses = value[at], []
            for change in (1e-2, -1e-2):
                value[at] = old + change
                losses.append(-network.score(documents).sum())
            value[at] = old
            assert abs((losses[0] - losses[1]) / 2e-2 - caught[name][at]) < 0.02 * max(1, abs(caught[name][at])), name


PATTERNS = {
    "assign": (r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
    "access": ("(AKIA[A-Z0-9]+)", 20),
    "hex": ("([0-9a-f]+)", 24),
}


def base(text):
    found = [(m.start(), k, m.end()) for k, (p, least) in enumerate(PATTERNS.values()) for m in re.finditer(p, text or "") if len(m.group(1)) >= least]
    return [f"{list(PATTERNS)[k]}:{a}:{b}" for a, k, b in sorted(found)]


def check_secrets(rows, pairs):
    want = sorted(((i, hashlib.sha256(",".join(base(t)).encode()).hexdigest(), *(sum(s.startswith(k) for s in base(t)) for k in PATTERNS)) for i, t in pairs), key=str)
    assert sorted(((r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in rows), key=str) == want


def secret_rows():
    draw = random.Random(8)
    key = lambda n, alphabet="0123456789abcdef": "".join(draw.choice(alphabet) for _ in range(n))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows = []
    for i in range(300):
        text = "Größe " + prose(draw, 20) + f" understandably-{draw.choice(['heavy', 'stony'])} 1234-5678-9012 "
        text += draw.choice([f'Token = "{key(40)}"', f"pass PASSWORD={key(18)}", f"AKIA{key(16, upper)}", key(32), f"secret: {key(3)}", "", ""])
        rows.append((i, text + " " + prose(draw, 5)))
    strange = ["token=token=abcdef", "api_key:'x' apikey = \"abc.def-1\"", "paſsword=abcdef1", "AKIA" * 6, "token:secret:password=abcdefg", "f" * 23 + " " + "f" * 24 + "g"]
    rows += [(1000 + i, t) for i, t in enumerate(strange)]
    return rows, key, upper


def test_secrets_and_formats(docs):
    rows, key, upper = secret_rows()
    hidden = [(2000, f"see {key(20)} there"), (2001, "see understandably-heavy there"), (2002, "call 1234-5678-9012 now"), (2003, f"the AKIB{key(16, upper)} row")]
    got = secret_scan.scan_secrets(docs(rows + hidden)).collect()
    check_secrets(got, rows + hidden)
    spans = {r.doc_id: r.spans for r in got}
    assert spans[2000] == "format:4:24" and spans[2001] == spans[2002] == ""
    for i, t in rows:
        assert [s for s in spans[i].split(",") if s and not s.startswith("format")] == base(t)


def test_secrets_of_odd_rows(odd, nothing):
    check_secrets(secret_scan.scan_secrets(odd).collect(), ODD)
    assert secret_scan.scan_secrets(nothing).count() == 0


def plain_format_spans(text, grammar):
    """Added spans of one text, run by run and character by character."""
    taken = [(int(a), int(b)) for _, a, b in (s.split(":") for s in base(text))]
    found = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*", text, re.ASCII):
        if len(m.group()) < 6 or any(m.start() < b and a < m.end() for a, b in taken):
            continue
        classes = [next(i for i, group in enumerate(secret_scan._GROUPS) if ord(c) in group) for c in m.group()]
        usual, before = 0.0, 0
        for c in classes:
            usual += grammar.ordinary[before, c]
            before = c + 1
        usual += grammar.ordinary[before, len(secret_scan._GROUPS)]
        for kind, automaton in grammar.automata.items():
            state, total = 0, 0.0
            for c in classes:
                total += automaton.logs[state, c]
                state = automaton.steps[state, c]
            if total + automaton.logs[state, -1] - usual >= grammar.least[kind]:
                found.append(f"format:{m.start()}:{m.end()}")
                break
    return found


def added(rows):
    return {r.doc_id: [s for s in r.spans.split(",") if s.startswith("format")] for r in rows}


def test_added_spans_are_those_of_a_plain_scorer(docs):
    rows, key, upper = secret_rows()
    rows += [(3000, f"x {key(18)}. y {key(18)}.{key(6)} .{key(8)}"), (3001, key(18) + "."), (3002, "." + key(20)), (3003, "a.b" * 30), (3004, None), (3005, "")]
    rows += [(4000 + i, f"{key(n)} {key(n, upper)}") for i, n in enumerate(range(4, 60))]
    frame = docs(rows)
    grammar = secret_scan.learn(frame)
    got = added(secret_scan.scan_secrets(frame).collect())
    want = {i: plain_format_spans(t or "", grammar) for i, t in rows}
    assert got == want and sum(map(len, want.values())) > 10


def test_planted_credentials_are_found_by_their_format(spark):
    """Documents of the given tables with 60 labelled credentials of three formats and 60 bare ones of each."""
    draw = random.Random(5)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789abcdef"
    base64 = upper + "abcdefghijklmnopqrstuvwxyz+/"
    key = lambda n, alphabet: "".join(draw.choice(alphabet) for _ in range(n))
    texts = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    rows, wanted = [], {}
    for n, (i, text) in enumerate(texts):
        at = text.find(" ", len(text) // 2) + 1
        form = n % 3
        if n < 180:
            put = [f"secret={key(24, base64)}", f"AKIA{key(16, upper)}", f"password={key(18, lower)}"][form]
        elif n < 360:
            put = [key(24, base64), f"ASIA{key(16, upper)}", key(18, lower)][form]
            wanted[i] = (form, f"format:{at}:{at + len(put)}")
        else:
            put = ""
        rows.append((i, text[:at] + put + (" " if put else "") + text[at:]))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    grammar = secret_scan.learn(frame)
    assert all(len(a.steps) > 2 for a in grammar.automata.values()) and set(grammar.automata) == {"assign", "access", "hex"}
    got = added(secret_scan.scan_secrets(frame).collect())
    for form in range(3):
        planted = [(i, s) for i, (f, s) in wanted.items() if f == form]
        recall = sum(s in got[i] for i, s in planted) / len(planted)
        print("form", form, "recall", recall)
        assert recall >= 0.9
    false = sum(len(s) - (wanted.get(i, (0, ""))[1] in s) for i, s in got.items())
    print("false", false)
    assert false <= 3


def test_automata_of_the_given_tables_keep_states(spark):
    for size in ("sf0.01", "sf0.1"):
        grammar = secret_scan.learn(spark.read.parquet(f"/root/testdata/{size}/documents.parquet"))
        assert {k: len(a.steps) - 1 > 1 for k, a in grammar.automata.items()} == {"assign": True, "hex": True}


def test_inferred_automata():
    """Strings (01)* ending with a certain chance: two states suffice, and probabilities add up to one."""
    draw = random.Random(3)
    counts = Counter()
    for _ in range(4000):
        string = b""
        while draw.random() < 0.7:
            string += b"\x00\x01"
        counts[string] += 1
    found = secret_scan.infer(counts)
    assert len(found.steps) - 1 == 2
    assert np.allclose(np.exp(found.logs[:2]).sum(axis=1), 1)
    strings = [b"", b"\x00\x01", b"\x00\x01" * 3]
    data = np.frombuffer(b"".join(strings), np.uint8).astype(int)
    logs = secret_scan.walk(found.steps, found.logs, data, np.array([0, 0, 2]), np.array([0, 2, 8]))
    assert np.allclose(np.exp(logs), [0.3, 0.21, 0.3 * 0.7**3], rtol=0.15)


def test_every_training_document_takes_part_in_one_round(spark):
    settings = recurrent_lm.Settings()
    texts = spark.range(2_000).selectExpr("id", "pmod(xxhash64(id), 1000000) AS _draw")
    rounds = [{r.id for r in recurrent_lm.drawn(texts, settings, i).collect()} for i in range(settings.rounds)]
    assert sum(map(len, rounds)) == 2_000 and set().union(*rounds) == set(range(2_000))
