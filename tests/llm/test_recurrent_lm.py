"""The language model's work on words: against plain Python in results and in time, and the two ways to find counts."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from custlens.llm import recurrent_lm

ODD_TEXTS = ["", " ", "\t a  B\x0b\x0cc\r\n", "é É", "x\x1cy\x85z w q", "ÀB,c.", f"{'a' * 7} {'b' * 8} {'c' * 12} {'d' * 13}! é{'e' * 6}", "\x00 \x00a", None]


def plain_tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def plain_shape(word):
    if not word:
        return 0
    sign = next((i for i, signs in enumerate((b".", b",", b"!?;:\"')]|*#%&$"), 1) if word[-1] in signs), 0)
    return (((len(word) > 7) + (len(word) > 12)) * 4 + sign) * 2 + (not word.isascii())


def vocabulary(words):
    return recurrent_lm.Vocabulary(recurrent_lm.Settings(words_per_class=5, classes=4), words, list(range(len(words), 0, -1)), 700, 60, np.full(24, 1.5), np.full(24, 4.0))


@pytest.mark.parametrize("end_is_frequent", [True, False])
def test_tokens_and_codes_are_those_of_plain_python(end_is_frequent):
    draw = random.Random(1)
    texts = ODD_TEXTS + ["".join(draw.choice(" \t\n\r\x0b\x0c\x1c\x00abzAZ.,!?é日 ") for _ in range(draw.randrange(40))) for _ in range(500)]
    told, n_tokens = recurrent_lm.tokens(pa.array(["cut off", *texts])[1:])
    want = [plain_tokens(t) for t in texts]
    assert told.to_pylist() == sum(want, []) and n_tokens.tolist() == [len(w) for w in want]
    assert recurrent_lm.shapes(told).tolist() == [plain_shape(w) for w in sum(want, [])]
    words = [b""] * end_is_frequent + [b"a", b"z", *sorted({w for w in sum(want, []) if len(w) > 2})[:40]]
    known = vocabulary(words)
    codes, missing = known.encode(told)
    place = {w: i if i < 20 else known.symbols + i - 20 for i, w in enumerate(words)}
    assert codes.tolist() == [place.get(w, 20 + plain_shape(w)) for w in sum(want, [])]
    assert missing.tolist() == [w not in place for w in sum(want, [])]
    empty, none = recurrent_lm.tokens(pa.array([], pa.string()))
    assert len(empty) == len(none) == 0


def test_encoding_costs_less_than_a_plain_lookup_of_every_word():
    draw = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(draw.choice(letters) for _ in range(draw.randrange(2, 9))) for _ in range(60_000)]
    texts = [" ".join(draw.choices(words, k=500)) for _ in range(400)]
    known = vocabulary([w.encode() for w in dict.fromkeys(words[:50_000])])
    column = pa.array(texts)
    place = {w: i for i, w in enumerate(known.words)}

    def seconds(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    plain = min(seconds(lambda: [[place.get(w, -1) for w in plain_tokens(t)] for t in texts]) for _ in range(3))
    own = min(seconds(lambda: known.encode(recurrent_lm.tokens(column)[0])) for _ in range(3))
    assert own < plain


def test_counts_of_rare_words_are_found_by_hashing_and_by_sorting(spark, docs, monkeypatch):
    draw = random.Random(3)
    frame = docs([(i, " ".join(f"w{int(draw.paretovariate(0.5)) % 5_000}" for _ in range(40))) for i in range(200)])
    settings = recurrent_lm.Settings(words_per_class=5, classes=4, hidden=8, lookup=30, rounds=1, batch=4)
    plans, results = [], []
    for most in (recurrent_lm.HASHED_WORDS, 0):
        monkeypatch.setattr(recurrent_lm, "HASHED_WORDS", most)
        scored = recurrent_lm.score_documents(frame, settings)
        plans.append("shuffle_hash" in scored._jdf.queryExecution().logical().toString())
        results.append(sorted((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in scored.collect()))
    assert plans == [True, False] and results[0] == results[1]
