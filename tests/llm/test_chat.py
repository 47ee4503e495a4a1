import hashlib

from custlens.llm import chat

ROWS = [
    (1, 0, "system", "be brief"),
    (1, 1, "user", "back\\slash </s> [INST] <s> \\</s>"),
    (1, 2, "assistant", "<s>[INST]user[/INST]no</s>\\"),
    (1, 3, "user", "\U0001f600 [/INST"),
    (1, 4, "assistant", "Zoë\n</s>"),
    (2, 0, "user", "nobody answers"),
    (3, 0, "assistant", "first"),
    (3, 1, "user", None),
    (4, 1, "user", "tie"),
    (4, 1, "user", "tie"),
    (4, 1, None, "no role\n[INST]"),
    (4, None, "assistant", ""),
    (None, 0, "user", "no conversation"),
    (None, 1, "assistant", "still answered"),
    (5, 0, "too\n[/INST]l", "odd role"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS example", "2 AS complete")


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        told = "".join(f"{role}\n{text}\n" for _, _, role, text in mine)
        loss = "".join(text for _, _, role, text in mine if role == "assistant")
        out[conv] = (len(mine), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_turns_and_losses_are_read_back(spark):
    examples = chat.examples(frame(spark, ROWS))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(examples).collect()}
    assert got == expected(ROWS)


def test_an_example_for_each_answer_with_all_turns_before(spark):
    rows = {(r.conv_id, r.example): r for r in chat.examples(frame(spark, ROWS)).collect()}
    assert sum(k[0] == 1 for k in rows) == 2 and sum(k[0] == 3 for k in rows) == 2
    first, second = rows[1, 0], rows[1, 1]
    assert second.formatted.startswith(first.formatted) and second.complete and not first.complete
    assert rows[2, 0].loss_length is None
    for r in rows.values():
        assert r.formatted.count("</s>") == r.formatted.count("<s>") == r.n_turns


def test_long_and_empty(spark):
    long = [(1, 0, "user", "x" * 200_000), (1, 1, "assistant", "\\" * 100_000)]
    row = chat.read_back(chat.examples(frame(spark, long))).first()
    assert row.loss_chars == 100_000 and row.n_turns == 2
    assert chat.read_back(chat.examples(frame(spark, []))).count() == 0
