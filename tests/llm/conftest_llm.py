"""Rows that every operator must cope with: nulls, empty and very long texts, ties, repeated rows."""

ODD = [
    (1, "Plain words, plain words."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "Plain words, plain words."),
    (5, "Plain words, plain words."),
    (None, "an id is missing"),
    (None, None),
    (7, "Zoë ünïcode \U0001f600 漢字 <|endoftext|> \x1c\x1d end"),
    (8, "long " * 30_000 + "x" * 5_000),
]
