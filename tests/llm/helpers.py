"""Odd rows that every text operator must take."""

TEXTS = [
    (1, "It's a plain text, isn't it?  Yes.\n\nWe'll see 12 or 345 things."),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, "word"),
    (5, "word"),
    (6, "Ünïcödé — 日本語 İstanbul Σίσυφος 'S 's x'"),
    (7, "</s>[INST] <|endoftext|> \\ [/INST]"),
    (8, "la " * 6000),
    (None, "a text without an id"),
]


def odd_rows(spark):
    """doc_id, text, and columns that clash with names of outputs."""
    schema = ("doc_id long, text string, ids string, length string, score string, fp string, kept string, "
              "spans string, start int, offset int, n_bytes string")
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x", "x", 0, 0, "x") for i, t in TEXTS], schema)


def no_rows(spark):
    return odd_rows(spark).limit(0)
