"""Small documents with every edge a table may have, and readers of results."""

import random

WORDS = "the of river stone market figure quarter revenue amber cloud orbit lantern meadow cipher harbor velvet signal timber copper garden".split()
SCHEMA = "doc_id long, text string, score string, row int, items string, spans string, held_out string, n_words string"


def prose(n: int, seed: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + rnd.choice(["", "", "s", "ed"]) for _ in range(n))


def edge_texts() -> list[tuple[int | None, str | None]]:
    """Null, empty and blank texts, ties, repeated rows and ids, a null id, one very long text, unusual characters."""
    base = prose(60, 1)
    return [
        (1, base), (2, None), (3, ""), (4, " \t\n\r "), (5, "word"), (6, base), (6, base), (7, prose(60, 2)), (None, prose(30, 3)),
        (8, prose(20_000, 4)), (9, "a" * 5000), (10, "ÀÉ Σς ß 日本語 😀 \x00 \x1c á"), (11, base.replace("river", "rivers", 1)), (12, "<|endoftext|> x@y.zz +1 (555) 010-9999"), (13, "word"),
    ]


def edge_documents(spark):
    """Those texts beside columns named as results and helpers are."""
    return spark.createDataFrame([(i, t, "s", 1, "i", "p", "h", "w") for i, t in edge_texts()], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
