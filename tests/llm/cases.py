"""Odd documents that every operator has to take."""

import random

EXTRA = "digest string, fp string, name string, row_id string, gram string, n_chars bigint, cell string, keep string, votes string, at string"
SCHEMA = f"doc_id bigint, text string, {EXTRA}"


def words(seed: int, count: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(5)) for _ in range(count))


def odd_documents(spark):
    passage = words(1, 60)
    rows = [
        (1, "The Cat sat on the mat and the dog ran to the house of the man."),
        (2, "the cat sat on the mat and the dog ran to the house of the man."),
        (2, "the cat sat on the mat and the dog ran to the house of the man."),
        (3, None), (4, ""), (5, " \t\n "), (None, "the cat sat on the mat and the dog ran to the house of the man."),
        (None, None), (6, "one"), (7, "É é ǅ 日本語 🤖 <|endoftext|>"), (8, "x" * 20_000),
        (9, words(2, 30) + " " + passage + " " + words(3, 30)), (10, passage + " " + words(4, 50)),
        (11, words(5, 30_000)), (2**62, "a b c"), (-5, "a b c d"),
    ]
    extra = tuple("clash" if i != 5 else None for i in range(EXTRA.count(",") + 1))
    extra = tuple(0 if i == 5 else e for i, e in enumerate(extra))
    return spark.createDataFrame([r + extra for r in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
