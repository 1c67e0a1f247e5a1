"""Awkward tables: nulls, empty and long texts, repeated rows, and extra columns with clashing names."""

import random

PROSE = "the quick brown fox jumps over a lazy dog while seven wizards mix black quartz in their deep jars and nobody asks why it has to be so".split()

CLASHING = "spans ids part nth length fp slot taken kept judged n a b start end key file payload keeper sha1 media block host path rule verdict page rank".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(PROSE) + str(r.randrange(50)) for _ in range(words))


def awkward(spark, more=()):
    """Documents with every awkward case; ``more`` rows of (doc_id, text)."""
    rows = [
        (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "Two Words"), (6, prose(6, 200)), (6, prose(6, 200)), (7, prose(6, 200)), (None, prose(8, 80)), (None, None),
        (9, "x" * 5000), (10, "\n".join(["same line here"] * 40)), (11, "é ü 日本語     İstanbul ΑΣ 🙂 \x1c \x85"), (12, prose(12, 6000)), *more,
    ]
    extra = [(i, t, "en", "src", None) + ("clash",) * len(CLASHING) for i, t in rows]
    names = ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(extra, f"doc_id long, text string, lang string, source string, n_chars long, {names}"), rows


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
