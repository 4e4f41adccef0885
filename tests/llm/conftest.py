import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int, node long, rest string, `guest` int"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""
    def make(*rows):
        full = [(i, t, ("en", "de", None)[k % 3], f"s{k % 2}", None if t is None else len(t), k, "r", 1) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS).repartition(3)
    return make


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(words))


def odd_rows():
    """Nulls, empty and blank texts, very long ones, ties and repeated rows."""
    long = prose(1, 12_000)
    return [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long), (6, long), (6, long), (7, prose(2, 60)), (None, prose(2, 60)), (8, "one"), (9, "ÄÖ \u00a0x\u2003y ok\x1cno")]
