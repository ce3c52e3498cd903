"""Small frames with the awkward cases that every operator must take."""

import random

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, key string, score string, kept string, "
        "component_id string, items string, path string, _text string, text_hash string")
WORDS = "the of and river stone green light walks under over because many small large tables chairs ünder ñandú ça".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    base = prose(1, 300)
    texts = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n", None), (4, "one", "fr"), (5, "two words", "fr"), (6, base, "en"),
        (7, base, "en"), (8, base.replace(" ", "\n  ", 5), "en"), (9, base + " end", None), (9, base + " end", None),
        (10, prose(2, 30_000), "de"), (11, "x" * 200_000, "de"), (12, "1234 !!! ...", "en"), (None, base, "en"), (None, None, None),
        (13, prose(3, 80), "de"), (14, prose(3, 80) + " " + prose(4, 90), None), (15, prose(3, 80), "en"),
    ]
    return [(i, t, lang, None, None, "k", "s", "x", None, "i", "p", "t", None) for i, t, lang in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, texts):
    return spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "doc_id long, text string, lang string")
