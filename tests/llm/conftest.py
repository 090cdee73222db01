import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "shard string, slot string, _uid string, n_tokens string, n_lines string, kept string, _row string, size string, uid string"
)
WORDS = "the of and river stone moved under bright cold morning while people walked along old roads to see what had come".split()


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), *["x"] * 9)


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls, empty and very long texts, ties, repeated rows and ids, odd characters; clashing columns."""
    rng = random.Random(4)

    def prose(n):
        return " ".join(rng.choice(WORDS) for _ in range(n))

    passage = "\n".join(prose(20) for _ in range(4))
    near = [rng.choice(WORDS) + str(i) for i in range(200)]
    changed = near[:100] + ["other"] + near[101:]
    rows = [
        document(1, None),
        document(2, ""),
        document(3, " \n\t "),
        document(4, "one"),
        document(5, "One TWO"),
        document(6, passage + "\n\nend of six", source="b"),
        document(7, "start of seven\n" + passage + "\nend of seven", source=None),
        document(8, " ".join(near), source="b"),
        document(9, " ".join(changed), source="c"),
        document(10, prose(30_000), source="b"),
        document(10, prose(40), source="c"),
        document(11, "日本語 тест Σίσυφος naïve x \x1c y İ <|endoftext|> 𝒳", lang=None),
        document(None, prose(60), lang="zz", source=None),
        document(None, None, lang=None, source=None),
        document(12, "same words here again", source="d"),
        document(12, "same words here again", source="d"),
        document(13, prose(35), source=""),
    ]
    return rows + [document(100 + i, prose(50 + i)) for i in range(12)]


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    return spark.createDataFrame(messy_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
