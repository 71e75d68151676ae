import random

import pytest

#: Columns that a table may have beside its own, named like those that operators use inside.
CLASHING = "e long, h long, t long, c long, sig long, gram long, bits string, spans string, copied string, _cut string, x double"


def documents(seed=3):
    """Documents with nulls, empty, long, odd, copied, nearly copied and repeated texts."""
    draw = random.Random(seed)

    def word():
        return "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 7)))

    def prose(n):
        return " ".join(word() for _ in range(n))

    passages = [prose(80) for _ in range(5)]
    rows = [
        (0, None), (1, ""), (2, "a" * 3000), (3, "ab c" * 100), (4, passages[0]), (5, passages[0]), (6, passages[0].upper()),
        (7, "   \n\t "), (8, "one two"), (9, "ONE  two"), (10, "don't <|endoftext|> you'll  \n\n 's ▁ 漢字 🙂"), (11, prose(6000)),
    ]
    for i in range(12, 70):
        parts = []
        for _ in range(draw.randint(1, 4)):
            passage = draw.choice(passages)
            at = draw.randint(0, len(passage) - 1)
            parts.append(passage[at : at + draw.randint(50, 400)] if draw.random() < 0.4 else prose(draw.randint(1, 60)))
        rows.append((i, "\n".join(parts)))
    for i in range(70, 100):  # near copies of a few documents
        words = rows[12 + i % 4][1].split(" ")
        if len(words) > 3:
            words[draw.randrange(len(words))] = word()
        rows.append((i, " ".join(words)))
    return rows + [(20, rows[20][1]), (None, "alone " + passages[1])]


@pytest.fixture(scope="session")
def rows():
    return documents()


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, partitions=4):
        plain = spark.createDataFrame(rows, "doc_id long, text string")
        extra = [f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in CLASHING.split(", ")]
        return plain.selectExpr("*", *extra).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def docs(make, rows):
    return make(rows)


@pytest.fixture(scope="session")
def no_docs(make):
    return make([])
