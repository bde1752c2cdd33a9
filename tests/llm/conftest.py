import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g int, h string, id long, row string, key string"


def make_rows(seed: int = 3) -> list[tuple]:
    """(doc_id, text): copies, near copies, shared passages, repeated lines, nulls, empties, ties and repeated rows."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abdeilmnorstuéñ") for _ in range(pick.randint(1, 9))) for _ in range(400)]
    prose = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    passage, licence = prose(70), prose(12).capitalize() + " released under the licence."
    texts = [prose(pick.randint(1, 300)) for _ in range(40)]
    base = prose(260)
    for _ in range(12):  # near copies
        w = base.split()
        for _ in range(pick.randint(0, 6)):
            w[pick.randrange(len(w))] = pick.choice(vocabulary)
        texts.append(" ".join(w))
    texts += [base] * 5 + [base.upper(), base.replace(" ", "\t", 9)]  # copies, in other spelling too
    texts += [prose(20) + " " + passage + " " + prose(15) for _ in range(9)] + [passage, passage + "\n" + passage]
    texts += [prose(9) + "\n" + licence + "\n" + prose(8) + "\n  " + licence.upper() + "\t" for _ in range(7)]
    texts += ["", None, " \n\t ", "a", "a b c", "a b c", "x " * 400, "é" * 120, "ab" * 200, "\n\n", "word " * 60 + "end"]
    texts += [prose(30000)]  # one very long text
    texts += [texts[-1][:9000] + " " + prose(5)]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    pick.shuffle(rows)
    rows += [rows[5], rows[5], (rows[7][0], prose(80) + " " + passage)]  # repeated rows, a doc_id with two texts
    rows += [(None, base), (None, prose(40)), (None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


def frame(spark, rows):
    """As documents, with nulls in the other columns and clashing extra columns."""
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), 1, "h", 2, "r", "k") for i, t in rows],
                                 SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
