import random

import pytest

WORDS = ["ara", "bel", "cor", "dun", "eli", "fom", "gar", "hol", "ium", "jet", "kal", "lor", "mun", "nep", "ori", "pul"]


def prose(rng: random.Random, n: int) -> str:
    words = ["".join(rng.choices(WORDS, k=rng.randint(1, 3))) for _ in range(n)]
    return " ".join(w + (".\n" if rng.random() < 0.1 else "") for w in words)


def edited(rng: random.Random, text: str, changes: int) -> str:
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = "".join(rng.choices(WORDS, k=4))
    return " ".join(words)


def corpus() -> list[tuple]:
    """Ids, texts and sources: near and exact copies, shared passages, nulls, empty, long and repeated rows."""
    rng = random.Random(5)
    base, passage = prose(rng, 120), prose(rng, 90)
    texts = [prose(rng, rng.randint(1, 200)) for _ in range(30)]
    texts += [edited(rng, base, k) for k in (0, 0, 1, 2, 3, 4, 6, 9, 14, 20) for _ in range(3)]
    texts += [f"{prose(rng, 30)}\n{passage}\n{prose(rng, 30)}" for _ in range(6)]
    texts += ["", "   \n \t", "one", "one two", "a " * 900, "ü€𝄞 " * 200, "x" * 3000, prose(rng, 9000), "ONE two THREE four five"]
    rows = [(i, t, f"src{i % 3}") for i, t in enumerate(texts)]
    rows += [(1000, None, "src0"), (1001, None, None), (None, texts[3], None), (None, None, "src1")]
    return rows + [rows[4], rows[4], rows[31], (1002, texts[7], "src2")]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The corpus, with columns whose names could clash."""
    more = [(*r, "x", 1, "y", 2) for r in rows]
    schema = "doc_id long, text string, source string, id string, n int, row string, node int"
    return spark.createDataFrame(more, schema).repartition(4).cache()


@pytest.fixture(scope="session")
def none(docs):
    return docs.filter("doc_id < -1")


def as_set(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
