import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, key long"


@pytest.fixture(scope="session")
def corpus():
    """Random small texts with copies, edits, shared passages, nulls and repeated rows."""
    def build(seed: int, n: int = 60) -> list[tuple]:
        rng = random.Random(seed)
        vocabulary = ["Ab", "cd", "éf", "the", "of", "x1", "ÑO", "z-z", "and", "q"] + [
            "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]

        def sentence(k: int) -> str:
            return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\n", "  ", ". ", "\t"])
                           for _ in range(k))
        shared = sentence(40)
        texts: list = [None, "", " \n ", "one", "a b c d", "!!! ###", "a" * 700, "ab " * 300]
        for _ in range(n):
            kind = rng.random()
            if kind < 0.25 and len(texts) > 9:
                words = rng.choice(texts[8:]).split(" ")
                for _ in range(rng.randint(0, 4)):
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
                texts.append(" ".join(words))
            elif kind < 0.45:
                texts.append(sentence(rng.randint(0, 60)) + shared + sentence(rng.randint(0, 60)))
            else:
                texts.append(sentence(rng.randint(1, 160)))
        texts.append(sentence(4000))
        ids = rng.sample(range(1000), len(texts))
        rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s1", "s2", "é3", None]),
                 len(t or ""), "clash", "clash", 7) for i, t in zip(ids, texts)]
        return rows
    return build


@pytest.fixture(scope="session")
def documents(spark, corpus):
    def build(seed: int, n: int = 60, extra: tuple = ()):
        rows = corpus(seed, n) + list(extra)
        return rows, spark.createDataFrame(rows, DOCS).repartition(3)
    return build


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
