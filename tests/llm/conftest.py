import random

import pytest

ODD = {"extra": "string", "size": "long", "h": "long", "rid": "long", "id": "long", "gone": "long", "node": "long"}


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}{'.' if r.random() < 0.1 else ''}" for _ in range(n)]


@pytest.fixture(scope="session")
def corpus() -> list[tuple]:
    """(doc_id, text, lang, source): copies, near copies, shared passages, odd texts."""
    base = [words(i, 120 + 7 * i) for i in range(30)]
    rows = [(i, " ".join(w), "en", f"s{i % 5}") for i, w in enumerate(base)]
    rows += [(100 + i, " ".join(base[i]), "en", "s0") for i in range(8)]  # copies
    for i in range(8, 14):  # near copies
        near = list(base[i])
        near[10] = "changed"
        rows.append((100 + i, "\n".join(near), "de", "s1"))
    for i in range(14, 20):  # one passage of 70 words in each
        rows.append((100 + i, " ".join(words(500 + i, 40) + base[14][20:90] + words(600 + i, 40)), "fr", None))
    rows += [
        (300, None, None, None),
        (301, "", "en", "s2"),
        (302, " \n\t ", "xx", "s2"),
        (303, "one two three", "en", "s3"),
        (304, "one two three", "en", "s3"),
        (305, "a" * 3000, "en", "s3"),
        (306, "ha " * 2000, "es", "s4"),
        (307, "Ünïcödé → 中文 … " * 60, None, "s4"),
        (308, " ".join(words(77, 20_000)), "en", "s4"),
        (None, " ".join(base[3]), "en", "s1"),
        (None, "nobody", None, None),
        (29, rows[29][1], "en", "s4"),  # a row that occurs twice
        (29, rows[29][1], "en", "s4"),
    ]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with further columns whose names operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{k} {v}" for k, v in ODD.items()
    )
    rows = [(*r, len(r[1] or ""), "x", *range(len(ODD) - 1)) for r in corpus]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
