import random

import pytest

CLASHES = ("score", "shard", "slot", "size", "n_lines", "keep", "_key", "_id", "_gone", "h1", "fp", "row", "rep",
           "component_id", "n_tokens", "lang_pred", "predicted", "_toxic", "tid", "ikey")


def prose(seed: int, n: int) -> str:
    """Made-up words, the same for the same seed."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(("ba", "de", "ki", "lo", "mu", "ra", "su", "ti", "vo", "ze"))
                            for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, clashes=()):
        """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, *["x"] * len(clashes)) for r in rows]
        names = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, ", ".join([names, *[f"`{c}` string" for c in clashes]]))

    return make


@pytest.fixture(scope="session")
def odd(make_docs):
    """Nulls everywhere, empty and blank texts, a very long one, ties and repeated rows, clashing columns."""
    long_text = "\n".join(prose(i, 40) for i in range(2500))
    same = prose(1, 60)
    rows = [(1, None), (2, ""), (3, " \t\n \r"), (4, long_text), (5, same), (5, same), (5, same), (6, same),
            (7, prose(2, 50)), (7, prose(3, 50)), (None, prose(4, 30)), (None, None), (8, "É ß Ω — 123 !?"),
            (9, "\n\n\n"), (10, "a")]
    return make_docs(rows, CLASHES)


@pytest.fixture(scope="session")
def nothing(make_docs):
    return make_docs([])
