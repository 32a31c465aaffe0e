import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa",
         "la", "mu", "nu", "xi", "omi", "pi", "rho", "sigma", "tau", "ups", "phi", "chi", "psi"]


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "", "s", "ed", "ing"]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empties, blanks, a very long text, copies, repeated rows, a null id, and columns
    whose names clash with what operators add."""
    long = prose(1, 6000) + " " + "x" * 3000
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, prose(2, 60)), (6, prose(2, 60)),
            (5, prose(2, 60)), (None, prose(2, 60)), (7, long), (8, prose(3, 80) + " é漢字 😀"),
            (9, "a  b   c\r\n \n d <|endoftext|> e"), (None, None)]
    names = ["ids", "decoded", "leaks", "score", "predicted", "removed", "kept", "spans",
             "base_spans", "n_tokens", "k", "c"]
    return spark.createDataFrame(
        [(i, t, *["own"] * len(names)) for i, t in rows],
        "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")
