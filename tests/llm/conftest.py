import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """``documents((doc_id, text, source), …)`` in the columns of the table, plus columns whose names clash with internal ones."""

    def make(*rows):
        clash = "lang string, n_chars long, line_1 string, size string, target string, n_words string, node string, lines_removed string, _row string"
        data = [(i, t, s, "en", len(t or ""), "a", "b", "c", "d", "e", "f", "g") for i, t, s in rows]
        return spark.createDataFrame(data, f"doc_id long, text string, source string, {clash}")

    return make


@pytest.fixture(scope="session")
def prose():
    """``prose(seed, n)``: n invented words."""
    import random

    def make(seed: int, n: int) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 9))) for _ in range(n))

    return make
