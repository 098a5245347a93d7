import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a frame of documents from texts or (doc_id, text) pairs, with columns whose names clash."""

    def build(rows):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOCUMENT)
        for clash in ("ids", "score", "shard", "piece", "bands", "n", "root", "good", "start", "row_key"):
            df = df.selectExpr("*", f"'x' as {clash}")
        return df

    return build


@pytest.fixture(scope="session")
def prose():
    """Random texts of made-up words, alike for one seed."""

    def make(n, words=60, seed=0, vocabulary=400):
        r = random.Random(seed)
        return [" ".join(f"w{r.randrange(vocabulary)}" for _ in range(words)) for _ in range(n)]

    return make
