import numpy as np
import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with the cases every operator must stand: nulls, empty and long texts,
    repeated rows and ids, and columns named as results are."""
    rng = np.random.default_rng(4)
    words = ["the", "of", "Haus", "été", "niño", "x1", "data", "line", "spark", "a"]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choice(words, rng.integers(1, 30))) for _ in range(rng.integers(1, 6))]
        rows.append((i, "\n".join(lines), "en", f"src{i % 3}", "kept"))
    shared = "A passage that several of these documents share, longer than fifty bytes."
    for i in (3, 9, 27, 41):
        rows[i] = (i, f"{rows[i][1]}\n  {shared.upper() if i == 9 else shared} ", "en", "src0", "kept")
    rows += [(60, None, "en", "src1", "kept"), (61, "", None, None, None), (62, " \n\t", "en", "src1", "kept")]
    rows += [(63, "long " * 40_000, "en", "src2", "kept"), (64, "x" * 100_000, "en", "src2", "kept")]
    rows += [(65, rows[5][1], "en", "src2", "kept"), (5, rows[5][1], "en", "src2", "kept")]
    rows += [(None, rows[7][1], "en", "src2", "kept"), (None, "no id", None, "src2", "kept")]
    schema = "doc_id long, text string, lang string, source string, score string"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.where("doc_id = -1")
