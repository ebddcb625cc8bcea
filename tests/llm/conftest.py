import random
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[2]
CLASHING = "_text string, _row long, _starts int, _again int, fp long, y int, words int, n long, lists int, key string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def importable(spark):
    """Python workers find the package wherever the tests are started from."""
    spark.sparkContext.environment["PYTHONPATH"] = str(REPO)


def words(seed: int, n: int, size: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}x" for _ in range(n))


@pytest.fixture
def awkward(spark):
    """Null, empty, blank, very long and repeated texts, a null id, columns with clashing names."""
    long = words(1, 40_000)
    texts = [
        (1, None), (2, ""), (3, " \t\n "), (4, long), (5, words(2, 50)), (5, words(2, 50)), (6, words(2, 50)),
        (None, words(3, 50)), (7, "x"), (8, "é. ü! ñ?\nß"), (9, "a" * 100_000),
    ]
    rows = [(i, t, None if k % 3 else "en", None if k % 2 else "s", 0) + (None,) * 10 for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture
def documents(spark):
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture
def labels(spark):
    if not Path(FOLDER).exists():
        pytest.skip("no test tables")
    return spark.read.parquet(f"{FOLDER}/labels.parquet")


@pytest.fixture
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
