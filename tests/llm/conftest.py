import pathlib
import random
import re

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    long = prose(1, 30_000)
    rows = [
        (0, None, None, None, None), (None, prose(2, 40), "en", "a", 10), (2, "", "en", "b", 0), (3, " \n\t ", "fr", "b", 4),
        (4, long, "en", "a", len(long)), (5, long, "en", None, len(long)), (6, prose(3, 60), "fr", "a", 300),
        (6, prose(3, 60), "fr", "a", 300), (6, prose(4, 60), "fr", "a", 300), (7, "Éa\u2003b!! ##", None, "c", 11), (8, "x", "en", "c", 1),
    ]
    return rows + [(100 + i, prose(100 + i, 20 + i), "en" if i % 2 else "fr", "ab"[i % 2], i) for i in range(20)]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), DOC).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def clashing(spark, edges):
    """The same documents with columns named as those that operators add or use."""
    from pyspark.sql import functions as F

    return edges.select("*", *[F.lit(-1).alias(n) for n in internal_names() if n.lower() not in {c.lower() for c in edges.columns}])


def internal_names():
    """Every name that the sources of the operators and the pipeline give a column."""
    here = pathlib.Path(__file__).resolve().parents[2]
    names = set()
    for path in [*here.glob("cellforge/llm/*.py"), here / "corpus_pipeline.py"]:
        text = path.read_text()
        names |= set(re.findall(r"""(?:alias|withColumn|withColumnRenamed|F\.col|unused\(\w+,|packed\(\w+,)\(?\s*"([A-Za-z_]\w*)\"""", text))
        names |= {n for part in re.findall(r"(?:select|drop|groupBy|join|partitionBy|orderBy)\(([^()]*)\)", text) for n in re.findall(r'"([A-Za-z_]\w*)"', part)}
    kept, seen = [], set()
    for n in sorted(names):
        if n.lower() not in seen:
            seen.add(n.lower())
            kept.append(n)
    return kept
