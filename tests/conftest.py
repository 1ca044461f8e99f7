import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

PAIR = "id long, question1 string, question2 string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edge_pairs(spark):
    rows = [
        (1, None, "x"),
        (2, "", ""),
        (3, "a b", ""),
        (4, "a b a", "a b a"),
        (5, "a b a b", "a b"),
        (6, "b a", "a b"),
        (7, "What's the café?", "what is the cafe"),
        (8, "the apache's rule", "the summit's rule"),
        (9, "…", "?"),
        (10, "one\ntwo  three", "one two three"),
        (11, "a", "a very much longer sentence than that"),
        (12, "gonna go", "going to go"),
    ]
    return spark.createDataFrame(rows, PAIR)
