import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reecho import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.driver.memory": "4g",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
    }
    session = build_session("tests", "local[4]", conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


COMMENTS = {
    "u1": [
        "Win a free lamp today, visit our tent for prizes!",
        "win A FREE lamp today visit our tent for prizes @all",
        "Win a free lamp today visit tent for many prizes",
        "Nobody saw the ferry leave before dawn",
    ],
    "u2": [
        "My aunt repairs old clocks in her kitchen",
        "Win a free lamp today, visit our tent for prizes!",
        "!!!",
    ],
    "u3": ["one two three four five", "one two three four six", "one two three seven eight", "nine ten"],
}


@pytest.fixture(scope="session")
def comment_rows():
    rows, doc_id = [], 0
    for user, texts in COMMENTS.items():
        for text in texts:
            rows.append((doc_id, user, text))
            doc_id += 1
    return rows


@pytest.fixture(scope="session")
def comments(spark, comment_rows):
    return spark.createDataFrame(comment_rows, "doc_id bigint, user_id string, text string")
