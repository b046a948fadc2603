import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bandlex.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def three_docs(spark):
    """A stem with two forms in one document (lamp), terms of one document and of two."""
    return spark.createDataFrame(
        [
            (1, "Two lamps, a lamp: the harbour sleeps... and nobody paints it!"),
            (2, "Painting the harbours at dawn; old boats, painted lamps."),
            (3, "Nobody said boats are sleeping at the pier."),
        ],
        "doc_id bigint, text string",
    )

