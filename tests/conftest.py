import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tesserine-tests-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def docs(spark):
    """A documents table of (doc_id, text) pairs, or of (doc_id, text, lang), with columns that clash with results."""

    def make(rows, lang=None):
        full = [(r[0], r[1], r[2] if len(r) > 2 else lang, None, None, "x", 7, None) for r in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id int, score double"
        return spark.createDataFrame(full, schema)

    return make
