import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
# the Python workers of a session started from here import the package from the repository
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH")) if p)

import pytest  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A stored documents table from (doc_id, text) pairs, in a few files."""
    import tempfile

    def make(rows, parts=3):
        full = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        path = tempfile.mkdtemp() + "/d"
        spark.createDataFrame(full, DOCS).repartition(parts).write.parquet(path)
        return spark.read.schema(DOCS).parquet(path)
    return make


@pytest.fixture()
def restless(spark, monkeypatch):
    """Each table that an operator stores changes how the next scans cut their files, as a change of the
    number of cores does."""
    from ordermart.llm import common
    write, sizes = common.stored, ["3k", "128m", "11k"]

    def stored(df, tag):
        out = write(df, tag)
        sizes.append(sizes.pop(0))
        spark.conf.set("spark.sql.files.maxPartitionBytes", sizes[0])
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return out

    def use(*modules):
        for m in (common, *modules):
            monkeypatch.setattr(m, "stored", stored)
    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of a small given table."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
