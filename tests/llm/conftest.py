import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

FIXTURE = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Rows of (doc_id, text) as a documents table, with a column whose name
    the operators use themselves."""
    from cubewise.llm.common import workers_import_package

    workers_import_package(spark)

    def make(rows, partitions=3):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return (spark.createDataFrame(full, DOCUMENTS).repartition(partitions)
                .selectExpr("*", "1 as rank", "'x' as body", "2 as fp"))

    return make
