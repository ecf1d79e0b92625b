from __future__ import annotations

import pytest

DDL = "doc_id long, text string, source string"


@pytest.fixture
def docs(spark):
    """docs((1, 'text'), (2, None, 'src')) with columns doc_id, text, source."""

    def make(*rows, partitions=3):
        full = [(*r, "src1")[:3] for r in rows]
        return spark.createDataFrame(full, DDL).repartition(partitions)

    return make
