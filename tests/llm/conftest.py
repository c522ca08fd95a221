from __future__ import annotations

import pytest

from plumbline.llm.common import share_code


@pytest.fixture(scope="session", autouse=True)
def shared_code(spark):
    share_code(spark)


@pytest.fixture
def docs(spark):
    """Documents from texts, numbered from 0, or from (doc_id, text) pairs; with columns whose
    names the operators use inside."""

    def build(texts, *, plain=False):
        rows = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(texts)]
        if plain:
            return spark.createDataFrame(rows, "doc_id long, text string")
        extra = "row_id string, row_text string, words string, ids string, quality string, starts string, node string, size string, shard string, bucket string"
        return spark.createDataFrame([(*r, *["x"] * 10) for r in rows], f"doc_id long, text string, {extra}")

    return build
