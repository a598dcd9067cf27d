import pytest

from twinflow.llm.common import table


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").collect()
    assert len({r["doc_id"] for r in rows}) == len(rows)
    return rows
