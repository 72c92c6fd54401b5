import pyarrow.parquet as pq
import pytest

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small_docs():
    return pq.read_table(f"{SMALL}/documents.parquet").to_pylist()


@pytest.fixture(scope="session")
def medium_docs():
    return pq.read_table(f"{MEDIUM}/documents.parquet").to_pylist()
