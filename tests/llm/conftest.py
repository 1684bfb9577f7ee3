import os

import pytest

DOCS = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return DOCS


def folder(spark, path, **tables):
    """Write tables as <path>/<name>.parquet and return the path."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(os.path.join(str(path), f"{name}.parquet"))
    return str(path)
