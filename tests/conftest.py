import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from cartloom.session import local_session

    session = local_session(4, "cartloom-tests", "4g")
    yield session
    session.stop()


def snapshot(spark, folder):
    from cartloom.sources import schemas
    from cartloom.sources.snapshot import load_snapshot

    return load_snapshot(
        spark, folder, schemas.CATALOG_REQUIRED + schemas.ARCHIVE_REQUIRED, schemas.CATALOG_OPTIONAL + schemas.ARCHIVE_OPTIONAL[1:]
    )


@pytest.fixture(scope="session")
def shop(spark, tmp_path_factory):
    """The small shop and its transformed records."""
    import shopdata
    from cartloom.operators.transform import transform

    source = snapshot(spark, shopdata.write(tmp_path_factory.mktemp("source")))
    return source, transform(source, str(tmp_path_factory.mktemp("work")), "House Brand")
