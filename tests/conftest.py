import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lexweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BLOCKS = (
    "slug string, block_ord bigint, block_id string, block_type string, text string, page int, original_page int, "
    "line_start int, line_end int, heading_path array<string>, provider string, page_count int, chunk bigint"
)


@pytest.fixture(scope="session")
def page_blocks(spark):
    """Blocks of a document given the texts of its pages; every page is a chunk of its own."""

    def make(pages, slug="sample", page_count=None):
        rows = [
            (slug, i, f"{slug}-p{i}-text", "body", text, i, i, None, None, [], "local_pdf", page_count or len(pages), i)
            for i, text in enumerate(pages, start=1)
        ]
        return spark.createDataFrame(rows, BLOCKS)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    def make(slug="sample", title="Sample Rules"):
        return spark.createDataFrame([(slug, title, 0)], "slug string, title string, doc_ord bigint")

    return make
