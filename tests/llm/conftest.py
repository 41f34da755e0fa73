import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_help import documents, prose  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, no rows at all."""
    rows = [(1, None), (2, ""), (3, " \n \t "), (4, prose(4)), (4, prose(4)), (5, prose(4)),
            (None, prose(6)), (None, None), (7, prose(7, 30_000)), (8, "x" * 200_000),
            (9, "\n".join([prose(9, 12)] * 3)), (10, "é́ <|endoftext|> \0 日本"), (-3, prose(4) + " end")]
    return SimpleNamespace(rows=rows, docs=documents(spark, rows), none=documents(spark, []))
