import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, os.environ.get("PYTHONPATH", "")) if p)
sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def tokenizer_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) pairs."""
    def build(rows, parts=2):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)

    return build
