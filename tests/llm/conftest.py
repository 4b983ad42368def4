import numpy as np
import pytest


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path


@pytest.fixture(scope="session")
def pack_texts():
    def make(texts):
        parts = [t.encode() for t in texts]
        return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)

    return make


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns that are called like results."""
    texts = [
        "One two three four five six seven.", "one TWO three four five six seven.", None, "", "   \n\t ", "x",
        "word " * 3000, "Ein Text mit Umlauten: äöü ÄÖÜ.", "😀 emoji 漢字 text", "One two three four five six seven.", "ends with <|endoftext|> here",
    ]
    rows = [(i, t, "en", "s", len(t or ""), 0.5, 7, "p") for i, t in enumerate(texts)]
    rows += [rows[0], (None, "One two three four five six seven.", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, length long, piece string")
