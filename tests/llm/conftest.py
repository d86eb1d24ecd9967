from __future__ import annotations

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents from texts, or from (doc_id, text, lang, source) rows."""

    def build(*rows, columns=DOCUMENTS):
        full = [(i, r, "en", "s", None) if not isinstance(r, tuple) else (*r, *(None,) * (5 - len(r))) for i, r in enumerate(rows)]
        return spark.createDataFrame(full, columns)

    return build


@pytest.fixture
def tiny(spark, tmp_path):
    """A folder with one table ``documents`` of the given texts."""

    def build(frame, **others):
        for name, df in {"documents": frame, **others}.items():
            df.write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)

    return build


#: Texts every operator must take: null, empty, blank, one character, marks only.
ODD = [None, "", "  \n\t ", "x", "!!! ###", "é", "\x00\x01", "word " * 3]
