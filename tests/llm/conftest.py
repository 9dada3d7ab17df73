import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("text_key", "row", "lines", "runs", "fingerprint", "root", "spans", "kept", "found", "model", "items")


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) or (doc_id, text, lang); with columns of clashing names on demand."""

    def build(rows, clash=False):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", "s", None if r[1] is None else len(r[1])) for r in rows
        ]
        schema = T.StructType.fromDDL(DOCUMENTS)
        if clash:
            for name in CLASHING:
                schema = schema.add(name, T.StringType())
            full = [(*r, *[f"{name} of {r[0]}" for name in CLASHING]) for r in full]
        return spark.createDataFrame(full, schema)

    return build

