"""Documents for the tests of the operators on texts."""

from functools import lru_cache

import pandas as pd

FOLDER = "/root/testdata/sf0.001"


@lru_cache(1)
def documents() -> list[tuple]:
    """(doc_id, text) of every document at the smallest scale."""
    docs = pd.read_parquet(f"{FOLDER}/documents.parquet")
    return [(int(i), t) for i, t in zip(docs["doc_id"], docs["text"])]
