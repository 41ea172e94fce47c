"""Stages take documents with any further columns, whatever these are called."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import wraps

from pyspark.sql import DataFrame

#: columns that operators know by name
KNOWN = {"doc_id", "text", "lang", "source", "n_chars"}


def free_name(name: str, taken: Iterable[str]) -> str:
    """``name``, with a number if a column is called so already (upper and lower case are the same)."""
    used, new, n = {t.lower() for t in taken}, name, 1
    while new.lower() in used:
        n += 1
        new = f"{name}_{n}"
    return new


def any_names(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let ``stage(docs, ...)`` see its further columns under plain names of their own.

    Names with dots, spaces or backticks, and names that the stage uses itself, come back as they
    were. A column that the stage adds gets a number if the documents have one of that name.
    """
    @wraps(stage)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        plain = [c if c in KNOWN else f"further{i}_" for i, c in enumerate(docs.columns)]
        out = stage(docs.toDF(*plain), *args, **kwargs)
        names, taken = dict(zip(plain, docs.columns, strict=True)), list(docs.columns)
        back = []
        for c in out.columns:
            if c not in names:
                names[c] = free_name(c, taken)
                taken.append(names[c])
            back.append(names[c])
        return out.toDF(*back)
    return run
