"""Names of input columns that can never meet an operator's own: they are renamed on the way in and back on the way out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class Own:
    """The columns of ``df``, without those that the result ``replaced``, as ``_c0``, ``_c1``, ... inside an operator."""

    def __init__(self, df: DataFrame, replaced: Iterable[str] = ()):
        gone = set(replaced)
        self.key = {c: f"_c{i}" for i, c in enumerate(df.columns)}
        self.names = [c for c in df.columns if c not in gone]
        self.df = df.select(*[F.col(quoted(c)).alias(k) for c, k in self.key.items()])

    def keys(self) -> list[str]:
        """The inner names of the columns that the result keeps."""
        return [self.key[c] for c in self.names]

    def back(self, **new: Column) -> list[Column]:
        """The kept columns under their own names; those in ``new`` with another value."""
        return [new.get(c, F.col(self.key[c])).alias(c) for c in self.names]
