"""The caller's columns, out of the way of an operator's own."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """A column by its whole name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


class Aside:
    """A frame whose columns are renamed by position, so that no other name can clash with them."""

    def __init__(self, frame: DataFrame) -> None:
        self.names = frame.columns
        self.held = [f"in_{i}" for i in range(len(self.names))]
        self.frame = frame.toDF(*self.held)

    def name(self, name: str) -> str:
        """The present name of a column of the caller; the case of letters does not matter if no name is equal."""
        same = [i for i, n in enumerate(self.names) if n == name] or [i for i, n in enumerate(self.names) if n.lower() == name.lower()]
        if not same:
            raise ValueError(f"there is no column {name}")
        return self.held[same[0]]

    def __getitem__(self, name: str) -> Column:
        return F.col(self.name(name))

    def back(self, frame: DataFrame, outputs: Iterable[str]) -> DataFrame:
        """The caller's columns under their names, and then the outputs, which replace columns of the same name."""
        outputs = list(outputs)
        taken = {name.lower() for name in outputs}
        own = [F.col(h).alias(n) for h, n in zip(self.held, self.names, strict=True) if n.lower() not in taken]
        return frame.select(*own, *outputs)
