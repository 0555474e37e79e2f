"""A set of named relations, each built when it is first used."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame


class Relations:
    """Attribute access builds a relation once and keeps the (lazy) DataFrame.

    A query that touches two of five tables then opens two tables.
    """

    def __init__(self, **builders: Callable[[], DataFrame]):
        self._builders = builders

    def __getattr__(self, name: str) -> DataFrame:
        builder = self.__dict__.get("_builders", {}).get(name)
        if builder is None:
            raise AttributeError(name)
        df = builder()
        setattr(self, name, df)
        return df

    def items(self) -> Iterator[tuple[str, DataFrame]]:
        return ((name, getattr(self, name)) for name in self._builders)

    def replace(self, **frames: DataFrame) -> Relations:
        """The same relations with some of them exchanged."""
        fixed = {name: (lambda df=df: df) for name, df in frames.items()}
        kept = {name: (lambda n=name: getattr(self, n)) for name in self._builders}
        return Relations(**{**kept, **fixed})
