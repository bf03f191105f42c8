"""A set of named tables, each defined the first time it is asked for."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame


class TableSet(Mapping[str, DataFrame]):
    """Looks like a dict of DataFrames; touches no file before a lookup."""

    def __init__(self, define: Mapping[str, Callable[[], DataFrame]]) -> None:
        self._define = dict(define)
        self._defined: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._defined:
            self._defined[name] = self._define[name]()
        return self._defined[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._define)

    def __len__(self) -> int:
        return len(self._define)
