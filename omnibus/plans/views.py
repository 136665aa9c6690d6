"""Named tables that are planned when first asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


class Views(dict):
    """A dict of DataFrames with builders for the names not yet planned."""

    def __init__(
        self,
        builders: dict[str, Callable[[], DataFrame]],
        known: dict[str, DataFrame] | None = None,
        by_route: dict[str, Callable[[DataFrame], DataFrame]] | None = None,
    ):
        super().__init__(known or {})
        self._builders = builders
        #: Views that can be made from the rows of some routes alone; each takes their ``route_id``.
        self.by_route = by_route or {}

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._builders[name]()
        return self[name]
