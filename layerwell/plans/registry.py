"""Registered table functions, looked up by table name."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from layerwell.errors import ConfigError, MissingInputError

SilverTransform = Callable[[DataFrame], DataFrame]
GoldBuilder = Callable[[Mapping[str, DataFrame]], DataFrame]


class Registry:
    """Maps table names to functions; asking for an unknown one is an error."""

    def __init__(self, kind: str) -> None:
        self.kind = kind
        self._functions: dict[str, Callable] = {}

    def register(self, table: str, function: Callable | None = None):
        """Use as ``register("t", fn)`` or as the decorator ``@register("t")``."""
        if function is None:
            return lambda f: self.register(table, f)
        self._functions[table] = function
        return function

    def get(self, table: str) -> Callable:
        if table not in self._functions:
            raise ConfigError(f"no {self.kind} is registered for table {table!r}")
        return self._functions[table]

    def copy(self) -> Registry:
        other = Registry(self.kind)
        other._functions.update(self._functions)
        return other


def required_input(inputs: Mapping[str, DataFrame], table: str) -> DataFrame:
    if inputs.get(table) is None:
        raise MissingInputError(f"input table {table!r} is missing")
    return inputs[table]
