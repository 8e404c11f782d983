"""The registered queries of this package and their SQL twins."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beatline.llm import queries as registered, twins
from beatline.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]


def _with_settings(function: Query) -> Query:
    return lambda spark, sf_dir: function(apply_settings(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {name: _with_settings(function) for name, function in registered.QUERIES.items()}


def statements() -> dict[str, str]:
    return dict(twins.STATEMENTS)
