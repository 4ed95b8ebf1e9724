"""JDBC tables. Address and credentials come from the caller or the environment only."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class JdbcTarget:
    """Where to write. ``batchsize`` and ``num_partitions`` bound the load on the database:
    a write opens one connection per partition."""

    url: str
    table: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None
    batchsize: int = 10_000
    num_partitions: int | None = 16

    @classmethod
    def from_env(cls, table: str, prefix: str = "LUMETRA_JDBC_") -> JdbcTarget:
        url = os.environ.get(prefix + "URL")
        if not url:
            raise ValueError(f"set {prefix}URL")
        return cls(
            url=url, table=table, user=os.environ.get(prefix + "USER"),
            password=os.environ.get(prefix + "PASSWORD"), driver=os.environ.get(prefix + "DRIVER"),
        )

    def properties(self) -> dict[str, str]:
        given = {
            "user": self.user, "password": self.password, "driver": self.driver,
            "batchsize": str(self.batchsize),
            "numPartitions": None if self.num_partitions is None else str(self.num_partitions),
        }
        return {k: v for k, v in given.items() if v is not None}


def key_bounds(keys: DataFrame, key: str, parts: int) -> list:
    """Up to ``parts - 1`` ascending borders that cut a sample of a table's keys into parts of about the same size."""
    if parts < 2:
        return []
    shares = F.array([F.lit(i / parts) for i in range(1, parts)])
    return sorted(set(keys.agg(F.percentile_approx(key, shares, 10 * parts)).first()[0] or []))


def key_predicates(key: str, bounds: Sequence) -> list[str]:
    """Conditions that together hold each row once, null keys with the smallest."""
    if not bounds:
        return []
    first, *_, last = [bounds[0], *bounds]
    between = [f"{key} >= {_text(a)} AND {key} < {_text(b)}" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < {_text(first)} OR {key} IS NULL", *between, f"{key} >= {_text(last)}"]


def _text(value) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def read_jdbc(spark: SparkSession, target: JdbcTarget, key: str | None = None, bounds: Sequence = ()) -> DataFrame:
    """A table: one query per part that ascending ``bounds`` cut the values of ``key`` into (``key_bounds`` gives such
    from a sample, so that parts are alike however the keys lie), else one query and one partition."""
    properties = {k: v for k, v in target.properties().items() if k in ("user", "password", "driver")}
    predicates = key_predicates(key, bounds) if key else []
    if not predicates:
        return spark.read.jdbc(target.url, target.table, properties=properties)
    return spark.read.jdbc(target.url, target.table, predicates=predicates, properties=properties)


def append_jdbc(df: DataFrame, target: JdbcTarget) -> None:
    df.write.mode("append").jdbc(target.url, target.table, properties=target.properties())


def truncate_load_jdbc(df: DataFrame, target: JdbcTarget) -> None:
    """Empty the table, keeping its definition, and load it again."""
    properties = target.properties() | {"truncate": "true"}
    df.write.mode("overwrite").jdbc(target.url, target.table, properties=properties)
