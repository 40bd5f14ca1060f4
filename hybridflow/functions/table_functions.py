"""User functions over the partitions of a table: a stateful flat map as a Python table function."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.udtf import UserDefinedTableFunction

SALTS = 16


class FlatMap:
    """A flat map with state of its own for each partition of its input, which comes in order.

    ``open`` is called before a partition's first row, ``flat_map`` with each row, ``close`` after its
    last; the latter two may give rows.
    """

    def open(self) -> None:
        pass

    def flat_map(self, row: Row) -> Iterator[tuple]:
        raise NotImplementedError

    def close(self) -> Iterator[tuple]:
        return iter(())


def table_function(kind: type[FlatMap], returns: str) -> UserDefinedTableFunction:
    """``kind`` as a table function with the columns ``returns``."""

    class Partitioned:
        def __init__(self):
            self.user = kind()
            self.user.open()

        def eval(self, row: Row):
            yield from self.user.flat_map(row)

        def terminate(self):
            yield from self.user.close()

    return F.udtf(Partitioned, returnType=returns)


def register(spark: SparkSession, name: str, kind: type[FlatMap], returns: str) -> None:
    """Make ``kind`` known to SQL: ``SELECT * FROM name(TABLE(t) PARTITION BY k ORDER BY ts)``."""
    spark.udtf.register(name, table_function(kind, returns))


def flat_map_table(
    df: DataFrame, kind: type[FlatMap], returns: str, partition: list[str], order: list[str]
) -> DataFrame:
    """Rows that ``kind`` gives for each partition of ``df``, its rows coming in ``order``."""
    table = df.asTable().partitionBy(*partition).orderBy(*order)
    return table_function(kind, returns)(table)


def connected(
    stream: DataFrame, batch: DataFrame, key: list[str], salts: int = SALTS, salt: str = "salt"
) -> DataFrame:
    """Two inputs as one for a flat map over (key, salt): ``side`` 0 is the batch side, which sorts first.

    Rows of the stream are dealt to the salts of their key, and batch rows go to all of them, so a key
    that holds most rows is the work of ``salts`` partitions. Columns that one side lacks are null there. A
    null key meets nothing, so batch rows without one are left out.
    """
    dealt = F.pmod(F.xxhash64(*stream.columns), F.lit(salts)).cast("int")
    a = stream.withColumns({"side": F.lit(1), salt: dealt})
    known = batch.where(" and ".join(f"{k} is not null" for k in key))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return a.unionByName(known.withColumn("side", F.lit(0)).withColumn(salt, every), allowMissingColumns=True)
