"""Mart registry sink (K4): sum the sales once for all marts, build each from the sums and write it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from salesmart.operators import marts


def write_sums(sales: DataFrame, path: str, more: list[list[str]] | None = None) -> DataFrame:
    """Sums for every mart's keys, and those of ``more``, as a table at ``path``, one folder per
    key set. The sales are read once, however many marts follow."""
    sets = [spec["keys"] for spec in marts.MARTS.values()]
    sets += [s for s in more or [] if s not in sets]
    marts.grouped_sums(sales, sets).write.mode("overwrite").partitionBy("key_set").parquet(path)
    return sales.sparkSession.read.parquet(path)


def build_marts(sums: DataFrame) -> dict[str, DataFrame]:
    """All nine marts of the reference plus their captions from ``write_sums``, lazily, by name."""
    out = {name: marts.mart(marts.of_keys(sums, spec["keys"]), name) for name, spec in marts.MARTS.items()}
    out["top_sub_categories_all"] = marts.top_sub_categories_all(
        marts.of_keys(sums, marts.MARTS["top_sub_categories"]["keys"]))
    out["mart_grand_totals"] = marts.grand_totals(out)
    return out


def write_marts(sums: DataFrame, sink: Callable[[str, DataFrame], None],
                names: list[str] | None = None) -> list[str]:
    """Write each mart through ``sink(name, df)``; returns the names written.

    ``sums`` is the table of ``write_sums``: a mart reads its key set's folder
    alone, and every top-k mart sends at most k rows per task to its final merge.
    """
    built = build_marts(sums)
    done = []
    for name in names or list(built):
        sink(name, built[name])
        done.append(name)
    return done


def parquet_sink(root: str, mode: str = "overwrite") -> Callable[[str, DataFrame], None]:
    """Sink writing each mart to ``root/<name>`` as parquet."""
    def write(name: str, df: DataFrame) -> None:
        df.write.mode(mode).parquet(f"{root.rstrip('/')}/{name}")
    return write


def jdbc_sink(url: str, properties: dict, prefix: str = "") -> Callable[[str, DataFrame], None]:
    """Sink writing each mart to a JDBC table ``prefix + name`` (overwrite)."""
    from salesmart.sources.jdbc import write_table

    def write(name: str, df: DataFrame) -> None:
        write_table(df, url, prefix + name, properties, mode="overwrite", num_partitions=1)
    return write
