"""File sinks (K1, R2)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, num_files: int = 10, mode: str = "overwrite",
              header: bool = True, narrow: bool = False) -> None:
    """K1/R2: headered CSV in at most ``num_files`` files.

    ``narrow=True`` merges partitions without a shuffle (``coalesce``), as the
    reference does; that also caps the parallelism of the stage that computes
    ``df`` at ``num_files`` tasks, which starves a large final aggregation.
    The default instead shuffles the finished result into ``num_files``
    partitions, so the work before it keeps its full parallelism.
    """
    out = df.coalesce(num_files) if narrow else df.repartition(num_files)
    out.write.mode(mode).option("header", "true" if header else "false").csv(path)
