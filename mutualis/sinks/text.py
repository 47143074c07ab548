"""Text sinks (SK1, SK2): one line per row, written by the tasks in parallel (one part file each)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def write_lines(df: DataFrame, path: str, line: Column | None = None, mode: str = "errorifexists",
                compression: str | None = None) -> str:
    """Write a one-string-column DataFrame (or ``line`` computed over ``df``) as text files.

    The default mode fails when the path exists, as ``write.text`` and ``saveAsTextFile`` do.
    """
    out = df.select(line.alias("value")) if line is not None else df
    if len(out.columns) != 1:
        raise ValueError("text sink needs exactly one string column (pass line=...)")
    w = out.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path
