"""Compare registered queries with their SQL twins on one test directory.

``python -m checks.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName("casebind")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # test tables are small but fan out: do not squeeze them onto one or two cores
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    text = frame.map(lambda v: "~" if pd.isna(v)
                     else f"{v:.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool)
                     else str(v).removesuffix(" 00:00:00"))
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    """Empty when the query and its twin return the same columns and rows."""
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = con.execute(ORACLES[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(set(ours.columns) ^ set(theirs.columns))}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, expected {len(theirs)}"
    a, b = _normal(ours), _normal(theirs)
    if not a.equals(b):
        at = (a != b).any(axis=1)
        return f"{int(at.sum())} rows differ:\n{a[at].head(3)}\n{b[at].head(3)}"
    return ""


def main(sf_dir: str = "/root/testdata/sf0.001", *names: str) -> int:
    spark, con, bad = session(), duck(sf_dir), 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = difference(spark, con, sf_dir, name) if name in ORACLES else "no SQL twin"
        except Exception as error:  # report and go on to the next query
            problem = "".join(traceback.format_exception_only(error))[:1500]
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
