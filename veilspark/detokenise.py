"""``python -m veilspark.detokenise IN.csv OUT.csv --keys KEYS --columns a,b``: tokens back to values by the vault."""
from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from veilspark.operators.techniques import Vault, detokenise
from veilspark.sources import sinks, tables


def run(spark: SparkSession, source: str, target: str, keys: str, columns: list[str]) -> dict[str, int]:
    """Write the table with values for tokens; how many tokens of each column were not known."""
    vault = Vault(spark, Path(keys) / "tokens")
    df, unknown = tables.read_csv(spark, source), {}
    for c in columns:
        df, count = detokenise(df, c, vault)
        unknown[c] = count.first()[0]
    sinks.write_csv(df, target)
    return unknown


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="veilspark.detokenise", description=__doc__)
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--keys", required=True)
    p.add_argument("--columns", required=True)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("veilspark-detokenise").getOrCreate()
    for column, n in run(spark, a.source, a.target, a.keys, a.columns.split(",")).items():
        print(f"{column}: {n} tokens not known", file=sys.stderr)
    return 0


if __name__ == "__main__":
    sys.exit(main())
