"""Command line: ``python -m veilspark.cli``. A flag goes before its environment variable, that before the default."""
from __future__ import annotations

import argparse
import logging
import os
import sys
from pathlib import Path

from veilspark import __version__
from veilspark.plans.errors import RunError
from veilspark.plans.run import Paths, run


class _Parser(argparse.ArgumentParser):
    def error(self, message: str):
        raise RunError("CLI_INVALID_ARGUMENT", message)


def parse(argv: list[str], env: dict[str, str] | None = None) -> Paths:
    env = dict(os.environ if env is None else env)
    p = _Parser(prog="veilspark", description="Anonymise a table, nested documents or FHIR bundles.")
    for short, long, text in (("-c", "--config", "configuration file, or a folder with one"), ("-d", "--data", "input folder or file"), ("-o", "--output", "folder of the results"), ("-k", "--keys", "folder of keys, salts and tokens; not inside the output"), ("-r", "--root", "folder the defaults hang off")):
        p.add_argument(short, long, help=f"{text} [env: VEILSPARK_{long[2:].upper()}]")
    p.add_argument("--chunks", help="accepted for compatibility; Spark needs no chunk folder")
    p.add_argument("-V", "--version", action="version", version=__version__)
    a = vars(p.parse_args(argv))
    for name in ("config", "data", "output", "keys", "root", "chunks"):
        if a[name] is not None and not a[name].strip():
            raise RunError("CLI_INVALID_ARGUMENT", "an argument is empty", f"--{name}")
    get = lambda name: a[name] or env.get(f"VEILSPARK_{name.upper()}") or None
    root = Path(get("root") or ".")
    at = lambda name: Path(get(name)) if get(name) else root / name
    return Paths(at("config"), at("data"), at("output"), Path(get("keys")) if get("keys") else None, root)


def main(argv: list[str] | None = None) -> int:
    from pyspark.sql import SparkSession

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s", stream=sys.stderr)
    try:
        paths = parse(sys.argv[1:] if argv is None else argv)
    except RunError as e:
        print(e, file=sys.stderr)
        return 1
    spark = SparkSession.builder.appName("veilspark").getOrCreate()
    status = run(spark, paths)
    print(status["status"], file=sys.stderr)
    return 0 if status["status"] != "error" else 1


if __name__ == "__main__":
    sys.exit(main())
