"""Run deliveries through the lake as one job, for ``spark-submit`` or ``python -m cohortloom``.

Prints the manifest; exits 1 when the published run passed too small a share of its rows.
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from cohortloom.plans.run import DEFAULT_MIN_PASS_RATE, QualityGateError, enforce_gate, run_all
from cohortloom.sources.lake import Lake


def _delivery(text: str) -> tuple[str, str]:
    study, _, path = text.partition("=")
    if not (study and path):
        raise argparse.ArgumentTypeError(f"{text!r} is not STUDY=path")
    return study, path


def _arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="cohortloom", description=__doc__)
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--root", help="URI of the folder that holds the layers")
    where.add_argument("--account-url", help="ADLS Gen2 account whose containers are the layers")
    parser.add_argument("--study", action="append", required=True, type=_delivery, metavar="STUDY=path")
    parser.add_argument("--multiline", action="append", default=[], metavar="STUDY", help="cells hold line breaks")
    parser.add_argument("--one-line", action="append", default=[], metavar="STUDY", help="cells hold no line breaks")
    parser.add_argument("--run-id")
    parser.add_argument("--min-pass-rate", type=float, default=DEFAULT_MIN_PASS_RATE)
    return parser.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> int:
    args = _arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("cohortloom").getOrCreate()
    lake = Lake.at(spark, args.root) if args.root else Lake.in_account(spark, args.account_url)
    known = dict.fromkeys(args.multiline, True) | dict.fromkeys(args.one_line, False)
    manifest = run_all(lake, dict(args.study), args.run_id, known)
    print(manifest.to_json())
    try:
        enforce_gate(manifest, args.min_pass_rate)
    except QualityGateError as error:
        logging.error("%s", error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
