"""Job entry point for ``spark-submit`` / ``python -m slaflow``.

    slaflow validate --input DIR_OR_CSV [--report PATH] [--expected-rows N] [--expected-invalid N]
    slaflow build-medallion --input DIR_OR_CSV --output DIR
    slaflow build-analytics --medallion DIR --output DIR
    slaflow build-process-intelligence (--input DIR_OR_CSV | --medallion DIR) --output DIR

The session comes from the cluster (``SparkSession.builder.getOrCreate``),
so master, memory and ``spark.checkpoint.dir`` are whatever the deployment
sets.  Exit code 0 = success / expectations met, 1 = expectations not met.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from slaflow.contract import default_contract, load_contract


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="slaflow")
    p.add_argument("--contract", help="JSON contract (default: the built-in service-request contract)")
    sub = p.add_subparsers(dest="command", required=True)
    v = sub.add_parser("validate")
    v.add_argument("--input", required=True)
    v.add_argument("--report")
    v.add_argument("--expected-rows", type=int)
    v.add_argument("--expected-invalid", type=int)
    m = sub.add_parser("build-medallion")
    m.add_argument("--input", required=True)
    m.add_argument("--output", required=True)
    a = sub.add_parser("build-analytics")
    a.add_argument("--medallion", required=True)
    a.add_argument("--output", required=True)
    pi = sub.add_parser("build-process-intelligence")
    source = pi.add_mutually_exclusive_group(required=True)
    source.add_argument("--input")
    source.add_argument("--medallion")
    pi.add_argument("--output", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    from slaflow.operators.validation import expectation_gate
    from slaflow.plans import jobs
    from slaflow.session import prepare_session

    args = _parser().parse_args(argv)
    contract = load_contract(args.contract) if args.contract else default_contract()
    spark = prepare_session(spark or SparkSession.builder.appName(f"slaflow-{args.command}").getOrCreate())

    if args.command == "validate":
        report = jobs.validate_file(spark, args.input, contract)
        if args.report:
            jobs.write_report(report, args.report, spark)
        print(f"rows={report['total_rows']} valid={report['valid_rows']} invalid={report['invalid_rows']}")
        return 0 if expectation_gate(report, args.expected_rows, args.expected_invalid) else 1
    if args.command == "build-medallion":
        print(jobs.run_medallion(spark, args.input, args.output, contract))
        return 0
    if args.command == "build-analytics":
        print(jobs.run_analytics(spark, args.medallion, args.output))
        return 0
    if args.command == "build-process-intelligence":
        if args.medallion:
            print(jobs.run_process_of_medallion(spark, args.medallion, args.output, contract))
        else:
            print(jobs.run_process_intelligence(spark, args.input, args.output, contract))
        return 0
    return 2


if __name__ == "__main__":
    sys.exit(main())
