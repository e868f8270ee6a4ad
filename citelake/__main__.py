"""``python -m citelake <step> …``, to be run by spark-submit or in a local session."""

from __future__ import annotations

import argparse

from citelake.operators.integrity import failed_files
from citelake.plans import load
from citelake.session import get_spark, stage
from citelake.sinks.tables import run_totals


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="citelake")
    steps = top.add_subparsers(dest="step", required=True)

    def step(name: str, *positional: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        return sub

    step("verify", "path").add_argument("--failed", help="where to write the failed files")
    step("convert", "path", "out")
    enrich = step("enrich", "path", "registry", "out")
    loads = [step("load-json", "path", "out", "run_id")]
    loads.append(step("load-xml", "path", "registry", "out", "run_id"))
    for sub in (enrich, loads[1]):
        sub.add_argument("--mode", choices=("fallback", "independent"), default="fallback")
        sub.add_argument("--registry-layout", choices=("array", "lines"), default="array")
    for sub in (enrich, loads[0]):
        sub.add_argument("--layout", choices=("lines", "files"), default="lines")
    enrich.add_argument("--batch-size", type=int)
    for sub in loads:
        sub.add_argument("--gate", choices=sorted(load.GATES), default="any")
        sub.add_argument("--min-year", type=int)
    step("load-vocabulary", "path", "out", "run_id")
    step("curate", "registry", "sheet", "out")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_spark()
    if args.step == "verify":
        statuses = stage(load.verify_files(spark, args.path), "statuses")
        run_totals(statuses).show()
        if args.failed:
            failed_files(statuses).write.mode("append").json(args.failed)
    elif args.step == "convert":
        bad = load.convert_xml(spark, args.path, args.out)
        bad.write.mode("append").json(f"{args.out}-quarantine")
    elif args.step == "enrich":
        bad = load.enrich_json(
            spark,
            args.path,
            args.registry,
            args.out,
            args.mode,
            args.layout,
            args.batch_size,
            args.registry_layout,
        )
        bad.write.mode("append").json(f"{args.out}-quarantine")
    elif args.step == "load-json":
        load.load_json(
            spark, args.path, args.out, args.run_id, args.gate, args.min_year, args.layout
        )
    elif args.step == "load-xml":
        load.load_xml(
            spark,
            args.path,
            args.registry,
            args.out,
            args.run_id,
            args.mode,
            args.gate,
            args.min_year,
            args.registry_layout,
        )
    elif args.step == "load-vocabulary":
        load.load_vocabulary(spark, args.path, args.out, args.run_id)
    elif args.step == "curate":
        load.curate_registry(spark, args.registry, args.sheet, args.out)


if __name__ == "__main__":
    main()
