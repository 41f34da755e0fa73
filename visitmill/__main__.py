"""Run one daily job: `python -m visitmill JOB ...`, or the same with spark-submit."""

from __future__ import annotations

import argparse
from pathlib import Path

from visitmill.functions.times import DEFAULT_ZONE, DEFAULT_ZONES, yesterday
from visitmill.plans import jobs
from visitmill.schema import INTENDED, REFERENCE, TEST_URLS
from visitmill.session import cluster_session


def _pair(text: str) -> tuple[str, str]:
    name, sign, value = text.partition("=")
    if not (name and sign and value):
        raise argparse.ArgumentTypeError(f"expected NAME=VALUE, got {text!r}")
    return name, value


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="visitmill")
    parser.add_argument("--database", default="default")
    parser.add_argument("--semantics", choices=(INTENDED, REFERENCE), default=INTENDED)
    parser.add_argument("--zone", default=DEFAULT_ZONE, help="zone of the tables' times and of the default day")
    steps = parser.add_subparsers(dest="job", required=True)
    clean = steps.add_parser("clean", help="raw files to the source table")
    clean.add_argument("path")
    clean.add_argument("--day", help="replace this day by its rows in the files; without, append")
    clean.add_argument("--overwrite", action="store_true", help="replace the hours that the files hold")
    clean.add_argument("--export", help="folder for a text export of the clean lines")
    clean.add_argument("--no-compact", dest="compact", action="store_false",
                       help="write without a shuffle, for files in time order")
    clean.add_argument("--zone-name", type=_pair, action="append", default=[], metavar="TOKEN=ZONE",
                       help="zone of a token in the times, e.g. CST=America/Chicago")
    clean.add_argument("--test-url", action="append", default=[], help="drop lines that hold this address")
    clean.add_argument("--on-bad-time", choices=("fail", "drop"), default="fail")
    for name, text in (("channel", "source to platform table"), ("region", "platform to area table")):
        step = steps.add_parser(name, help=text)
        step.add_argument("rules", help="path of the rule file")
        step.add_argument("--on-bad-rule", choices=("fail", "drop"), default="fail")
        step.add_argument("--day", help="default: yesterday")
    steps.add_parser("session", help="source to session table").add_argument("--day")
    metrics = steps.add_parser("metrics", help="all tables to metric tables")
    metrics.add_argument("--day")
    metrics.add_argument("--as-of", help="last day that counts for all-time members")
    metrics.add_argument("--scan-history", dest="incremental", action="store_false",
                         help="count all-time members from all days, without the members table")
    metrics.add_argument("--jdbc-url", help="append to this database instead of catalog tables")
    metrics.add_argument("--jdbc-properties", type=Path,
                         help="file of NAME=VALUE lines: user, password, driver")
    return parser


def properties(path: Path | None) -> dict[str, str]:
    lines = path.read_text().splitlines() if path else []
    return dict(_pair(line.strip()) for line in lines if line.strip() and not line.startswith("#"))


def main(argv: list[str] | None = None) -> None:
    chosen = arguments().parse_args(argv)
    spark = cluster_session(f"visitmill {chosen.job}")
    prefix = f"{chosen.database}."
    tables = jobs.Tables(*[f"{prefix}{name}" for name in
                           ("visit_source", "visit_platform", "visit_area", "visit_session")])
    mode = chosen.semantics
    jobs.create_tables(spark, tables, mode)
    day = chosen.day or yesterday(zone=chosen.zone)
    if chosen.job == "clean":
        jobs.clean_job(
            spark, chosen.path, tables, mode, chosen.overwrite, chosen.export, chosen.compact,
            chosen.day, zones=DEFAULT_ZONES | dict(chosen.zone_name), zone=chosen.zone,
            test_urls=(*TEST_URLS, *chosen.test_url), on_bad_time=chosen.on_bad_time)
    elif chosen.job == "channel":
        jobs.channel_job(spark, day, chosen.rules, tables, mode, chosen.on_bad_rule)
    elif chosen.job == "region":
        jobs.region_job(spark, day, chosen.rules, tables, mode, chosen.on_bad_rule)
    elif chosen.job == "session":
        jobs.session_job(spark, day, tables, mode)
    else:
        sink = (jobs.jdbc_sink(chosen.jdbc_url, properties(chosen.jdbc_properties)) if chosen.jdbc_url
                else jobs.table_sink(spark, day, prefix))
        jobs.metrics_job(spark, day, sink, tables, mode, chosen.as_of, incremental=chosen.incremental)


if __name__ == "__main__":
    main()
