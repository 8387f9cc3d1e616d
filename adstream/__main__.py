"""Command line: run the application, or print the reports on its tables.

    python -m adstream run --root /shared/ads --format kafka --servers host:9092
    python -m adstream report --root /shared/ads

Settings of the session itself (master, packages, state store) are those of
``spark-submit`` or of the Spark configuration files.
"""

from __future__ import annotations

import argparse
import os

from adstream.config import TablePaths
from adstream.plans.reports import all_reports
from adstream.session import build_session
from adstream.sources.messages import TOPICS, kafka_options
from adstream.streaming.runner import CLICK_SCOPES, await_first_end, run_pipeline


def _arguments(args: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="adstream", description=__doc__.splitlines()[0])
    parser.add_argument("command", choices=["run", "report"])
    parser.add_argument("--root", required=True, help="folder of the tables and checkpoints")
    parser.add_argument("--format", default="kafka", help="source of the messages: kafka, parquet or text")
    parser.add_argument("--servers", help="addresses of the message brokers")
    parser.add_argument("--user-variable", help="environment variable with the broker user")
    parser.add_argument("--password-variable", help="environment variable with the broker password")
    parser.add_argument("--max-offsets", type=int, help="most messages per topic and trigger")
    parser.add_argument("--topics", help="folder of the topics, for sources that are files")
    parser.add_argument("--table-format", default="parquet")
    parser.add_argument("--click-scope", choices=list(CLICK_SCOPES), help="deferred where tables allow it")
    parser.add_argument("--alert-mode", default="merge", choices=["merge", "complete", "append", "update"])
    parser.add_argument("--once", action="store_true", help="process what is there, then end")
    return parser.parse_args(args)


def _sources(chosen: argparse.Namespace) -> dict[str, dict[str, str]]:
    if chosen.format != "kafka":
        return {kind: {"path": f"{chosen.topics}/{topic}"} for kind, topic in TOPICS.items()}
    user = os.environ[chosen.user_variable] if chosen.user_variable else None
    password = os.environ[chosen.password_variable] if chosen.password_variable else None
    return {
        kind: kafka_options(
            chosen.servers, topic, user, password, max_offsets_per_trigger=chosen.max_offsets
        )
        for kind, topic in TOPICS.items()
    }


def main(args: list[str] | None = None) -> None:
    chosen = _arguments(args)
    spark = build_session()
    paths = TablePaths(chosen.root)
    if chosen.command == "report":
        for title, report in all_reports(spark, paths, chosen.alert_mode, chosen.table_format).items():
            print(title)
            report.show(truncate=False)
        return
    run_pipeline(
        spark,
        chosen.format,
        _sources(chosen),
        paths,
        click_scope=chosen.click_scope,
        alert_mode=chosen.alert_mode,
        trigger={"availableNow": True} if chosen.once else None,
        table_format=chosen.table_format,
    )
    if not chosen.once:
        await_first_end(spark)


if __name__ == "__main__":
    main()
