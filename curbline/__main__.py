"""Build or check a warehouse: spark-submit curbline/__main__.py RAW WAREHOUSE ZONES."""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from curbline.contracts import RAW_SCHEMA  # noqa: E402
from curbline.plans.quality import study_months  # noqa: E402
from curbline.plans.warehouse import TABLES, run_warehouse  # noqa: E402
from curbline.session import build_session  # noqa: E402
from curbline.sinks.jdbc import JdbcSink, duplicate_key_statement, merge_statement  # noqa: E402
from curbline.sinks.publish import ParquetSink, audit_outputs, publish_report  # noqa: E402
from curbline.sources.files import discover_months  # noqa: E402

STATEMENTS = {"merge": merge_statement, "duplicate-key": duplicate_key_statement}


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="curbline")
    parser.add_argument("raw", help="folder of month files")
    parser.add_argument("warehouse", help="root folder of the layer tables")
    parser.add_argument("zones", help="CSV of the zone dimension")
    parser.add_argument("--check", action="store_true", help="only report which tables are there")
    parser.add_argument("--study", metavar="FOLDER", help="also write profiles and odd rows of all raw months")
    parser.add_argument("--allow-losses", action="store_true", help="load values as NULL or cut that their types cannot hold")
    parser.add_argument("--publish", metavar="FOLDER", help="publish the tables as Parquet")
    parser.add_argument("--jdbc", metavar="URL", help="publish to a database; JDBC_USER and JDBC_PASSWORD are read")
    parser.add_argument("--upsert-by", choices=STATEMENTS, default="merge", help="statement the database understands")
    options = parser.parse_args(arguments)

    spark = build_session()
    if options.check:
        audit = audit_outputs(spark, options.warehouse, TABLES)
    else:
        loaded, audit = run_warehouse(spark, options.raw, options.warehouse, options.zones, RAW_SCHEMA, options.allow_losses)
        print("months loaded:", ", ".join(loaded.months) or "none")
    audit.show(truncate=False)
    if options.study:
        months = [row["month_path"] for row in discover_months(spark, options.raw).collect()]
        print("studied:", ", ".join(study_months(spark, months, options.study, RAW_SCHEMA)))
    if not options.check:
        sinks = []
        if options.publish:
            sinks.append(ParquetSink(options.publish))
        if options.jdbc:
            names = {"user": "JDBC_USER", "password": "JDBC_PASSWORD"}
            properties = {key: os.environ[name] for key, name in names.items() if name in os.environ}
            sinks.append(JdbcSink(options.jdbc, properties, STATEMENTS[options.upsert_by]))
        for sink in sinks:
            publish_report(spark, options.warehouse, sink).show(truncate=False)
    return 0 if audit.where("NOT ok").isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
