"""The nightly jobs: ``python -m tillflow.jobs {ingest,staff,daily,report} --help``."""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.options import GroupLimits, Options
from tillflow.plans.daily import daily_report, invoices_per_store
from tillflow.plans.invoices import invoice_lines
from tillflow.plans.kpi import StaffTables, staff_tables
from tillflow.plans.order_log import cancellations, final_lines
from tillflow.plans.period import keep_day, period_figures
from tillflow.schemas import DAILY_INVOICE, RECORDS, STAFF_INVOICE
from tillflow.session import build_session, drop_written, written
from tillflow.sinks.history import log_run, publish
from tillflow.sources import manifest, pages
from tillflow.sources.business_day import not_landed, read_business_day
from tillflow.sources.snapshots import run_day, write_snapshot


class IncompleteDay(ValueError):
    """Pages of a day are missing."""


def ingest(
    spark: SparkSession, landed: str, snapshots: str, dataset: str, day: dt.date, options: Options, strict: bool = False
) -> DataFrame:
    """Write the day's snapshot and manifest from its landed pages; returns the day's report.

    Nothing is written if the landed pages are those of the stored manifest, or if the day is incomplete and ``strict``.
    """
    # Parsed once, for the manifest and the records.
    landed_pages = written(pages.read_pages(spark, landed, dataset).where(F.col("_date") == day.isoformat()))
    found = written(manifest.manifest(landed_pages, dataset))
    report = written(manifest.day_report(found))
    missing = report.where(~F.col("complete"))
    if strict and not missing.isEmpty():
        raise IncompleteDay(f"{dataset} of {day}: {missing.count()} feeds are incomplete")
    if manifest.changes(manifest.read_manifest(spark, snapshots, dataset), found).isEmpty():
        return report
    rows = pages.records(manifest.without_repeats(landed_pages, found, dataset, options.limits), dataset)
    write_snapshot(rows, snapshots, dataset)
    manifest.write_manifest(found, snapshots, dataset)
    return report


def staff(spark: SparkSession, snapshots: str, day: dt.date, options: Options, literal: bool = False) -> StaffTables:
    def read(dataset: str, columns=None) -> DataFrame:
        return read_business_day(spark, snapshots, dataset, day, options.day_opens_at_hour, columns, options.limits)

    lines = invoice_lines(read("invoice", STAFF_INVOICE), read("invoice_line"), options, literal)
    final = final_lines(read("order_log"), options, literal)
    return staff_tables(lines, final, cancellations(read("removed_item"), literal), options)


def daily(
    spark: SparkSession, snapshots: str, stores: DataFrame, day: dt.date, literal: bool = False, opens_at_hour: int = 0
) -> DataFrame:
    invoices = read_business_day(spark, snapshots, "invoice", day, opens_at_hour, DAILY_INVOICE)
    return daily_report(invoices, stores, literal)


def report(
    spark: SparkSession,
    snapshots: str,
    out: str,
    day: dt.date,
    first: dt.date | None = None,
    upsell: Sequence[str] = (),
    opens_at_hour: int = 0,
) -> dict[str, int]:
    """Keep the day's counts, then publish the figures of the days ``first`` (else the day alone) to ``day``.

    A day of the period for which the job never ran has no counts, so the job is run once for each day.
    """
    keep_day(spark, snapshots, out, day, opens_at_hour)
    return publish(period_figures(spark, out, first or day, day, upsell), f"{out}/reports", day, clean=False)


def options_of(args: argparse.Namespace) -> Options:
    """The business switches as given on the command line."""
    given = {f.name: getattr(args, f.name) for f in dataclasses.fields(Options) if f.name != "limits"}
    given = {name: value for name, value in given.items() if value is not None}
    if args.identified_classes is not None:
        given["identified_classes"] = tuple(args.identified_classes)
    limits = GroupLimits() if args.max_rows is None else GroupLimits(args.max_rows)
    return Options(**given, limits=limits)


def add_switches(parser: argparse.ArgumentParser) -> None:
    """A flag for each field of :class:`Options`; without it the default holds."""
    switches = parser.add_argument_group("business switches")
    for f in dataclasses.fields(Options):
        flag = "--" + f.name.replace("_", "-")
        if isinstance(f.default, bool):
            switches.add_argument(flag, action=argparse.BooleanOptionalAction)
        elif isinstance(f.default, int):
            switches.add_argument(flag, type=int)
        elif f.name == "identified_classes":
            switches.add_argument(flag, nargs="*")
    switches.add_argument("--max-rows", type=int, help="rows of a block of ordered work")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["ingest", "staff", "daily", "report"])
    parser.add_argument("--day", help="ISO date; default yesterday at UTC+7")
    parser.add_argument("--landed", help="folder of landed pages")
    parser.add_argument("--snapshots", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--stores", help="Parquet table store_uid, store")
    parser.add_argument("--literal", action="store_true", help="payload cells hold Python literals")
    parser.add_argument("--strict", action="store_true", help="fail at ingest, and keep the old snapshot, if pages are missing")
    parser.add_argument("--from", dest="first", type=dt.date.fromisoformat, help="first day of the report; default the day")
    parser.add_argument("--upsell", nargs="*", default=[], help="categories that count as sold on top")
    add_switches(parser)
    args = parser.parse_args(argv)
    options, matched = options_of(args), None
    spark, day, rows, status, message = build_session(), run_day(args.day), {}, "success", None
    try:
        if args.job == "ingest":
            for dataset in RECORDS:
                feeds = ingest(spark, args.landed, args.snapshots, dataset, day, options, args.strict)
                sums = feeds.agg(F.coalesce(F.sum("landed"), F.lit(0)), F.count_if(~F.col("complete"))).first()
                rows[dataset] = sums[0]
                if sums[1]:
                    status, message = "incomplete", ", ".join(filter(None, [message, dataset]))
        elif args.job == "staff":
            tables = staff(spark, args.snapshots, day, options, args.literal)
            rows = publish(tables.published(), args.out, day, zero_fill_text=options.zero_fill_text)
            # At most four rows, one for each rule.
            matched = {r["matched_by"]: r["lines"] for r in tables.match_residuals.collect()}
            rows["lines_without_number"] = tables.lines_without_number.count()
        elif args.job == "report":
            rows = report(spark, args.snapshots, args.out, day, args.first, args.upsell, options.day_opens_at_hour)
        else:
            invoices = daily(spark, args.snapshots, spark.read.parquet(args.stores), day, args.literal, options.day_opens_at_hour)
            tables = {"daily_invoice": invoices, "invoices_per_store": invoices_per_store(invoices)}
            rows = publish(tables, args.out, day, clean=False)
            del rows["invoices_per_store"]
        if args.job in ("staff", "daily"):
            missing = not_landed(spark, args.snapshots, day, options.day_opens_at_hour)
            if missing:
                status, message = "incomplete", "next day not landed: " + ", ".join(missing)
        log_run(spark, args.out, args.job, day, rows, status, message, matched)
        print(json.dumps({"status": status, "date": str(day), "rows": rows} | ({"message": message} if message else {})))
    except Exception as error:
        log_run(spark, args.out, args.job, day, rows, "error", str(error))
        print(json.dumps({"status": "error", "message": str(error)}))
        raise
    finally:
        drop_written(spark)


if __name__ == "__main__":
    main()
