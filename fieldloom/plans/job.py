"""The enrichment job: load the catalogue, apply its rules, write the items back.

    python -m fieldloom.plans.job --tables DIR --output DIR [--state DIR]
    python -m fieldloom.plans.job --tables DIR --output DIR --state DIR --previous DIR --previous-state DIR
    python -m fieldloom.plans.job --url jdbc:... --schema prod

The first form reads Parquet tables and writes the updated item table to a new folder, and with
``--state`` the fingerprints of what it was made from; the second computes again only what has
changed since an earlier run; the third reads and upserts a database.
"""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Observation, SparkSession

from fieldloom.functions.metadata import load_metadata
from fieldloom.plans.incremental import enrich_changed, load_state, run_state, save_state
from fieldloom.plans.pipeline import enriched_rows
from fieldloom.sinks.jdbc import jdbc_upsert
from fieldloom.sinks.tables import ON_LOSS, upsert
from fieldloom.sources.catalogue import jdbc_reader, load_catalogue, parquet_reader
from fieldloom.sources.jdbc import read_metadata

logger = logging.getLogger(__name__)

METADATA_TABLES = ("category_field", "formula", "lu_field_name")


def _warn(counted: Observation | None, on_loss: str) -> None:
    for column, n in (counted.get if counted is not None else {}).items():
        if n:
            what = "became null" if on_loss == "warn" else "left the stored value"
            logger.warning("%s values of %s do not fit its type and %s", n, column, what)


def run_parquet(
    spark: SparkSession,
    root: str,
    output: str,
    on_loss: str = "fail",
    state: str | None = None,
    previous: tuple[str, str] | None = None,
    **options,
) -> None:
    """Enrich the tables under ``root`` and write the new item table to ``output``.

    ``state``: folder for the run's fingerprints; ``previous``: output and state of an earlier run,
    of which unchanged items keep their rows.
    """
    target = f"{root}/item.parquet"
    if os.path.normpath(output) == os.path.normpath(target):
        raise ValueError("the item table cannot be overwritten while it is being read")
    formulas = load_metadata(
        *[spark.read.parquet(f"{root}/{name}.parquet") for name in METADATA_TABLES]
    )
    tables, items = load_catalogue(parquet_reader(spark, root)), spark.read.parquet(target)
    if state is not None:
        made_from = dict(options, on_loss=on_loss)
        save_state(run_state(tables, formulas, items, made_from), state)
    if previous is not None:
        before = load_state(spark, previous[1])
        changed = enrich_changed(
            tables, formulas, items, spark.read.parquet(previous[0]), before, load_state(spark, state),
            on_loss=on_loss, **options,
        )
        changed.write.parquet(output)
        return
    rows, counted = enriched_rows(tables, formulas, on_loss, **options)
    # pick_category leaves one row per item, so the keys need no check.
    upsert(items, rows, ["id"], unique="assume").write.parquet(output)
    _warn(counted, on_loss)


def run_jdbc(
    spark: SparkSession,
    url: str,
    schema: str = "",
    properties: Mapping[str, str] | None = None,
    partitions: int = 10,
    dialect: str = "on_conflict",
    on_loss: str = "fail",
    even: bool = False,
    **options,
) -> None:
    """Enrich a database catalogue and upsert its item table.

    The database's statement writes whole columns, so ``keep`` is not offered here.
    """
    if on_loss == "keep":
        raise ValueError("on_loss='keep' needs the stored values; use 'fail' or 'warn'")
    place = f"{schema}." if schema else ""
    category_field, formula, names = (f"{place}{t}" for t in METADATA_TABLES)
    formulas = read_metadata(spark, url, category_field, formula, names, properties)
    tables = load_catalogue(jdbc_reader(spark, url, schema, properties, partitions, even))
    rows, counted = enriched_rows(tables, formulas, on_loss, **options)
    jdbc_upsert(
        rows, url, f"{place}item", rows.columns, ["id"], properties=properties, dialect=dialect
    )
    _warn(counted, on_loss)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Enrich catalogue items by category rules.")
    parser.add_argument("--tables", help="folder of Parquet tables")
    parser.add_argument("--output", help="folder for the new item table")
    parser.add_argument("--state", help="folder for the run's fingerprints")
    parser.add_argument("--previous", help="output of an earlier run; what is unchanged stays")
    parser.add_argument("--previous-state", help="fingerprints of that run")
    parser.add_argument("--url", help="JDBC url, instead of --tables")
    parser.add_argument("--schema", default="", help="database schema")
    parser.add_argument("--user-variable", help="environment variable holding the user name")
    parser.add_argument("--password-variable", help="environment variable holding the password")
    parser.add_argument("--partitions", type=int, default=10, help="parallel reads per table")
    parser.add_argument("--even-ranges", action="store_true", help="ranges of as many rows instead of as many ids")
    parser.add_argument("--syntax", default="lenient", choices=("lenient", "strict"))
    parser.add_argument("--on-invalid", default="fail", choices=("fail", "skip"))
    parser.add_argument(
        "--on-loss", default="fail", choices=ON_LOSS,
        help="what to do with computed values that their column's type cannot hold",
    )
    given = parser.parse_args(arguments)
    if bool(given.url) == bool(given.tables) or bool(given.tables) != bool(given.output):
        parser.error("give either --url or both --tables and --output")
    if bool(given.previous) != bool(given.previous_state) or given.previous and not given.state:
        parser.error("--previous needs --previous-state and --state")
    if given.state and given.url:
        parser.error("--state is for --tables")

    spark = SparkSession.builder.appName("fieldloom").getOrCreate()
    options = {"syntax": given.syntax, "on_invalid": given.on_invalid}
    options["on_loss"] = given.on_loss
    if given.tables:
        since = (given.previous, given.previous_state) if given.previous else None
        run_parquet(spark, given.tables, given.output, state=given.state, previous=since, **options)
        return
    named = {"user": given.user_variable, "password": given.password_variable}
    properties = {key: os.environ[variable] for key, variable in named.items() if variable}
    run_jdbc(spark, given.url, given.schema, properties, given.partitions, even=given.even_ranges, **options)


if __name__ == "__main__":
    main()
