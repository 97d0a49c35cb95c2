"""Run a program: ``python -m kindred create|sweep|grid|elbow|radio ...``."""

from __future__ import annotations

import argparse

from kindred.functions.text import parse_integers
from kindred.plans import jobs
from kindred.schema import ALGORITHMS
from kindred.session import build_session, scratch

FORMS = ("text", "parquet")
#: Rows that are printed at most.
PREVIEW_ROWS = 1_000


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="kindred")
    programs = parser.add_subparsers(dest="program", required=True)

    create = programs.add_parser("create", help="playlist slices and features to song tables")
    create.add_argument("slices")
    create.add_argument("features")
    create.add_argument("output")

    sweep = programs.add_parser("sweep", help="one clustering for each K")
    sweep.add_argument("songs")
    sweep.add_argument("output")
    sweep.add_argument("errors")
    sweep.add_argument("k_values", type=parse_integers)
    sweep.add_argument("epsilon", type=float)
    sweep.add_argument("max_iters", type=int)
    sweep.add_argument("seed", type=int)
    sweep.add_argument("algorithm", choices=ALGORITHMS)
    sweep.add_argument("--form", choices=FORMS, default="text", help="of the songs")

    grid = programs.add_parser("grid", help="one clustering for each line of a setup file")
    grid.add_argument("songs")
    grid.add_argument("setups")
    grid.add_argument("output")
    grid.add_argument("algorithm", choices=ALGORITHMS)
    grid.add_argument("--name-centers", action="store_true")
    grid.add_argument("--form", choices=FORMS, default="text", help="of the songs")

    elbow = programs.add_parser("elbow", help="the table for choosing K")
    elbow.add_argument("errors")
    elbow.add_argument("--whole-results", action="store_true")

    radio = programs.add_parser("radio", help="more like one song")
    radio.add_argument("assignments")
    radio.add_argument("song_id")
    radio.add_argument("--output", help="folder for the whole result, as Parquet; what is printed is a preview")

    given = parser.parse_args(arguments)
    spark = build_session()
    with scratch(spark):
        run(spark, given)


def run(spark, given: argparse.Namespace) -> None:
    if given.program == "create":
        jobs.create_data(spark, given.slices, given.features, given.output)
    elif given.program == "sweep":
        jobs.sweep(
            spark, given.songs, given.output, given.errors, given.k_values,
            given.epsilon, given.max_iters, given.seed, given.algorithm, given.form,
        )
    elif given.program == "grid":
        jobs.grid(spark, given.songs, given.setups, given.output, given.algorithm, given.name_centers, given.form)
    elif given.program == "radio":
        found = jobs.radio(spark, given.assignments, given.song_id)
        if given.output:
            found.write.mode("overwrite").parquet(given.output)
            found = spark.read.parquet(given.output)
        _preview(found, "--output writes all rows")
    else:
        jobs.choose_k(spark, given.errors, given.whole_results).show(1000, truncate=False)


def _preview(found, remark: str) -> None:
    """Print the first ``PREVIEW_ROWS`` rows, and say so if there are more."""
    found.show(PREVIEW_ROWS, truncate=False)
    if len(found.take(PREVIEW_ROWS + 1)) > PREVIEW_ROWS:
        print(f"only the first {PREVIEW_ROWS} rows are shown; {remark}")


if __name__ == "__main__":
    main()
