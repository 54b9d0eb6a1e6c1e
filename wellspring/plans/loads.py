"""Full loads and updates of the five sources, as DataFrames.

Nothing here writes: each function returns the station and result rows to
append, see :mod:`wellspring.plans.jobs` for the writing jobs.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import dedupe
from ..operators.incremental import watermark
from ..sources import exported, sdwis, wqp
from ..sources.csvfiles import FILE
from .tails import Tables, transform_results, transform_stations


class Load(NamedTuple):
    stations: DataFrame
    results: DataFrame


def wqp_seed(
    stations: DataFrame, results: DataFrame, as_of: Column | datetime.datetime | None = None, tables: Tables = Tables(), keep: tuple[str, ...] = ()
) -> Load:
    """Extracts of one or many files: twins and balances are judged per file. With
    ``keep=(FILE,)`` the rows still say which."""
    return Load(
        transform_stations(dedupe.drop_twins(stations, (FILE,)), wqp.TAG, as_of, tables, keep=keep),
        transform_results(results, wqp.TAG, as_of, tables, scope=(FILE,), keep=keep),
    )


def wqp_update(
    stations: DataFrame,
    results: DataFrame,
    stored_stations: DataFrame,
    stored_results: DataFrame,
    today: datetime.date | None = None,
    as_of: Column | datetime.datetime | None = None,
    tables: Tables = Tables(),
    in_box: bool = True,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    since: datetime.date | None = None,
    known: Callable[[DataFrame], DataFrame] | None = None,
    again: DataFrame | None = None,
) -> Load:
    """Samples not stored yet, from the latest stored day on, and the stations
    they need. ``stations`` and ``results`` are landed extracts. ``stage`` may store
    rows that several steps read: the results of the window, so that text is read and its
    days are told once, the box's stations that those name, which are few and seldom make
    Spark shuffle the results, and the new results, which stations, details and balances
    are all derived from.

    ``since`` is the latest stored day, ``known`` gives the stored keys of the samples
    in some rows; without them ``stored_results`` is read for both.

    ``again`` are the results of files that were imported before and have changed; they
    are taken from any day on. Balances are then judged per file, and rows still say
    which they came from."""
    since, until = since or watermark(stored_results, wqp.TAG), today or datetime.date.today()
    results = wqp.results_window(results, since, until)
    scope = ()
    if again is not None:
        results, scope = results.unionByName(wqp.results_window(again, datetime.date(1000, 1, 1), until), allowMissingColumns=True), (FILE,)
    else:
        results = results.drop(FILE)  # a long text in every row, which no step needs
    if stage:
        results = stage(results)
    if in_box:
        stations = boxed = wqp.stations_in_box(stations)
        if stage:
            boxed = stage(dedupe.keep_known(dedupe.distinct_ids(results, "StationId"), stations, "StationId"))
        results = dedupe.keep_known(results, boxed, "StationId")
    fresh = dedupe.new_results_by_sample(results, known(results) if known else stored_results)
    if stage:
        fresh = stage(fresh)
    ids = dedupe.remove_stored_twins(dedupe.new_station_ids(fresh, stored_stations), stored_stations)
    batch = dedupe.drop_twins(dedupe.stations_by_id(stations, ids))
    return Load(
        transform_stations(batch, wqp.TAG, as_of, tables, keep=scope),
        transform_results(fresh, wqp.TAG, as_of, tables, scope=scope, keep=scope),
    )


def sdwis_seed(source: Mapping[str, DataFrame], as_of: Column | datetime.datetime | None = None, tables: Tables = Tables()) -> Load:
    """Everything the database holds; results without a sample id are left out."""
    results = sdwis.results(source).where(F.col("SampleId").isNotNull())
    return Load(
        transform_stations(sdwis.stations(source), sdwis.TAG, as_of, tables),
        transform_results(results, sdwis.TAG, as_of, tables),
    )


def sdwis_update(
    source: Mapping[str, DataFrame],
    stored_stations: DataFrame,
    stored_results: DataFrame,
    as_of: Column | datetime.datetime | None = None,
    tables: Tables = Tables(),
    balance: bool = False,
    stage: Callable[[DataFrame], DataFrame] = lambda df: df,
    since: datetime.date | None = None,
    known: Callable[[DataFrame], DataFrame] | None = None,
) -> Load:
    """Results after the latest stored day whose (day, sample, parameter) is new,
    and the stations they need.

    An update handles one parameter at a time, so by default it derives no
    balance; ``balance=True`` derives it per sample from the new rows. Rows
    without a sample id or parameter cannot be looked up by key and are left out.
    ``since`` and ``known`` as in :func:`wqp_update`.

    Each stage is small if the update is: Spark then knows its size, and neither the
    measurements nor the casings are shuffled to meet it.
    """
    since = since or watermark(stored_results, sdwis.TAG)
    measured = stage(sdwis.measured_samples(source, stage(sdwis.located_samples(source, since))))
    stored = known(sdwis.sample_ids(source, since, measured)) if known else stored_results
    recent = stage(stored.where(F.col("SampleDate") >= F.lit(since).cast("date")).select(*dedupe.SAMPLE_KEY))
    fresh = sdwis.results(source, since, recent, measured=measured)
    fresh = stage(fresh.where(F.col("SampleId").isNotNull() & F.col("Param").isNotNull()))
    ids = stage(dedupe.new_station_ids(fresh.select(F.col("StationId").cast("string")), stored_stations))
    return Load(
        transform_stations(sdwis.stations(source, ids), sdwis.TAG, as_of, tables),
        transform_results(fresh, sdwis.TAG, as_of, tables, balance=balance),
    )


def exported_seed(
    stations: DataFrame,
    results: DataFrame,
    program: exported.Program,
    as_of: Column | datetime.datetime | None = None,
    tables: Tables = Tables(),
) -> Load:
    """Exported tables: stations need a valid point, results a sample id."""
    return Load(
        transform_stations(stations, program.tag, as_of, tables, need_shape=True),
        transform_results(results.where(F.col("SampleId").isNotNull()), program.tag, as_of, tables),
    )


def only_new(load: Load, stored_stations: DataFrame, stored_results: DataFrame) -> Load:
    """Leave out what is stored already; for exports loaded a second time.

    Balance rows go by their sample like any other row.
    """
    return Load(
        dedupe.keep_new(load.stations, stored_stations, "StationId"),
        dedupe.new_results_by_sample(load.results, stored_results),
    )
