"""An update from the database: what is read, and which stored keys meet its rows."""

import datetime

from pyspark.sql import functions as F

from checks import views as V
from wellspring.functions import casting
from wellspring.model import schema as S
from wellspring.operators.columns import cast_to_schema
from wellspring.plans import loads
from wellspring.session import staged

SF = "/root/testdata/sf0.001"
SINCE = datetime.date(1996, 5, 31)


def test_update_reads_measurements_once(spark):
    """The ids that the index is asked for and the results come from one join, and keys
    of days before the update do not meet its rows."""
    source = V.sdwis_tables(spark, SF)
    source["tsasar"] = staged(source["tsasar"], "tsasar")
    stored = V.view(spark, SF, V.STORED_SDWIS)
    readers, kept = [], []

    def seen(rows):
        readers.append(any("/tsasar-" in file for file in rows.inputFiles()))

    def stage(rows):
        seen(rows)
        rows = staged(rows, "stage")
        if set(rows.columns) == {"SampleDate", "SampleId", "Param"}:
            kept.append(rows)
        return rows

    def known(rows):
        seen(rows)
        return stored

    load = loads.sdwis_update(source, V.view(spark, SF, V.STORED_SDWIS_STATIONS), stored, V.as_of(), stage=stage, since=SINCE, known=known)
    seen(load.results)
    assert sum(readers) == 1
    assert [rows.where(F.col("SampleDate") < F.lit(SINCE)).count() for rows in kept] == [0]
    plain = loads.sdwis_update(source, V.view(spark, SF, V.STORED_SDWIS_STATIONS), stored, V.as_of(), since=SINCE)
    for one, other in zip(load, plain, strict=True):
        assert one.count() > 0
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_keys_of_the_last_stored_day_count(spark):
    """A sample of that day, collected after midnight, is taken unless it is stored."""
    source = V.sdwis_tables(spark, SF)
    at = F.when(F.col("TSASAMPL_IS_NUMBER") % 2 == 0, F.lit("1996-05-31 10:00:00")).otherwise(F.lit("1996-05-30 10:00:00"))
    source["tsasampl"] = source["tsasampl"].withColumn("COLLLECTION_END_DT", at.cast("timestamp_ntz"))
    none = V.view(spark, SF, V.STORED_SDWIS_STATIONS)
    update = lambda stored: loads.sdwis_update(source, none, stored, V.as_of(), since=SINCE).results
    keys = [F.col("SampleId"), F.lit(SINCE).alias("SampleDate"), F.upper("Param").alias("Param")]
    empty = V.view(spark, SF, V.STORED_SDWIS).limit(0)
    rows = update(empty)
    assert rows.where(F.col("SampleDate").cast("date") == F.lit(SINCE)).count() == rows.count() > 0
    half = rows.where(F.crc32("SampleId") % 2 == 0)
    left = update(staged(half.select(*keys).distinct(), "stored"))
    lost = rows.where((F.crc32("SampleId") % 2 == 0) & F.col("Param").isin("calcium", "lead"))
    assert 0 < left.count() < rows.count()
    assert lost.count() > 0 and left.where((F.crc32("SampleId") % 2 == 0) & F.col("Param").isin("calcium", "lead")).isEmpty()
    assert left.where(F.crc32("SampleId") % 2 == 1).count() == rows.where(F.crc32("SampleId") % 2 == 1).count()


def test_numbers_are_written_once(spark):
    rows = spark.createDataFrame([(12, 1.5, -7), (None, None, None)], "StationId long, OrgId double, ResultComment int")
    cast = cast_to_schema(rows, S.RESULT, V.as_of())
    assert [tuple(r) for r in cast.select("StationId", "OrgId", "ResultComment").collect()] == [("12", "1.5", "-7"), (None, None, None)]
    text = cast._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("as string)") == 3


def test_times_by_their_bytes(spark):
    cells = {
        "10:30": "10:30:00", "00:00": "00:00:00", "23:59": "23:59:00", "24:00": None, "19:60": None, "3:059": None, "1:5:9": "01:05:09",
        "9:5": "09:05:00", "23:59:59": "23:59:59", "2a:10": None, "1é:5": None, "12345": None, "12": "12:00:00", "": None,
    }
    rows = spark.createDataFrame([*((c,) for c in cells), (None,)], "c string")
    assert {r.c: r.t for r in rows.select("c", casting.to_time(F.col("c")).alias("t")).collect()} == {**cells, None: None}
