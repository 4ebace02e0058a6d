"""Registered queries of the landing zone: the test tables go out as raw files and come back through a load."""

from __future__ import annotations

import itertools
import uuid
import zipfile
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.csv import write_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.plans import refresh
from skyledger.session import drop_work, keep_compiled, shuffles_freed, work_dir
from skyledger.sources import driver_tables as d
from skyledger.sources import files, ingest
from skyledger.sources.schemas import MARKET_COLUMNS, SEGMENT_COLUMNS

SCOPES = ("domestic", "international")
#: Batches of rows that the archives written for a test hold between them.
ARCHIVED_BATCHES = 20
#: Of compressed raw files, each of which one task reads.
ROWS_PER_FILE = 500_000


def _messy(name: str) -> str:
    """Header cells as raw files spell them; normalising gives the column's name back."""
    return f' {name.upper().replace("_", " ")} '


def write_raw(
    rows: DataFrame, path: str, header: bool = True, encoding: str = "UTF-8", one_folder_per: tuple[str, ...] = (), compression: str = "none"
) -> str:
    """CSV files with shouting headers, quoted commas and an empty last column; if asked, a folder ``column=value`` for each value.

    Compressed files cannot be split, so they have at most ``ROWS_PER_FILE`` rows."""
    keep_compiled(rows.sparkSession)
    out = rows.withColumnsRenamed({c: _messy(c) for c in rows.columns if c not in one_folder_per}) if header else rows
    if header:
        out = out.withColumn(" ", F.lit(None).cast("string"))
    write = out.write.options(
        header=header, quote='"', escape='"', encoding=encoding, emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression,
        maxRecordsPerFile=0 if compression == "none" else ROWS_PER_FILE,
    )
    (write.partitionBy(*one_folder_per) if one_folder_per else write).csv(path)
    return path


def _raw_scope(spark: SparkSession, sf: str, scope: str) -> DataFrame:
    return d.bronze_segment(spark, sf).filter(F.col("_data_scope") == scope).drop("_data_scope")


def _by_scope(rows: DataFrame, path: str, *folders: str, compression: str = "none") -> dict[str, str]:
    """Both scopes written out in one pass, each in a folder of its own and, below it, one for each value of ``folders``."""
    write_raw(rows.withColumnRenamed("_data_scope", "scope"), path, one_folder_per=("scope", *folders), compression=compression)
    return {scope: f"{path}/scope={scope}" for scope in SCOPES}


def _raw_files(spark: SparkSession, sf: str) -> dict[str, str]:
    """Both scopes written out once."""
    return _by_scope(d.bronze_segment(spark, sf), f"{work_dir(spark, 'raw')}/segment")


# The columns that the test tables fill; the table's others must come back empty.
FILLED = [
    "departures_scheduled", "departures_performed", "payload", "seats", "passengers", "freight", "mail", "distance", "ramp_to_ramp", "air_time",
    "unique_carrier", "unique_carrier_name", "origin", "origin_city_name", "origin_state_abr", "origin_country_name", "dest", "dest_city_name",
    "dest_state_abr", "dest_country_name", "aircraft_type", "month", "class",
]


def _landed(rows: DataFrame) -> DataFrame:
    """Per scope and year: rows, and per column the cells that are there, their characters, the first and the last.

    Next to first and last texts alone Spark would sort all rows, whole, by group. The first class is taken from the set of classes, of
    which there are few: groups with a set are kept in a hash table, and nothing is sorted.
    """
    keep_compiled(rows.sparkSession)
    first = {c: F.min(c) for c in FILLED} | {"class": F.array_min(F.collect_set("class"))}
    cells = [
        x
        for c in FILLED
        for x in (F.count(c).alias(f"{c}_cells"), F.sum(F.length(c)).alias(f"{c}_chars"), first[c].alias(f"{c}_first"), F.max(c).alias(f"{c}_last"))
    ]
    rest = [F.count(c) for c in SEGMENT_COLUMNS if c not in (*FILLED, "year", "carrier", "region")]
    return rows.groupBy("_data_scope", "year").agg(
        F.count(F.lit(1)).alias("rows"), *cells, sum(rest[1:], rest[0]).alias("other_cells"), F.count_if(F.col("carrier") == F.col("unique_carrier")).alias("carriers")
    )


def _read_folder(spark: SparkSession, path: str) -> DataFrame:
    (parts,) = files.list_units(spark, [path]).values()
    return files.read_files(spark, files.inspect_files(spark, parts), tuple(SEGMENT_COLUMNS))


def read_text_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Headered CSV read without loading: names normalised, cells as text, missing columns NULL."""
    base = work_dir(spark, "raw")
    rows = d.bronze_segment(spark, sf)
    path = write_raw(rows.withColumnRenamed("_data_scope", "region"), f"{base}/all")
    return _landed(_read_folder(spark, path).withColumn("_data_scope", F.col("region")))


def decode_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Files with accents, euro signs and dashes in a one-byte encoding (Windows-1252), recognised and decoded."""
    base = work_dir(spark, "raw")
    # Written as ISO-8859-1, the two control characters become the bytes 80 and 96.
    rows = d.bronze_segment(spark, sf).withColumn("origin_city_name", F.concat(F.lit("São \x80\x96 "), "origin_city_name"))
    path = write_raw(rows.withColumnRenamed("_data_scope", "region"), f"{base}/latin", encoding="ISO-8859-1")
    return _landed(_read_folder(spark, path).withColumn("_data_scope", F.col("region")))


def expand_archives(spark: SparkSession, sf: str) -> DataFrame:
    """The rows packed into real archives, some with an inner directory for large files, and loaded as one batch each."""
    root, base = work_dir(spark, "warehouse"), work_dir(spark, "raw")
    rows = d.bronze_segment(spark, sf)
    keep_compiled(spark)
    places = {scope: files.resolved(spark, _made(spark, f"{base}/{scope}")) for scope in SCOPES}

    def pack(batches):
        while group := list(itertools.islice(batches, ARCHIVED_BATCHES)):
            table, names = pa.Table.from_batches(group), []
            for scope, place in places.items():
                part = table.filter(pc.equal(table["_data_scope"], scope)).drop_columns("_data_scope")
                store, folder = files.store_of(place)
                names.append(f"{folder}/{uuid.uuid4().hex}.zip")
                with store.open_output_stream(names[-1]) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr("Documentation.csv", "field,meaning\n" * 5)
                    with z.open("data.csv", "w", force_zip64=len(part) % 2 == 0) as member:
                        write_csv(part, member)
            yield pa.RecordBatch.from_pydict({"name": names})

    rows.mapInArrow(pack, "name string").count()
    for scope in SCOPES:
        ingest.load(spark, root, f"{scope}_segment", f"{base}/{scope}/*.zip", "append")
    return _landed(ingest.read_bronze(spark, root, "segment"))


def ragged_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Files with line breaks, quotes and commas inside quoted cells, read in splits."""
    base = work_dir(spark, "raw")
    broken = F.when(F.col("month") <= "6", F.concat(F.lit('Port\n"of", '), "origin_city_name")).otherwise(F.col("origin_city_name"))
    rows = d.bronze_segment(spark, sf).withColumn("origin_city_name", broken)
    path = write_raw(rows.withColumnRenamed("_data_scope", "region"), f"{base}/ragged")
    return _landed(_read_folder(spark, path).withColumn("_data_scope", F.col("region")))


def backfill(spark: SparkSession, sf: str) -> DataFrame:
    """Both scopes in one call, next to files of another table and a path that matches nothing: what the log says of each."""
    root, base = work_dir(spark, "warehouse"), work_dir(spark, "raw")
    raw = _raw_files(spark, sf)
    alien = write_raw(d.lookup_aircraft(spark, sf), f"{base}/alien")
    log = ingest.backfill(spark, root, {"domestic_segment": [raw["domestic"], alien, f"{base}/none*"], "international_segment": [raw["international"]]})
    return log.groupBy("data_scope", "status").agg(F.count(F.lit(1)).alias("batches"), F.sum("row_count").alias("rows"))


def _made(spark: SparkSession, path: str) -> str:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)
    return path


def _load_both(spark: SparkSession, sf: str, root: str, mode: str, times: int = 1) -> None:
    raw = _raw_files(spark, sf)
    for _ in range(times):
        for scope, path in raw.items():
            ingest.load(spark, root, f"{scope}_segment", path, mode)


def load_replace_years(spark: SparkSession, sf: str) -> DataFrame:
    """Both scopes loaded as one folder per year, twice: the second run replaces the first."""
    root, base = work_dir(spark, "warehouse"), work_dir(spark, "raw")
    raw = _by_scope(d.bronze_segment(spark, sf).withColumn("file_year", F.col("year")), base, "file_year")
    for _ in range(2):
        for scope, path in raw.items():
            ingest.load(spark, root, f"{scope}_segment", f"{path}/*=*", "replace-years")
    return _landed(ingest.read_bronze(spark, root, "segment"))


def load_append(spark: SparkSession, sf: str) -> DataFrame:
    """Both scopes appended twice: every row is there twice."""
    root = work_dir(spark, "warehouse")
    _load_both(spark, sf, root, "append", 2)
    return _landed(ingest.read_bronze(spark, root, "segment"))


def load_replace_scope(spark: SparkSession, sf: str) -> DataFrame:
    """After a full load, a scope re-loaded from a history that ends in 1998 has no later years left."""
    root, base = work_dir(spark, "warehouse"), work_dir(spark, "raw")
    raw = _by_scope(d.bronze_segment(spark, sf).withColumn("until_1998", F.col("year") <= "1998"), base, "until_1998")
    for scope, path in raw.items():
        ingest.load(spark, root, f"{scope}_segment", f"{path}/*=*", "replace-scope")
    ingest.load(spark, root, "domestic_segment", f"{raw['domestic']}/until_1998=true", "replace-scope")
    return _landed(ingest.read_bronze(spark, root, "segment"))


def batch_log(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per scope as the batch log counts them, next to the rows traced to those batches."""
    root = work_dir(spark, "warehouse")
    _load_both(spark, sf, root, "append")
    log = ingest.batch_log(spark, root)
    logged = log.groupBy("data_scope", "target_table", "status").agg(F.sum("row_count").alias("logged_rows"))
    traced = (
        ingest.with_lineage(ingest.read_bronze(spark, root, "segment"), log)
        .groupBy(F.col("_data_scope").alias("data_scope"), "target_table", "status")
        .agg(F.count(F.lit(1)).alias("traced_rows"))
    )
    return logged.join(traced, ["data_scope", "target_table", "status"], "full")


def period_range(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.period_range(d.bronze_segment(spark, sf), "_data_scope")


def landed(spark: SparkSession, sf: str) -> str:
    """Raw files of every kind landed in a new warehouse.

    The files of a table are made when its turn comes, compressed, and go when they are loaded: as text all of them together
    would take many times the room of the tables."""
    root, base = work_dir(spark, "warehouse"), work_dir(spark, "raw")
    with shuffles_freed(spark):
        rows = _written_aside(d.bronze_segment(spark, sf), f"{base}/rows")
        for table, cells in (("segment", rows), ("market", _demand(rows))):
            raw = _by_scope(cells, f"{base}/{table}", compression="snappy")
            if table == "market":
                drop_work(spark, f"{base}/rows")
            for scope, path in raw.items():
                ingest.load(spark, root, f"{scope}_{table}", path, "replace-scope")
                drop_work(spark, path)
        airports = write_raw(d.bronze_airports(spark, sf), f"{base}/airports", header=False)
        ingest.load(spark, root, "airports", airports, "replace-scope")
        for source, rows in (("l_aircraft_type", d.lookup_aircraft(spark, sf)), ("l_service_class", d.lookup_class(spark))):
            ingest.load(spark, root, source, write_raw(rows, f"{base}/{source}"))
    drop_work(spark, base)
    return root


def _written_aside(rows: DataFrame, path: str) -> DataFrame:
    """Rows that several files are made from, joined together once."""
    keep_compiled(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _demand(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c in (*MARKET_COLUMNS, "_data_scope")])


def _warehouse(spark: SparkSession, sf: str) -> str:
    """The whole warehouse rebuilt from landed files."""
    root = landed(spark, sf)
    refresh.refresh_all(spark, root, d.STAND_IN_FAMILIES)
    return root


def refresh_all(spark: SparkSession, sf: str) -> DataFrame:
    """Files -> bronze -> silver -> gold; returns the airport x family table read back."""
    return refresh.read_table(spark, _warehouse(spark, sf), "gold.airport_family_month")


def refresh_market(spark: SparkSession, sf: str) -> DataFrame:
    """The demand fact that the same refresh serves."""
    return refresh.read_table(spark, _warehouse(spark, sf), "silver.fact_market")


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What the refresh wrote down of all that the facts leave out."""
    return refresh.read_table(spark, _warehouse(spark, sf), "meta.rejected_rows")


RELOADED_YEAR = "1997"


def refresh_changed(spark: SparkSession, sf: str) -> DataFrame:
    """All ten tables after a year of one scope, cut to its first half, was loaded again and only that year rebuilt."""
    root, base = _warehouse(spark, sf), work_dir(spark, "raw")
    half = _raw_scope(spark, sf, "domestic").filter((F.col("year") == RELOADED_YEAR) & (F.length("month") == 1) & (F.col("month") <= "6"))
    with shuffles_freed(spark):
        half = _written_aside(half, f"{base}/rows")
        ingest.load(spark, root, "domestic_segment", write_raw(half, f"{base}/segment"))
        ingest.load(spark, root, "domestic_market", write_raw(_demand(half), f"{base}/market"))
    drop_work(spark, base)
    years = refresh.refresh_changed(spark, root)
    if years != {t: [int(RELOADED_YEAR)] for t in refresh.FACTS}:
        raise AssertionError(f"rebuilt {years}")
    return _summed({name: refresh.read_table(spark, root, name) for name in TABLES})


TABLES = (*refresh.BY_MONTH, "silver.dim_airport", "silver.dim_carrier_family", "meta.rejected_rows")


def _summed(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, months, passengers and seats of each table, as far as it has them."""
    none = F.lit(None).cast("long")
    frames = []
    for name, t in tables.items():
        total = lambda c, t=t: F.sum(c).cast("long") if c in t.columns else none
        months = F.count_distinct("flight_month") if "flight_month" in t.columns else none
        frames.append(t.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("rows"), months.alias("months"), total("passengers").alias("passengers"), total("seats").alias("seats")))
    return reduce(DataFrame.unionByName, frames)


def export_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """The rebuilt warehouse exported in sorted files: what SQL finds in the six views, and what the manifest says was written."""
    root, out = _warehouse(spark, sf), work_dir(spark, "export")
    refresh.export_sorted(spark, root, out)
    refresh.register_views(spark, out)
    found = " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS rows, count(DISTINCT {', '.join(keys)}) AS grains, min({keys[0]}) AS lowest, max({keys[0]}) AS highest FROM {name}"
        for name, keys in refresh.EXPORT_ORDER.items()
    )
    written = refresh.read_table(spark, out, "meta.export_manifest").groupBy("name")
    return refresh.q(spark, found).join(written.agg(F.sum("rows").alias("written")), "name")


def load_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A decode table loaded twice holds one load's rows."""
    root, base = work_dir(spark, "warehouse"), work_dir(spark, "raw")
    path = write_raw(d.lookup_aircraft(spark, sf).coalesce(1), f"{base}/types")
    for _ in range(2):
        ingest.load(spark, root, "l_aircraft_type", path)
    return ingest.read_bronze(spark, root, "l_aircraft_type").select("code", "description")

