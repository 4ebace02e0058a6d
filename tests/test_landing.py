import gzip
import pathlib
import zipfile

import pytest
from frames import rows
from pyspark.sql import functions as F

from skyledger.checks import landing
from skyledger.plans import refresh
from skyledger.session import shuffles_freed
from skyledger.sources import files, ingest
from skyledger.sources.schemas import SEGMENT_COLUMNS
from skyledger.sources.versions import Run

SF = "/root/testdata/sf0.001"


def written(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(["YEAR,MONTH,SEATS,ORIGIN", *lines]) + "\n")
    return str(path)


def test_landed_rows_are_not_sorted_by_group(spark):
    whole = spark.createDataFrame([], ", ".join(f"{c} string" for c in (*SEGMENT_COLUMNS, "_data_scope")))
    plan = landing._landed(whole)._jdf.queryExecution().toString()
    assert "ObjectHashAggregate" in plan
    assert "SortAggregate" not in plan


def test_partitions_are_written_without_a_shuffle(spark, tmp_path):
    df = spark.range(0, 8, 1, 4).select((F.col("id") % 2).alias("k"), "id")
    with Run(spark, str(tmp_path)) as run:
        entry = run.write_partitions(df, "bronze.t", ["k"])
        files = [f for (folder,) in entry["parts"].values() for f in pathlib.Path(tmp_path, folder).glob("*.parquet")]
        assert sorted(entry["parts"]) == ["k=0", "k=1"]
        assert len(files) == 8
        run.serve()


def test_a_load_goes_through_its_batches_once(spark, tmp_path, monkeypatch):
    class Counted(list):
        passes = 0

        def __iter__(self):
            Counted.passes += 1
            return super().__iter__()

    held, seen = ingest._held, []
    monkeypatch.setattr(ingest, "_held", lambda staged: Counted(held(staged)))
    for n in (2, 5):
        Counted.passes = 0
        paths = [written(tmp_path, f"{n}-{i}.csv", f"{1990 + i},1,{i},AAA") for i in range(n)]
        ids = ingest.load(spark, str(tmp_path / f"root{n}"), "domestic_segment", paths)
        log = ingest.batch_log(spark, str(tmp_path / f"root{n}"))
        assert rows(log, "batch_id", "row_count", "reporting_year") == [(b, 1, 1990 + i) for i, b in enumerate(ids)]
        seen.append(Counted.passes)
    assert seen[0] == seen[1]


@pytest.mark.parametrize("table", ["segment", "market"])
def test_test_tables_are_joined_once(spark, monkeypatch, table):
    made, bronze = [], landing.d.bronze_segment
    monkeypatch.setattr(landing.d, "bronze_segment", lambda *a: made.append(1) or bronze(*a))
    root = landing.landed(spark, SF)
    assert len(made) == 1
    assert ingest.read_bronze(spark, root, table).count() == bronze(spark, SF).count()


def test_ragged_rows_of_an_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.csv", 'Year,,Seats,Origin,More\n1999,x,"1,2","A ""B"""\n\n2000\n2001,x,,,"a\nb",y,z\n')
    root = str(tmp_path / "root")
    ingest.load(spark, root, "domestic_segment", str(tmp_path / "a.zip"))
    assert rows(ingest.read_bronze(spark, root, "segment"), "year", "seats", "origin") == [
        ("1999", "1,2", 'A "B"'), ("2000", None, None), ("2001", None, None),
    ]


@pytest.mark.parametrize(
    ("lines", "scans", "shape"),
    [
        ([b"1,a", b'2,"b"'], 1, {}),
        ([b"1,a", "2,Málaga".encode("cp1252")], 1, {"multiline": False, "encoding": "windows-1252"}),
        ([b'1,"a', "Málaga €".encode()], 1, {"multiline": True, "encoding": "UTF-8"}),
        (["1,á".encode(), "2,á".encode("cp1252")], 2, {"multiline": False, "encoding": "windows-1252"}),
        (["1,Á".encode(), "2,á".encode("cp1252")], 2, {"multiline": False, "encoding": "windows-1252", "problem": True}),
        ([b"1,\x81\xff"], 1, {"multiline": False, "encoding": "windows-1252", "problem": True}),
    ],
)
def test_lines_are_scanned_again_only_where_encodings_are_mixed(spark, tmp_path, monkeypatch, lines, scans, shape):
    path = tmp_path / "a.csv"
    path.write_bytes(b"\n".join([b"YEAR,ORIGIN_CITY_NAME", *lines]) + b"\n")
    read, of = [], files._lines
    monkeypatch.setattr(files, "_lines", lambda *a: read.append(1) or of(*a))
    (found,) = files._text_shapes(spark, [f"file://{path}"]).values() or [{}]
    assert {k: v if k != "problem" else bool(v) for k, v in found.items()} == shape
    assert len(read) == scans


def test_codes_need_no_formatter_in_every_row(spark):
    cells = landing.d.bronze_segment(spark, SF)
    assert "format_string" not in cells._jdf.queryExecution().optimizedPlan().toString()
    assert {len(r.origin) for r in cells.select("origin").distinct().collect()} == {3}


def test_ascii_cells_are_not_translated(spark):
    cells = spark.createDataFrame([("plain",), ("\x80 5",), ("São",), ("",), (None,)], "c string")
    decoded = files._from_1252(F.col("c"))
    assert [r[0] for r in cells.select(decoded).collect()] == ["plain", "€ 5", "São", "", None]
    assert "CASE WHEN" in str(decoded._jc.toString())


def test_compressed_files_are_loaded_like_plain_ones(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b'Year,Seats,Origin\n1999,"1,2",AAA\n2000,3,"B\nB"\n'))
    (tmp_path / "b.csv").write_text("Origin,Year\nCCC,2001\n")
    root = str(tmp_path / "root")
    ingest.load(spark, root, "domestic_segment", [str(tmp_path / "a.csv.gz"), str(tmp_path / "b.csv")])
    assert rows(ingest.read_bronze(spark, root, "segment"), "year", "seats", "origin", "_source_file") == [
        ("1999", "1,2", "AAA", "a.csv.gz"), ("2000", "3", "B\nB", "a.csv.gz"), ("2001", None, "CCC", "b.csv"),
    ]


def test_raw_files_of_a_table_go_before_the_next_are_made(spark, monkeypatch):
    seen, load = [], ingest.load

    def looked_at(spark, root, source, path, *mode):
        base = pathlib.Path(path.split("/raw-")[0], "raw-" + path.split("/raw-")[1].split("/")[0])
        left = {"/".join(f.relative_to(base).parts[:-1]) for f in base.rglob("part-*")}
        seen.append((source, sorted(left)))
        return load(spark, root, source, path, *mode)

    monkeypatch.setattr(ingest, "load", looked_at)
    landing.landed(spark, SF)
    both = [f"scope={s}" for s in landing.SCOPES]
    assert seen[:4] == [
        ("domestic_segment", ["rows", *(f"segment/{s}" for s in both)]), ("international_segment", ["rows", f"segment/{both[1]}"]),
        ("domestic_market", [f"market/{s}" for s in both]), ("international_market", [f"market/{both[1]}"]),
    ]


def _shuffles(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def test_shuffle_files_go_with_their_statement(spark, tmp_path):
    counted = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    before = _shuffles(spark)
    with shuffles_freed(spark):
        counted.write.parquet(str(tmp_path / "a"))
        assert _shuffles(spark) <= before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_refresh_leaves_no_shuffle_files_and_groups_slice_by_slice(spark, monkeypatch):
    root, of = landing.landed(spark, SF), ingest.read_sliced
    kept, seen = {}, []
    monkeypatch.setattr(refresh, "read_sliced", lambda *a: seen.append(of(*a)) or seen[-1])
    for limit in (ingest.SLICE_BYTES, 0):
        monkeypatch.setattr(ingest, "SLICE_BYTES", limit)
        before = _shuffles(spark)
        refresh.refresh_all(spark, root, landing.d.STAND_IN_FAMILIES)
        assert _shuffles(spark) <= before
        for name in refresh.BY_MONTH:
            table = refresh.read_table(spark, root, name)
            found = rows(table.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)")).alias("h")), "n", "h")
            assert kept.setdefault(name, found) == found
            assert found[0][0] > 0
    assert [len(slices) for _, slices in seen[:2]] == [1, 1]
    assert all(len(slices) == len(ingest.current(spark, root)[f"bronze.{t}"]["parts"]) > 2 for t, (_, slices) in zip(refresh.FACTS, seen[2:]))
