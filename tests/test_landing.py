"""Loads that cannot lose data, file selection, quarantine and named sinks."""

import threading

import pytest
from conftest import write_files
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripledger.operators import shaping
from tripledger.operators.shaping import cell
from tripledger.plans import formatters
from tripledger.schemas import TABLES
from tripledger.sources import commits, files, loader, raw, sinks

OVO = "recon_ovo_report"
GOOD = "1;2024-03-05 10:00:00;Sale;10.5;;ok"


def ovo_file(*rows):
    return "h1;h2;h3;h4;h5;h6\n" + "".join(f"{r}\n" for r in rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def text_scans(df):
    return plan(df).count("FileScan text")


def test_a_refused_load_leaves_the_table(spark, tmp_path):
    target = str(tmp_path / "table")
    first = write_files(tmp_path / "a", {"a.csv": ovo_file(GOOD, GOOD)})
    loader.write_table(loader.load_strict(spark, first, OVO), target)
    second = write_files(tmp_path / "b", {"a.csv": ovo_file(GOOD, "2;2024-03-05 10:00:00;Sale")})
    for disposition in ("truncate", "append"):
        with pytest.raises(PySparkException, match="bad"):
            loader.write_table(loader.load_strict(spark, second, OVO), target, disposition)
        assert spark.read.parquet(target).count() == commits.landed(spark, target).count() == 2
    assert not [n for n in (tmp_path / "table").iterdir() if n.name.startswith("_staged")]


def test_one_refused_table_of_all(spark, tmp_path):
    tables = ["recon_ovo_report", "recon_mdr_master"]

    def project(rate):
        one = {f"{TABLES[OVO].folder}/a.csv": ovo_file(GOOD), f"{TABLES[tables[1]].folder}/a.csv": f"a;b;c;d\nOVO;x;{rate};2024-01-01\n"}
        return write_files(tmp_path / rate, one)

    warehouse = str(tmp_path / "warehouse")
    loader.load_all(spark, project("0.5"), warehouse, tables)
    with pytest.raises(PySparkException):
        loader.load_all(spark, project("much"), warehouse, tables)
    assert [commits.landed(spark, f"{warehouse}/{t}").count() for t in tables] == [1, 1]


def test_a_reader_keeps_the_table_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5, 7):
        began = commits.landed(spark, path) if n > 3 else None
        loader.write_table(spark.range(n).toDF("id"), path, keep_replaced=True)
        if began is not None:
            assert began.count() == n - 2  # the files of the commit before are still there
        assert commits.landed(spark, path).count() == n


def test_readers_never_see_an_empty_table(spark, tmp_path):
    path, seen, done = str(tmp_path / "t"), [], threading.Event()
    loader.write_table(spark.range(4).toDF("id"), path, keep_replaced=True)

    def look():
        while not done.is_set():
            seen.append(commits.landed(spark, path).count())

    reader = threading.Thread(target=look)
    reader.start()
    for _ in range(3):
        loader.write_table(spark.range(4).toDF("id"), path, keep_replaced=True)
    done.set()
    reader.join()
    assert seen and set(seen) == {4}


def test_two_writers(spark, tmp_path):
    """Both may find an empty table; one of them wins."""
    path, refused = str(tmp_path / "t"), []

    def write():
        try:
            loader.write_table(spark.range(2).toDF("id"), path, "empty")
        except ValueError:
            refused.append(1)

    writers = [threading.Thread(target=write) for _ in range(3)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(refused) == 2 and spark.read.parquet(path).count() == commits.landed(spark, path).count() == 2
    appenders = [threading.Thread(target=loader.write_table, args=(spark.range(2).toDF("id"), path, "append")) for _ in range(3)]
    for w in appenders:
        w.start()
    for w in appenders:
        w.join()
    assert spark.read.parquet(path).count() == commits.landed(spark, path).count() == 8


def test_partitioned_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(6).select("id", (F.col("id") % 3).alias("day"))
    loader.write_table(rows, path, partition_by=["day"])
    loader.write_table(rows, path, "append", partition_by=["day"])
    assert {tuple(r) for r in commits.landed(spark, path).groupBy("day").count().collect()} == {(0, 4), (1, 4), (2, 4)}
    loader.write_table(rows.where("day = 1"), path, partition_by=["day"])
    assert commits.landed(spark, path).count() == spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        loader.write_table(rows, path, "replace")


# Readers -----------------------------------------------------------------------------------------


def test_stray_quotes(spark, tmp_path):
    """A cell that begins with a quote but is text does not swallow the next record."""
    path = write_files(tmp_path, {"a.csv": 'h,i\n"abc"x,2\n"q""r",3\n"Toko" Jaya,"a\nb"\n"x"y,"z"\n"" ,5\n'})
    got = [r.cells for r in raw.read_cells(spark, path).orderBy("pos").collect()]
    assert got[:4] == [["h", "i"], ['"abc"x', "2"], ['q"r', "3"], ['"Toko" Jaya', "a\nb"]] and got[-1] == ["", "5"]


@pytest.mark.parametrize("size", ["1g", "4k"])
def test_broken_records_over_splits(spark, tmp_path, size):
    rows = [f'{i},"a\n""b"",\n{i}",z' if i % 5 else f'{i},"p"q,z' for i in range(1500)]
    path = write_files(tmp_path, {"a.csv": "\n".join(rows) + "\n", "b.csv": "1,2,3\n"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        got = {}
        for r in raw.read_cells(spark, path).orderBy("file", "pos").collect():
            got.setdefault(r.file[-5:], []).append(r.cells)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got["a.csv"] == [[str(i), f'a\n"b",\n{i}' if i % 5 else '"p"q', "z"] for i in range(1500)]
    assert got["b.csv"] == [["1", "2", "3"]]


def test_clean_files_are_scanned_plainly(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": 'a,"b, c",d\n1,2,3\n', "b.csv": "x,y,z\n"})
    rows = raw.read_cells(spark, path)
    assert text_scans(rows) == 1 and "Exchange" not in plan(rows)
    detected = raw.read_detected(spark, path)
    assert text_scans(detected) == 1 and "hashpartitioning" not in plan(detected)


@pytest.mark.parametrize("name", sorted(formatters.SOURCES))
def test_scans_per_source(spark, tmp_path, name):
    path = write_files(tmp_path, {"x.csv": "a,b;c\n1,2;3\n"})
    most = 4 if name in ("mandiri", "bank_btn") else 2
    assert text_scans(formatters.SOURCES[name].run(spark, path)) <= most


def test_strict_load_scans(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": ovo_file(GOOD)})
    assert text_scans(loader.load_strict(spark, path, OVO)) <= 2



def test_end_marks_before_the_start_do_not_count(spark, tmp_path):
    lines = ["Saldo Awal,1", "x,y", shaping.STATEMENT_HEADER, "a,b,c,d,e", "Mutasi Debet,1", "f,g,h,i,j", "Saldo Akhir,2"]
    path = write_files(tmp_path, {"a.csv": "\n".join(lines), "b.csv": "Saldo Awal,1\n", "c.csv": shaping.STATEMENT_HEADER + "\nq,r\n"})
    rows = shaping.between(raw.read_cells(spark, path), shaping.is_header(), shaping.is_footer())
    assert sorted(r[0] for r in rows.select(cell(0)).collect()) == ["a", "q"]


# Files -------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(formatters.SOURCES))
def test_left_overs_are_no_data(spark, tmp_path, name):
    content = "a;b,c\n1;2,3\n"
    path = write_files(tmp_path, {"x.csv": content, "~$x.csv": content, "x_temp.csv": content})
    read = formatters.SOURCES[name].read(spark, path, accept=files.not_left_over)
    assert {r.file.rpartition("/")[2] for r in read.select("file").collect()} == {"x.csv"}
    text = plan(read)
    assert text.count("FileScan text") >= 1


def test_run_folder_takes_the_source_s_own_files(spark, tmp_path):
    body = "1,05/03/2024,10:00:00,05/03/2024,10:00:00,d,0,5,5,r\n"
    names = ["SingleTransactionInquiry1.csv", "SingleTransactionInquiry_temp.csv", "~$SingleTransactionInquiry.csv", "Other.csv"]
    path = write_files(tmp_path, {n: body for n in names})
    got = formatters.SOURCES["bank_btn"].run_folder(spark, path)
    assert {r.file.rpartition("/")[2] for r in got.collect()} == {names[0]}
    # Files that are refused by name are not opened: the scan lists one file.
    scan = raw.read_lines(spark, path, accept=lambda c: files.accepted("bank_btn", c))
    scan.collect()
    assert scan.rdd.getNumPartitions() == 1 and set(files.FILE_RULES) >= set(formatters.SOURCES)


def test_named_sinks(spark, tmp_path):
    rows = spark.createDataFrame(
        [("f1", i, f"2024-01-{i:02d}", str(i)) for i in range(1, 9)] + [("f2", i, None, "x") for i in range(3)] + [("f3", 1, "2024-02-01", "y;z")],
        "file string, pos long, day string, v string",
    )
    ranges = files.date_ranges(rows, F.col("day").cast("date"))
    names = ranges.select("file", files.range_name("r_", F.col("first_day"), F.col("last_day")).alias("name"))
    out = str(tmp_path / "out")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "kept.csv").write_text("day;v\n")
    written = sinks.write_named(rows, names, out, parts=3)
    assert {n for n in written if n.count(".") == 1} == {"r_01012024-08012024.csv", "r_unknown.csv", "r_01022024.csv"}
    assert {p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")} == {*written, "kept.csv"}
    own = sorted((n for n in written if n.startswith("r_01012024")), key=lambda n: (n.count("."), n))
    cells = [line.split(";")[1] for n in own for line in (tmp_path / "out" / n).read_text().splitlines()[1:]]
    assert cells == [str(i) for i in range(1, 9)]
    assert sinks.write_named(rows, names, out, parts=3) == written
    assert (tmp_path / "out" / "r_01022024.csv").read_text() == 'day;v\n2024-02-01;"y;z"\n'


def test_names_by_days(spark):
    rows = spark.createDataFrame([("a", 2, "2024-01-02"), ("a", 1, "2024-01-05"), ("b", 1, None)], "file string, pos long, d string")
    first = files.first_row_days(rows, F.col("d").cast("date")).select("file", files.day_name("BNI_", F.col("first_row_day")))
    assert sorted(tuple(r) for r in first.collect()) == [("a", "BNI_2024-01-05.csv"), ("b", "BNI_0000-00-00.csv")]


# Quarantine ----------------------------------------------------------------------------------------


def test_days_that_do_not_exist_end_in_quarantine(spark, tmp_path):
    lines = ["a;b;c", shaping.STATEMENT_HEADER, '31/02/2024,TRF 1,0000,"1,000.00 CR","5.00"', '05/03/2024,TRF 2,0000,"2,000.00 CR","5.00"', "PEND,TRF 3,0000,1.00 CR,2"]
    path = write_files(tmp_path / "raw", {"x.csv": "\n".join(lines)})
    table = "recon_bca_bank_file_report"
    rows = formatters.for_load(formatters.SOURCES["bank_bca"].run(spark, path), table, with_rejected=True)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for _ in range(2):
        loader.land(rows, table, good, bad)
    landed = commits.landed(spark, good).collect()
    assert [r.description for r in landed] == ["TRF 2"] and str(landed[0].transaction_date) == "2024-03-05"
    assert sorted((r.description, r.fault) for r in commits.landed(spark, bad).collect()) == [("TRF 1", "Transaction_Date"), ("TRF 3", "transaction_date")]


def test_cells_are_judged_once(spark, tmp_path):
    """What lands is what was judged: the pattern of a day is matched once per cell."""
    path = write_files(tmp_path, {"a.csv": ovo_file(GOOD, "2;2024/3/5;Sale;1;1;ok")})
    rows = loader.load_strict(spark, path, OVO)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count(loader.DAY) == 1
    assert sorted(str(r.transactiondate) for r in rows.collect()) == ["2024-03-05 00:00:00", "2024-03-05 10:00:00"]


def test_quarantine_reads_once(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": ovo_file(GOOD, "2;yesterday;Sale;1;1;ok")})
    good, bad = loader.load_with_quarantine(spark, path, OVO)
    assert text_scans(good) == text_scans(bad) == 0 and (good.count(), bad.count()) == (1, 1)


def test_compressed_files_are_loaded_beside_plain_ones(spark, tmp_path):
    folder = f"{tmp_path}/in/{TABLES[OVO].folder}"
    rows = spark.createDataFrame([("1", "2024-01-01 00:00:00", "a;b", "1", "1", "ok")], ", ".join(f"{n} string" for n, _ in TABLES[OVO].columns))
    sinks.write_delimited(rows, folder, compression="gzip")
    sinks.write_delimited(rows, folder, mode="append")
    loader.load_all(spark, f"{tmp_path}/in", f"{tmp_path}/out", [OVO])
    assert [r.transactiontype for r in commits.landed(spark, f"{tmp_path}/out/{OVO}").collect()] == ["a;b", "a;b"]
