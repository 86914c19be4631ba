"""Raw readers, shaping, sinks and loads on small written files."""

import pytest
from conftest import SF, write_files
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.formats import raw_path
from tripledger.operators import shaping
from tripledger.operators.shaping import cell, named
from tripledger.plans import formatters
from tripledger.schemas import TABLES
from tripledger.session import setting
from tripledger.sources import files, loader, raw, sinks

OVO = "recon_ovo_report"


def firsts(rows, i=0):
    return [r[0] for r in rows.orderBy("file", "pos").select(cell(i)).collect()]


def test_order_survives_splits(spark, tmp_path):
    count = 20_000
    path = write_files(tmp_path, {"a.csv": "\n".join(["head", "H"] + [f"{i},x" for i in range(count)] + ["TOTAL,1", "9,junk"])})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        lines = raw.read_lines(spark, path)
        assert lines.rdd.getNumPartitions() > 4
        body = shaping.cut_total(shaping.drop_leading(raw.cells_of(lines), 2))
        assert firsts(body) == [str(i) for i in range(count)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_separator_per_file(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": "x;y;z\n1,5;2;3\n", "b.csv": "x,y\n1,2\n", "c.csv": "a;b,c,d\n"})
    lines = raw.read_lines(spark, path)
    seps = {r.file[-5:]: r.sep for r in raw.detect_first_line(lines).collect()}
    assert seps == {"a.csv": ";", "b.csv": ",", "c.csv": ","}
    rows = raw.read_detected(spark, path)
    assert [r.cells for r in rows.where(F.col("file").endswith("a.csv")).orderBy("pos").collect()] == [["x", "y", "z"], ["1,5", "2", "3"]]


def test_records_over_several_lines(spark, tmp_path):
    count = 3_000
    records = [f'{i};"a\nb;{i}\nc";z' if i % 7 == 0 else f"{i};plain;z" for i in range(count)]
    path = write_files(tmp_path, {"a.csv": "h;i;j\n" + "\n".join(records) + "\n", "b.csv": "h,i,j\n1,2,3\n"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = raw.read_detected(spark, path)
        got = rows.where(F.col("file").endswith("a.csv")).orderBy("pos").select("cells", "width").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.width for r in got] == [3] * (count + 1)
    assert got[0].cells == ["h", "i", "j"]
    want = [[str(i), f"a\nb;{i}\nc" if i % 7 == 0 else "plain", "z"] for i in range(count)]
    assert [r.cells for r in got[1:]] == want
    assert rows.where(F.col("file").endswith("b.csv")).count() == 2


def test_headers_may_differ_between_files(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": "A,B\n1,2\n", "b.csv": "B,C\n3,4\n"})
    rows = shaping.take_header(raw.read_cells(spark, path))
    got = rows.orderBy("file").select(named("A"), named("B"), named("C")).collect()
    assert [tuple(r) for r in got] == [("1", "2", ""), ("", "3", "4")]


def test_quoted_cells(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": 'h,i\n"a\nb","say ""x"", y"\nshort\n1,2,3\n'})
    rows = raw.read_cells(spark, path).orderBy("pos").collect()
    assert [r.cells for r in rows] == [["h", "i"], ["a\nb", 'say "x", y'], ["short"], ["1", "2", "3"]]
    assert [r.width for r in rows] == [2, 2, 1, 3]


def test_quotes_that_quote_nothing(spark, tmp_path):
    """A quote inside a cell is text, and one that never closes spoils its own cell only."""
    lines = ["h;i", "1;5\" pipe"] + [f"{i};x" for i in range(2, 1002)]
    late = ["a;b", '1;"x', 'y";2', '3;"open', "4;z", "5;w"]
    path = write_files(tmp_path, {"a.csv": "\n".join(lines) + "\n", "b.csv": "\n".join(late) + "\n"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("1k", before):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = raw.read_detected(spark, path)
            a = [r.cells for r in rows.where(F.col("file").endswith("a.csv")).orderBy("pos").collect()]
            b = [r.cells for r in rows.where(F.col("file").endswith("b.csv")).orderBy("pos").collect()]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert a == [["h", "i"], ["1", '5" pipe'], *([str(i), "x"] for i in range(2, 1002))]
        assert b == [["a", "b"], ["1", "x\ny", "2"], ["3", '"open'], ["4", "z"], ["5", "w"]]


def test_records_split_anywhere(spark, tmp_path):
    """Fixed separator, line breaks in cells, one file over many splits."""
    records = [f'{i},"a\n\n{i},""b""\n",z' if i % 3 == 0 else f'{i},"q, r",""' for i in range(2_000)]
    path = write_files(tmp_path, {"a.csv": "\n".join(records) + "\n\n"})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        got = [r.cells for r in raw.read_cells(spark, path).orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [[str(i), f'a\n\n{i},"b"\n', "z"] if i % 3 == 0 else [str(i), "q, r", ""] for i in range(2_000)]


def test_columns_at_any_place_and_unlisted_ones(spark, tmp_path):
    names = [f"x{i}" for i in range(60)] + ["Transaction Date", "Amount", "More", "More"]
    cells = [f"v{i}" for i in range(60)] + ["05-03-2024", "7", "first", "second"]
    path = write_files(tmp_path, {"a.csv": ";".join(names) + "\n" + ";".join(cells) + ";extra\n"})
    row = formatters.SOURCES["btn"].run(spark, path).first()
    assert row.amount == "7" and row.transaction_date
    assert len(row.unlisted) == 62 and row.unlisted["x59"] == "v59" and row.unlisted["more"] == "second" and row.unlisted["column 65"] == "extra"
    assert formatters.SOURCES["bank_bca"].run(spark, path).count() == 0


def test_strict_values():
    import re

    good = {"9:5": True, "23:59:59": True, "99:99:99": False, "24:00": False, "1:2:3.5": True, "12": False}
    assert {c: bool(re.match(loader.CLOCK, c)) for c in good} == good
    days = {"2024": False, "2024-01": False, "2024-1-2": True, "2024-01-02 3:04:05": True, "2024-01-02x": False}
    assert {d: bool(re.match(loader.DAY, d)) for d in days} == days


def test_statement_body(spark, tmp_path):
    head = "Saldo Awal,1\nTanggal Transaksi,Keterangan,Cabang,Jumlah,Saldo\n"
    body = '05/03/2024,"TRF, x",0001,"1,000.50 CR","2,000.00"\nonly,four,cells,here\n'
    path = write_files(tmp_path, {"a.csv": head + body + "Saldo Awal,,,,\n06/03/2024,no,1,1 CR,1\n", "b.csv": "no header\n1,2,3,4,5\n"})
    got = formatters.SOURCES["bank_bca"].run(spark, path).drop("file", "pos").collect()
    assert [tuple(r) for r in got] == [("2024-03-05", "TRF, x", "0001", "1000.50", "CR", "2000.00", None)]


def test_days_that_do_not_exist_are_flagged(spark, tmp_path):
    rows = "31/02/2024,x,1,1 CR,1\nPEND,x,1,1 CR,1\n01/02/2024,x,1,1 CR,1\n"
    path = write_files(tmp_path, {"a.csv": "Tanggal Transaksi,Keterangan,Cabang,Jumlah,Saldo\n" + rows})
    got = formatters.SOURCES["bank_bca"].run(spark, path).orderBy("pos").collect()
    assert [(r.Transaction_Date, r.rejected) for r in got] == [(None, "Transaction_Date"), ("PEND", None), ("2024-02-01", None)]


def test_numeric_run(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": "x\n\n1,a\n,b\n2c,c\nTotal,d\n3,e\n", "b.csv": "none\n"})
    rows = shaping.numeric_run(shaping.drop_empty(raw.naive_cells_of(raw.read_lines(spark, path))))
    assert firsts(rows, 1) == ["a", "b", "c"]


def test_trailing_empty_rows(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": "1;a\n;\n2;b\n;\n ; \n"})
    assert firsts(shaping.trim_trailing_empty(raw.read_cells(spark, path, ";"))) == ["1", "", "2"]


def test_formatted_file_loads(spark, tmp_path):
    raw_path = write_files(tmp_path / "raw", {"a.csv": "REFERENCE NO;PAYMENT DATE;BASE AMOUNT;NETT;STATUS\nR1;3/5/24 1:05 PM;10.5;9;\"a;b\"\n"})
    table = "recon_issuer_bca_bank_file_report"
    text = formatters.for_load(formatters.SOURCES["bca"].run(spark, raw_path), table)
    sinks.write_delimited(text, str(tmp_path / "norm"))
    row = loader.load_strict(spark, str(tmp_path / "norm"), table).first()
    assert (row.reference_no, str(row.payment_date), float(row.base_amount), row.status) == ("R1", "2024-03-05 13:05:00", 10.5, "a;b")


def test_aliases_reach_the_load(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": "A;B;C;D;E;F;G;H\n1,2;IDR;2024-03-05 10:00:00;r;;5;0;9\n"})
    text = formatters.for_load(formatters.SOURCES["bank_mandiri"].run(spark, path), "recon_mandiri_bank_file_report")
    assert text.first().postdate == "2024-03-05 10:00:00" and text.first().AccountNo == "12"


def ovo_file(*rows):
    return "h1;h2;h3;h4;h5;h6\n" + "".join(f"{r}\n" for r in rows)


GOOD = "1;2024-03-05 10:00:00;Sale;10.5;;ok"


def test_bad_rows(spark, tmp_path):
    bad = ["2;yesterday;Sale;1;1;ok", "3;2024-03-05 10:00:00;Sale;1,5;1;ok", "4;2024-03-05 10:00:00;Sale", GOOD + ";x"]
    path = write_files(tmp_path, {"a.csv": ovo_file(GOOD, *bad)})
    good, rest = loader.load_with_quarantine(spark, path, OVO)
    assert good.count() == 1 and good.first().nettsettlement is None
    assert sorted(r.fault for r in rest.collect()) == ["row width", "row width", "transactionamount", "transactiondate"]
    with pytest.raises(PySparkException, match="bad"):
        loader.load_strict(spark, path, OVO).collect()


def test_skip_rows_and_glob(spark, tmp_path):
    path = write_files(tmp_path, {"a.csv": "report\n\n" + ovo_file(GOOD), "b.csv": "report\n\n" + ovo_file(GOOD, GOOD), "sub/c.csv": ovo_file(GOOD)})
    table = loader.load_strict(spark, f"{path}/*.csv", OVO, header_rows=3, quoted_newlines=False)
    assert table.count() == 3


def test_load_over_many_splits(spark, tmp_path):
    rows = [f'{i};2024-01-02 03:04:05;"Sa\nle;";1;1;ok' for i in range(1500)]
    path = write_files(tmp_path, {"a.csv": ovo_file(*rows)})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        table = loader.load_strict(spark, path, OVO)
        assert table.where("transactionamount >= 1 AND transactiontype = 'Sa\nle;'").count() == 1500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_write_modes(spark, tmp_path):
    rows, path = spark.range(3).toDF("id"), str(tmp_path / "t")
    loader.write_table(rows, path, "empty")
    with pytest.raises(ValueError):
        loader.write_table(rows, path, "empty")
    loader.write_table(rows, path, "append")
    assert spark.read.parquet(path).count() == 6
    loader.write_table(rows, path)
    assert spark.read.parquet(path).count() == 3


def test_registry():
    assert len(TABLES) == 18
    widths = {n: len(t.columns) for n, t in TABLES.items()}
    assert widths["recon_linkaja_mcd_report"] == 11 and widths["recon_kredivo_report"] == 13
    landed = {t for s in formatters.SOURCES.values() for t in s.tables}
    assert set(TABLES) - landed == {"recon_mdr_master", "recon_ovo_report"}


def test_file_rules(spark, tmp_path):
    path = write_files(tmp_path, {n: "x\n" for n in ("BCA_BankFile 1.csv", "SingleTransactionInquiry_temp.csv", "SingleTransactionInquiry.csv", "~$x.csv")})
    listed = files.list_files(spark, path)

    def chosen(source):
        return sorted(r.name for r in files.select_files(listed, source).collect())

    assert [n.replace("%20", " ") for n in chosen("bank_bca")] == ["BCA_BankFile 1.csv"]
    assert chosen("bank_btn") == ["SingleTransactionInquiry.csv"]
    assert "~$x.csv" not in chosen("indodana") and len(chosen("indodana")) == 3


def test_date_range_labels(spark):
    rows = spark.createDataFrame([("a", "2024-01-02"), ("a", "2024-01-01"), ("b", "2024-01-01"), ("c", None)], "file string, d string")
    got = {r.file: r.label for r in files.date_ranges(rows, F.col("d").cast("date")).collect()}
    assert got == {"a": "2024-01-01_sampai_2024-01-02", "b": "2024-01-01", "c": "NA"}


# Packs ---------------------------------------------------------------------------------------------


def test_pack_reads_like_its_files(spark, tmp_path):
    """Same rows from a pack as from a folder of the files, whatever they hold; its own files do not grow in number with them."""
    odd = {"a.csv": 'h1;h2\n"x;\ny";1\n\n"q\t";2\n', "b.csv": "h1,h2\n1,2\n", "c.csv": "", "~$d.csv": "h1,h2\n3,4\n", "e_temp.csv": "h1,h2\n5,6\n"}
    odd |= {f"n{i}.csv": f'h1,h2\n{i},"two\n\nlines"\nopen,"{i}\n' for i in range(200)}
    folder, pack = write_files(tmp_path / "files", odd), str(tmp_path / f"all{raw.PACK}")
    # Two values per report: a value is one or several whole lines.
    rows = [(f, n, v) for name, text in odd.items() if text for lines in [text.removesuffix("\n").split("\n")]
            for f, n, v in [(f"in/{name}", 0, lines[0]), (f"in/{name}", 1, "\r\n".join(lines[1:]))]]
    raw.write_pack(spark.createDataFrame(rows, "file string, n long, value string"), pack, ["n"])
    assert len(list((tmp_path / f"all{raw.PACK}").glob("part-*"))) <= 8

    def found(path, read, **options):
        names = Window.partitionBy("file").orderBy("pos")
        table = read(spark, path, **options).withColumn("n", F.row_number().over(names))
        return sorted((r.file.rpartition("/")[2], r.n, r.cells) for r in table.collect())

    for read in (raw.read_cells, raw.read_detected, raw.read_unquoted_detected):
        for options in ({}, {"accept": files.not_left_over}, {"glob": "n1*.csv"}):
            assert found(pack, read, **options) == found(folder, read, **options)
    assert {r.file.partition("/")[0] for r in raw.read_lines(spark, pack).collect()} == {"in"}


def test_scratch_takes_little_disk(spark, tmp_path):
    """The name of a report before each of its lines is compressed away, and shuffle files go with the write that made them."""
    rows = spark.range(20000).selectExpr("concat('reports/of/the/day/', id % 3, '.csv') as file", "concat(id, ',\"a', char(10), 'b\"') as value", "id as n")
    pack, key = tmp_path / f"all{raw.PACK}", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = spark.conf.get(key), []
    real = type(rows.write).text
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(rows.write), "text", lambda self, *a, **b: (seen.append(spark.conf.get(key)), real(self, *a, **b))[1])
        raw.write_pack(rows, str(pack), ["n"])
    assert seen == ["true"] and spark.conf.get(key) == before
    lines = raw.read_lines(spark, str(pack))
    assert lines.count() == 40000
    assert sum(p.stat().st_size for p in pack.glob("part-*")) < lines.selectExpr("sum(length(file) + length(line) + 2)").first()[0] / 5
    # Lines are dealt to their runs as they were read.
    shuffled = plan_of(raw.placed(lines, ",")).split("Exchange")[1]
    assert "RLIKE" not in shuffled


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_settings_are_held_by_several_threads(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    first, second = setting(spark, key, "3"), setting(spark, key, "3")
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(key) == "3"
    second.__exit__(None, None, None)
    assert spark.conf.get(key) == before


def test_rendered_reports_are_few_files(spark):
    path = raw_path(spark, SF, "kredivo")
    assert raw.read_lines(spark, path).select("file").distinct().count() == 10
    assert len(spark.read.text(path).inputFiles()) < 10


def test_windows_hold_a_bounded_stretch_of_a_file(spark, tmp_path):
    """Cells that run over line ends, over the borders of runs too, in a file that is longer than a run and read by one task."""
    count, long = 3 << raw.RUN_BITS, 2 << raw.RUN_BITS
    body = [f'{i},"a\nb"' for i in range(count // 2)] + ['x,"' + "\n" * long + '"'] + [f"{i},plain" for i in range(9)] + ['y,"open', "z,1"]
    path = write_files(tmp_path, {"a.csv": "\n".join(body)})
    lines = raw.read_lines(spark, path)
    per_run = raw.placed(lines, ",").groupBy("file", "run").count()
    assert per_run.agg(F.max("count")).first()[0] <= 1 << raw.RUN_BITS and per_run.count() >= 5
    rows = raw.read_cells(spark, path).orderBy("pos").select("cells").collect()
    want = [[str(i), "a\nb"] for i in range(count // 2)] + [["x", "\n" * long]] + [[str(i), "plain"] for i in range(9)] + [["y", '"open'], ["z", "1"]]
    assert [r.cells for r in rows] == want


def test_records_are_put_together_inside_their_run(spark, tmp_path):
    """Only lines at the borders of runs are grouped by record after the runs; a file that never closes a cell keeps its lines."""
    count = (2 << raw.RUN_BITS) + 11
    long = "\n" * (raw.NEAR + 1)
    records = []
    for i in range(count):
        records += [f'{i},"a\n\nb, ""c"" {i}",z'] + ([f'{i},"{long}",z', f"{i},z"] if i % 999 == 0 else [])
    body = "".join(f"{r}\n" for r in records)
    path = write_files(tmp_path, {"a.csv": body, "b.csv": 'x,1\ny,"open\nz,2\n', "c.csv": "p\nq\n"})
    lines = raw.read_lines(spark, path)
    found = raw.within_runs(raw.placed(lines, ","))
    runs = found.select("file", "run").distinct().count()
    assert runs >= 7 and found.where("NOT whole").count() <= 8 * runs + (count // 999 + 1) * (raw.NEAR + 2)
    assert found.where("whole AND line LIKE '%z'").count() >= count - 2 * runs
    rows = raw.stitch_records(lines).orderBy("file", "pos").collect()
    assert [r.line for r in rows] == records + ["x,1", 'y,"open', "z,2", "p", "q"]
