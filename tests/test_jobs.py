from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillmark import cli, schemas, session
from tillmark.plans.daily import DailyRun, ingest_transactions, run_daily
from tillmark.plans.dashboard import dashboard
from tillmark.plans.snapshot import snapshot
from tillmark.plans.warehouse import load_warehouse
from tillmark.sources.layers import read_layer, read_quarantine, read_valid_transactions

COUNTRIES = "CountryID,CountryName\n1101,United Kingdom\n5501,USA\n"
PRODUCTS = "StockCode,ProductDescription,UnitPrice,Date\n" + "".join(
    f"{code},{name},{price},2024-02-0{day}\n"
    for day in (1, 2)
    for code, name, price in [("A", "CAKE", "1.50"), ("B", "STAR", "2.25")]
)


def lines(first, day, n):
    return "".join(
        f"{first + i},{'AB'[i % 2]},{5000 if i == 7 else 1 + i % 3},0{day}/02/2024 10:0{i % 10},17850,"
        f"{'9999' if i % 12 == 0 else '1101'}-1\n"
        for i in range(n)
    )


@pytest.fixture
def run(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "countries.csv").write_text(COUNTRIES)
    (tmp_path / "products.csv").write_text(PRODUCTS)
    (tmp_path / "raw" / "1.txt").write_text(lines(100, 1, 24))
    return DailyRun(
        str(tmp_path / "raw"), str(tmp_path / "countries.csv"), str(tmp_path / "products.csv"), str(tmp_path / "lake")
    )


def test_two_days(spark, run, tmp_path):
    assert run_daily(spark, run) == {
        "countries": 2, "products": 4, "ingest_batches": 1, "ingest_valid": 22, "ingest_quarantine": 2,
        "dim_date": 1, "dim_customers": 1, "dim_products": 2, "dim_geography": 2, "fct_sales": 22,
        "outliers": 1, "invalid_countries": 0,
    }
    lines_written = [row.value for row in spark.read.text(f"{run.reports}/outliers.txt").collect()]
    assert lines_written == ["User: 17850, Invoice: 107, Product: B, Quantity: 5000, Median: 2"]
    assert spark.read.option("header", True).csv(f"{run.reports}/invalid_country.csv").isEmpty()
    assert [row.row_count for row in read_layer(spark, "digest", run.reports).collect()] == [1, 0]

    # The ingest that runs between daily runs.
    (tmp_path / "raw" / "2.txt").write_text(lines(200, 2, 12))
    assert ingest_transactions(spark, run) == {
        "ingest_batches": 1, "ingest_valid": 11, "ingest_quarantine": 1,
    }

    metrics = run_daily(spark, run)
    assert (metrics["ingest_batches"], metrics["dim_date"], metrics["fct_sales"]) == (0, 2, 33)
    assert read_layer(spark, "fct_sales", run.gold).agg(F.count_distinct("sale_id")).first()[0] == 33
    assert read_quarantine(spark, run.transactions).count() == 3

    # A country that is taken back later shows up in the report.
    (tmp_path / "countries.csv").write_text("CountryID,CountryName\n5501,USA\n")
    metrics = run_daily(spark, run)
    assert (metrics["invalid_countries"], metrics["fct_sales"]) == (33, 33)
    assert spark.read.option("header", True).csv(f"{run.reports}/invalid_country.csv").count() == 33


def test_other_gold_sink(spark, run):
    written = {}

    def write(df, name):
        df.write.format("noop").mode("overwrite").save()
        written[name] = df.columns

    metrics = run_daily(spark, run, lambda tables: load_warehouse(tables, write))
    assert list(written) == ["dim_date", "dim_customers", "dim_products", "dim_geography", "fct_sales"]
    assert metrics["fct_sales"] == 22


def test_dashboard(spark, run):
    run_daily(spark, run)
    tables = dashboard(spark, run.gold)
    assert [tuple(row) for row in tables["sales_by_country"].collect()] == [("United Kingdom", Decimal("11332.50"))]
    totals = {name: df.agg(F.sum("total_sales")).first()[0] for name, df in tables.items()}
    assert len(set(totals.values())) == 1 and len(totals) == 4


def test_a_first_run_without_files(spark, run, tmp_path):
    (tmp_path / "raw" / "1.txt").unlink()
    metrics = run_daily(spark, run)
    assert {metrics[name] for name in ("fct_sales", "dim_date", "dim_customers", "outliers", "invalid_countries")} == {0}
    assert read_layer(spark, "fct_sales", run.gold).count() == 0
    assert [row.message for row in read_layer(spark, "digest", run.reports).collect()] == [
        "No high-value order anomalies detected.", "No invalid CountryID transactions detected."
    ]
    (tmp_path / "raw" / "2.txt").write_text(lines(200, 2, 12))
    assert run_daily(spark, run)["fct_sales"] == 11


def test_the_dashboard_prints_and_stores_every_row(spark, run, tmp_path, capsys):
    codes = [f"11{n:02d}" for n in range(30)]
    (tmp_path / "countries.csv").write_text("CountryID,CountryName\n" + "".join(f"{c},country {c}\n" for c in codes))
    days = [f"{1 + n % 28:02d}/{2 + n // 28:02d}/2024" for n in range(40)]
    prices = "".join(f"A,CAKE,1.50,2024-{day[3:5]}-{day[:2]}\n" for day in days)
    (tmp_path / "products.csv").write_text(PRODUCTS.splitlines()[0] + "\n" + prices)
    sold = "".join(f"{n},A,1,{day} 10:00,17850,{codes[n % 30]}-1\n" for n, day in enumerate(days))
    (tmp_path / "raw" / "1.txt").write_text(sold)
    run_daily(spark, run)
    counts = command("dashboard", "--lake", run.lake)
    assert (counts["sales_by_day"], counts["sales_by_country"]) == (40, 30)
    printed = capsys.readouterr().out.splitlines()
    countries = [line.split(" | ")[0] for line in printed if line.startswith("country 11")]
    assert countries == [f"country {code}" for code in codes]
    assert sum(line.startswith("2024-") for line in printed) == 40
    assert read_layer(spark, "sales_by_country", f"{run.lake}/dashboard").count() == 30


@pytest.mark.parametrize(
    "options",
    [
        [],
        ["--topic", "t"],
        ["--servers", "s:1"],
        ["--archive", "a", "--incremental", "--stream"],
        ["--servers", "s:1", "--topic", "t", "--incremental"],
        ["--archive", "a", "--every", "1 second"],
    ],
)
def test_trends_need_a_source(options):
    with pytest.raises(SystemExit):
        command("trends", "--lake", "unused", *options)


def command(*words):
    return cli.main([str(word) for word in words])


def test_commands(spark, run, tmp_path, capsys):
    lake = ["--lake", run.lake]
    raw = ["--raw-countries", run.raw_countries, "--raw-products", run.raw_products]
    assert command("dimensions", *lake, *raw) == {"countries": 2, "products": 4}
    assert command("ingest", *lake, "--raw-transactions", run.raw_transactions)["ingest_valid"] == 22
    assert command("warehouse", *lake) == {
        "dim_date": 1, "dim_customers": 1, "dim_products": 2, "dim_geography": 2, "fct_sales": 22,
        "outliers": 1, "invalid_countries": 0,
    }
    again = command("daily", *lake, *raw, "--raw-transactions", run.raw_transactions)
    assert (again["ingest_batches"], again["fct_sales"]) == (0, 22)
    command("dashboard", *lake)
    assert "United Kingdom" in capsys.readouterr().out

    message_rows = [(None, text.encode(), "t", 0, i, None, 0) for i, text in enumerate(["a cake", "cake", "mug cosy"])]
    spark.createDataFrame(message_rows, schemas.MESSAGES).write.parquet(str(tmp_path / "messages"))
    for mode in ([], ["--stream"]):
        assert command("trends", *lake, "--archive", tmp_path / "messages", *mode) == {"trending_products": 2}
    for new in (3, 0):
        counts = command("trends", *lake, "--archive", tmp_path / "messages", "--incremental")
        assert counts == {"new_messages": new, "trending_products": 2}
    running = ("--stream", "--every", "1 second", "--stop-seconds", "0")
    assert command("trends", *lake, "--archive", tmp_path / "messages", *running) == {"trending_products": 2}
    assert command("dashboard", *lake)["trending_products"] == 2
    trending = read_layer(spark, "trending_products", run.gold).collect()
    assert [row["count"] for row in trending] == [2, 1]

    counts = command("snapshot", *lake, "--destination", tmp_path / "backups")
    assert counts == {"countries": 2, "products": 4, "transactions": 22, "quarantine": 2}


def test_a_whole_snapshot_has_what_other_jobs_wrote(spark, run, tmp_path):
    run_daily(spark, run)
    trend = spark.createDataFrame([("cake", 3)], "product string, count long")
    trend.write.parquet(f"{run.gold}/trending_products")
    counts = command("snapshot", "--lake", run.lake, "--destination", tmp_path / "backups", "--whole")
    assert {f"gold/{n}" for n in ("dim_date", "dim_customers", "dim_products", "dim_geography", "fct_sales")} < set(counts)
    assert {f"reports/{n}" for n in ("outliers", "invalid_countries", "digest", "outliers.txt", "invalid_country.csv")} < set(counts)
    assert (counts["gold/trending_products"], counts["gold/fct_sales"], counts["transactions"]) == (1, 22, 22)
    assert not any(name.startswith("dashboard") for name in counts)


def test_snapshot(spark, run, tmp_path):
    run_daily(spark, run)
    tables = {
        "transactions": read_valid_transactions(spark, run.transactions),
        "countries": read_layer(spark, "countries", run.lake),
        "empty": read_layer(spark, "countries", run.lake).limit(0),
    }
    manifest = snapshot(spark, tables, str(tmp_path / "backups"), "2024-02-01-020000")
    assert {row.table_name: row.row_count for row in manifest.collect()} == {
        "transactions": 22, "countries": 2, "empty": 0,
    }
    copy = read_layer(spark, "transactions", str(tmp_path / "backups" / "2024-02-01-020000"))
    assert sorted(map(tuple, copy.collect())) == sorted(map(tuple, tables["transactions"].collect()))
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        snapshot(spark, tables, str(tmp_path / "backups"), "2024-02-01-020000")


class NamedFolder:
    """A session that names, or does not name, a shared folder."""

    class sparkContext:
        master = "spark://cluster"

    def __init__(self, folder):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}


def test_shared_folder():
    assert session.shared_folder(NamedFolder("hdfs://lake/checkpoints/")) == "hdfs://lake/checkpoints"
    first, second = (session.scratch_path(NamedFolder("hdfs://lake"), "x") for _ in range(2))
    assert first != second and first.startswith("hdfs://lake/")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(NamedFolder(None))
