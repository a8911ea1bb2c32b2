import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def reports(spark):
    """The ten report rows most tests start from; the first two share a key."""
    rows = [
        ("2025-01-01", "London", "COVID-19", 100, 5, 20),
        ("2025-01-01", "London", "COVID-19", 150, 8, 30),
        ("2025-01-01", "Wales", "COVID-19", 200, 10, 40),
        ("2025-01-02", "Scotland", "COVID-19", 120, 6, 24),
        ("2025-01-02", "Northern Ireland", "COVID-19", 180, 9, 36),
        ("2025-01-03", "London", "Influenza", 50, 2, 10),
        ("2025-01-03", "Wales", "Influenza", 75, 3, 15),
        ("2025-01-04", "Scotland", "COVID-19", 220, 11, 44),
        ("2025-01-04", "London", "COVID-19", 190, 9, 38),
        ("2025-01-05", "Wales", "COVID-19", 160, 8, 32),
    ]
    names = ["report_date", "region", "disease_name", "case_count", "death_count",
             "hospitalization_count"]
    frame = spark.createDataFrame(rows, names)
    return frame.selectExpr(
        "to_date(report_date) AS report_date", "region", "disease_name",
        "int(case_count) AS case_count", "int(death_count) AS death_count",
        "int(hospitalization_count) AS hospitalization_count")
