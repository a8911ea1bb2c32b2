import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigil.constants import REGIONS
from vigil.operators import aggregates, quality
from vigil.plans import jobs, scratch
from vigil.sources import files
from vigil.streaming import alarms, ingest

RUN = datetime(2025, 1, 31, 12)


def test_etl(spark, reports, tmp_path):
    raw = reports.unionByName(reports.limit(1)).withColumn("population", F.lit(1000)) \
        .withColumn("case_count", F.when(F.col("case_count") != 50, F.col("case_count"))) \
        .withColumnsRenamed({"report_date": "Report Date", "disease_name": "Disease-Name"})
    paths = jobs.etl_job(raw, "communicable_disease", str(tmp_path), RUN, "job", "system",
                         ["hospitalization_count"], table="etl_out")
    processed = spark.read.parquet(paths["processed"])
    assert processed.count() == 10
    assert {"seven_day_avg", "incidence_rate", "etl_job_name"} <= set(processed.columns)
    assert processed.where("case_count IS NULL").count() == 0
    stages = {r.stage: r.record_count for r in spark.read.json(paths["stages"]).collect()}
    assert stages == {"RAW_DATA": 11, "CLEANED_DATA": 10, "TRANSFORMED_DATA": 10}
    assert spark.read.json(paths["profile"]).where("column_name = 'region'").first().distinct_count == 4
    assert spark.read.json(paths["quality"]).where("check_name = 'duplicate_check'").first().passed
    assert spark.read.parquet(paths["regional"]).count() == 6
    assert spark.table("etl_out").count() == 10
    spark.sql("DROP TABLE etl_out")


def test_etl_reads_its_source_once(spark, reports, tmp_path):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    raw = reports.mapInArrow(counted, reports.schema)
    jobs.etl_job(raw, "communicable_disease", str(tmp_path), RUN, "job", "system", ["hospitalization_count"])
    assert read.value == reports.count()


def test_etl_error_is_recorded(spark, reports, tmp_path):
    with pytest.raises(Exception):
        jobs.etl_job(reports.drop("disease_name"), "communicable_disease", str(tmp_path), RUN,
                     "job", "system", ["hospitalization_count"])
    error = spark.read.json(f"{tmp_path}/errors/communicable_disease/20250131_120000_error").first()
    assert "disease_name" in error.error and "Traceback" in error.traceback


def test_etl_of_other_types(spark, tmp_path):
    df = spark.createDataFrame([("2025-01-01", "4", "1"), ("2025-01-02", "0", "x")],
                               "surveillance_date string, sample_count string, positive_count string")
    paths = jobs.etl_job(df, "surveillance", str(tmp_path), RUN, "job", "system", [])
    assert "weekly" not in paths
    got = spark.read.parquet(paths["processed"]).orderBy("surveillance_date").collect()
    assert [r.positivity_rate for r in got] == [25.0, 0.0]


def test_quality_report(spark, reports, tmp_path):
    path = jobs.quality_report_job(reports, "cases", str(tmp_path), RUN.date())
    jobs.quality_report_job(reports, "cases", str(tmp_path), RUN.date())
    assert spark.read.json(path).count() == quality.quality_job(reports).count()


def test_aggregation_jobs(spark, reports, tmp_path):
    paths = jobs.aggregation_job(reports, str(tmp_path / "a"))
    assert spark.read.parquet(paths["daily"]).count() == aggregates.daily(reports).count()
    assert spark.read.parquet(paths["weekly"]).count() == 6
    assert set(paths) == {"daily", "weekly", "monthly", "rankings"}
    paths = jobs.region_aggregation_job(reports, str(tmp_path / "b"))
    assert spark.read.parquet(paths["rankings"]).count() == 4
    assert "yoy_change" in spark.read.parquet(paths["monthly"]).columns


def write_uploads(folder):
    folder.mkdir()
    (folder / "good.csv").write_text("report_date,region,case_count\n2025-01-01,London,5\n2025-01-02,Wales,6\n")
    (folder / "review.csv").write_text("region,report_date,case_count\nLeeds,2025-01-01,5\n")
    (folder / "person.csv").write_text("report_date,region,case_count,remark\n2025-01-01,London,5,a@b.org\n")
    (folder / "lab").mkdir()
    (folder / "lab" / "more.json").write_text(json.dumps({"records": [
        {"report_date": "2025-01-01", "region": "London", "case_count": 1}]}))
    (folder / "more.xml").write_text("<s><record><report_date>2025-01-03</report_date>"
                                     "<region>Wales</region></record></s>")
    (folder / "notes.pdf").write_text("x")
    (folder / "sheet.xlsx").write_text("x")


RULES = [{"id": "s", "type": "schema", "required_columns": ["report_date", "region"]},
         {"id": "r", "type": "allowed_values", "column": "region", "allowed_values": REGIONS}]


def test_validation(spark, tmp_path):
    write_uploads(tmp_path / "in")
    strict = [{"id": "s", "type": "schema", "required_columns": ["sample_id"]}]
    log = jobs.validation_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), RUN,
                              {"communicable_disease": RULES, "laboratory": strict})
    got = {r.original_file.rsplit("/", 1)[1]: (r.status, r.route, r.record_count)
           for r in log.collect()}
    assert got == {
        "good.csv": ("PASSED", "validated", 2), "review.csv": ("WARNING", "review", 1),
        "person.csv": ("FAILED", "quarantine", 1), "more.json": ("FAILED", "quarantine", 1),
        "more.xml": ("PASSED", "validated", 1), "notes.pdf": ("FAILED", "quarantine", 0),
        "sheet.xlsx": ("FAILED", "quarantine", 0)}
    valid = spark.read.option("mergeSchema", "true").parquet(f"{tmp_path}/out/validated/communicable_disease")
    assert sorted(r.record_count for r in valid.collect()) == [1, 2, 2]
    rates = jobs.validation_rates(log).first()
    assert rates.files == 7 and rates.pii_detection_rate == pytest.approx(100 / 7)
    # The same run again replaces its output.
    jobs.validation_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), RUN,
                        {"communicable_disease": RULES, "laboratory": strict})
    again = files.scan_dataset(spark, f"{tmp_path}/out/validated", "communicable_disease")
    assert again.count() == 3 and set(again.columns) == {
        "report_date", "region", "case_count", "remark"}
    held = spark.read.option("mergeSchema", "true").parquet(f"{tmp_path}/out/held")
    assert {(r.dataset_type, r.route) for r in held.collect()} == {
        ("communicable_disease", "review"), ("communicable_disease", "quarantine"),
        ("laboratory", "quarantine")}
    quarantined = spark.read.parquet(f"{tmp_path}/out/quarantine")
    assert {r.quarantine_key.rsplit("/", 1)[1] for r in quarantined.collect()} == {
        "notes.pdf", "sheet.xlsx"}


def test_files_are_judged_by_their_own_columns(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "full.csv").write_text("report_date,region,case_count\n2025-01-01,London,5\n")
    (folder / "empty_column.csv").write_text("report_date,region,note\n2025-01-01,London,\n")
    (folder / "short.csv").write_text("report_date,case_count\n2025-01-01,5\n")
    (folder / "named.csv").write_text("report_date,region,patient_name\n2025-01-01,London,\n")
    (folder / "a.json").write_text('{"records": [{"report_date": "2025-01-01", "region": "Wales"}]}')
    (folder / "only a header (1).csv").write_text("report_date,region\n")
    (folder / "b.json").write_text('{"records": [{"report_date": "2025-01-01", "email": "x"}]}')
    quality = {"id": "q", "type": "quality", "checks": {"null_threshold": 0.1}}
    log = jobs.validation_job(spark, str(folder), str(tmp_path / "out"), RUN,
                              {"communicable_disease": RULES + [quality]})
    got = {r.original_file.rsplit("/", 1)[1]: (r.status, r.pii_findings, r.completeness)
           for r in log.collect()}
    assert got == {
        "full.csv": ("PASSED", 0, 1.0), "empty_column.csv": ("WARNING", 0, pytest.approx(2 / 3)),
        "short.csv": ("FAILED", 0, 1.0), "named.csv": ("FAILED", 1, pytest.approx(2 / 3)),
        "only a header (1).csv": ("WARNING", 0, None),
        "a.json": ("PASSED", 0, 1.0), "b.json": ("FAILED", 1, 1.0)}


def by_name(log):
    return {r.original_file.rsplit("/", 1)[1]: r for r in log.collect()}


def test_one_bad_file_spoils_no_other(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    good = '{"records": [{"report_date": "2025-01-01", "region": "Wales"}]}'
    (folder / "no_records.json").write_text('{"other": 1}')
    (folder / "none.json").write_text('{"records": []}')
    (folder / "cut.json").write_text('{"records": [{"report_date"')
    (folder / "good.json").write_text(good)
    (folder / "good.xml").write_text("<s><record><report_date>2025-01-03</report_date>"
                                     "<region>Wales</region></record></s>")
    (folder / "cut.xml").write_text("<s><record><report_date>2025-01-03</report_date></record><rec")
    (folder / "route.csv").write_text(
        "report_date,region,route,record_count,run\n2025-01-01,London,north,7,x\n")
    (folder / "good.csv").write_text("report_date,region\n2025-01-01,London\n")
    (folder / "bare.csv").write_text("")
    (folder / "_hidden.csv").write_text("report_date,region\n2025-01-01,London\n")
    (folder / ".dot.json").write_text(good)
    two = [{"id": f"q{f}", "type": "quality", "checks": {"outlier_columns": ["case_count"], "outlier_factor": f}}
           for f in (1.5, 3.0)]
    log = jobs.validation_job(spark, str(folder), str(tmp_path / "out"), RUN,
                              {"communicable_disease": RULES + two})
    got = by_name(log)
    assert {n: (r.status, r.route) for n, r in got.items()} == {
        "no_records.json": ("ERROR", "quarantine"), "none.json": ("WARNING", "review"),
        "cut.json": ("ERROR", "quarantine"), "good.json": ("PASSED", "validated"),
        "good.xml": ("PASSED", "validated"), "cut.xml": ("ERROR", "quarantine"),
        "route.csv": ("PASSED", "validated"), "good.csv": ("PASSED", "validated"),
        "bare.csv": ("WARNING", "review"), "_hidden.csv": ("FAILED", "quarantine"),
        ".dot.json": ("FAILED", "quarantine")}
    assert got["cut.json"].errors == ["Validation failed with error: not a JSON document"]
    assert got["good.csv"].size == 37 and got["good.csv"].source_organization == "unknown"
    valid = spark.read.option("mergeSchema", "true") \
        .parquet(f"{tmp_path}/out/validated/communicable_disease").collect()
    assert len(valid) == 4
    row = next(r for r in valid if r.source_route)
    assert (row.source_route, row.source_record_count, row.source_run, row.record_count) == (
        "north", "7", "x", 1)
    keys = {r.quarantine_key for r in spark.read.parquet(f"{tmp_path}/out/quarantine").collect()}
    assert keys == {"quarantine/2025/01/31/_hidden.csv", "quarantine/2025/01/31/.dot.json"}


def test_errors_and_details_are_logged(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "person.csv").write_text("report_date,region,remark\n2025-01-01,London,a@b.org\n")
    (folder / "short.csv").write_text("report_date,note\n2025-01-01,\n")
    quality = {"id": "q", "type": "quality", "checks": {"null_threshold": 0.1}}
    got = by_name(jobs.validation_job(spark, str(folder), str(tmp_path / "out"), RUN,
                                      {"communicable_disease": RULES + [quality]}))
    assert got["person.csv"].errors and "remark" in got["person.csv"].errors[0]
    assert got["short.csv"].errors and got["short.csv"].warnings
    assert got["short.csv"].details["q.note_null_ratio"] == 1.0


def test_nothing_is_left_in_scratch(spark, tmp_path):
    write_uploads(tmp_path / "in")
    root = scratch.scratch_root(spark).removeprefix("file:")
    import os

    before = set(os.listdir(root))
    jobs.validation_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), RUN, {})
    assert set(os.listdir(root)) <= before


def test_pages_give_the_same_result(spark, tmp_path, monkeypatch):
    write_uploads(tmp_path / "in")
    rules = {"communicable_disease": RULES}

    def run(name):
        log = jobs.validation_job(spark, str(tmp_path / "in"), str(tmp_path / name), RUN, rules)
        return sorted((r.original_file, r.status, r.route, r.record_count) for r in log.collect())

    whole = run("a")
    monkeypatch.setattr(files, "PAGE_FILES", 2)
    monkeypatch.setattr(files, "FEW_HEADERS", 1)
    assert run("b") == whole


def test_a_repeated_run_adds_no_rows_to_the_table(spark, reports):
    from vigil.sources import sinks

    days = [reports.withColumn("etl_date", F.lit(d).cast("date")) for d in ("2025-01-30", "2025-01-31")]
    spark.sql("DROP TABLE IF EXISTS etl_days")
    for df in (days[0], days[0], days[1], days[1]):
        sinks.write_table(df, "etl_days", append=True, day="etl_date")
    assert spark.table("etl_days").count() == 20
    spark.sql("DROP TABLE etl_days")


def test_etl_without_optional_measures(spark, reports, tmp_path):
    raw = reports.drop("death_count", "hospitalization_count").withColumn("nr", F.monotonically_increasing_id())
    paths = jobs.etl_job(raw, "communicable_disease", str(tmp_path), RUN, "job", "system", ["nr"])
    weekly = spark.read.parquet(paths["weekly"])
    assert "total_cases" in weekly.columns and "total_deaths" not in weekly.columns


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())
    assert scratch.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_ingest_raises_when_its_count_is_not_whole(spark, tmp_path, monkeypatch):
    import time

    from pyspark.sql.streaming.listener import StreamingQueryListener

    class Slow(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            time.sleep(3)

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            pass

    spark.range(5).write.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(ingest, "EVENT_SECONDS", 0.1, raising=False)
    slow = Slow()
    spark.streams.addListener(slow)
    try:
        with pytest.raises(TimeoutError, match="count is not known"):
            ingest.incremental_ingest(spark, f"{tmp_path}/in", "id long", f"{tmp_path}/out", f"{tmp_path}/state")
    finally:
        spark.streams.removeListener(slow)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_incremental_ingest(spark, reports, tmp_path):
    def run():
        return ingest.incremental_ingest(spark, f"{tmp_path}/in", reports.schema,
                                         f"{tmp_path}/out", f"{tmp_path}/state")

    reports.write.parquet(f"{tmp_path}/in")
    assert (run(), run()) == (10, 0)
    reports.limit(2).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == 2 and spark.read.parquet(f"{tmp_path}/out").count() == 12


def test_rows_are_counted_over_all_batches(spark, tmp_path):
    for i in range(110):
        spark.createDataFrame([(i,)], "n int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    got = ingest.incremental_ingest(spark, f"{tmp_path}/in", "n int", f"{tmp_path}/out",
                                    f"{tmp_path}/state", maxFilesPerTrigger="1")
    assert got == 110


def test_routing_stream(spark, tmp_path):
    write_uploads(tmp_path / "in")
    (tmp_path / "in" / "no_region.csv").write_text("report_date,n\n2025-01-01,5\n")
    rules = {"communicable_disease": RULES}

    def outcomes(frame):
        return {r.original_file: (r.status, r.route, r.record_count, r.errors) for r in frame.collect()}

    def run():
        ingest.validate_and_route(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", rules, RUN)
        return spark.read.json(f"{tmp_path}/out/logs")

    first = run()
    batch = jobs.validation_job(spark, str(tmp_path / "in"), str(tmp_path / "other"), RUN, rules)
    assert outcomes(first) == outcomes(batch)
    assert by_name(first)["no_region.csv"].status == "FAILED"
    (tmp_path / "in" / "late.csv").write_text("region,report_date\nWales,2025-01-01\n")
    later = run()
    assert later.count() == first.count() + 1 and by_name(later)["late.csv"].route == "validated"


def test_closed_windows(spark, tmp_path):
    events = spark.createDataFrame(
        [(datetime(2025, 1, 1, 0, m), 1) for m in (1, 2, 6, 7, 59)] + [(datetime(2025, 1, 1, 2), 1)],
        "ts timestamp, n int")
    events.write.parquet(f"{tmp_path}/in")
    stream = ingest.new_files(spark, f"{tmp_path}/in", events.schema)
    closed = alarms.closed_windows(stream, "ts", [], F.col("n"), f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted((r.window_start.minute, r.metric) for r in closed.collect()) == [
        (0, 2.0), (5, 2.0), (55, 1.0)]
