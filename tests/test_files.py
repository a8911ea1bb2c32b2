import hashlib
import json
from datetime import date

import pytest
from pyspark.sql import functions as F, types as T

from vigil.sources import files, sinks


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_csv_encodings_headers_and_odd_names(spark, tmp_path):
    (tmp_path / "a b (1)+%41.csv").write_bytes("x,y\n1,café\n2,b\n".encode())
    (tmp_path / "b.CSV").write_bytes("y,x\nété,3\n".encode("latin-1"))
    (tmp_path / "c[1].csv").write_bytes("y,x\nnaïve,4\n".encode())
    (tmp_path / "notes.txt").write_text("x,y\n9,9\n")
    df = files.scan_csv(spark, str(tmp_path), source=True)
    assert rows(df, "x", "y") == [("1", "café"), ("2", "b"), ("3", "été"), ("4", "naïve")]
    names = {r.original_file.rsplit("/", 1)[1] for r in df.collect()}
    assert names == {"a b (1)+%41.csv", "b.CSV", "c[1].csv"}


def test_csv_types_and_missing_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("x\n5\n")
    df = files.scan_csv(spark, str(tmp_path), infer_types=True)
    assert dict(df.dtypes) == {"x": "int", "y": "int"}
    assert rows(df.fillna(0), "x", "y") == [(1, 2), (5, 0)]


@pytest.mark.parametrize("page_files, few_headers", [(5_000, 8), (5_000, 1), (1, 8), (1, 1)])
def test_csv_types_do_not_depend_on_pages(spark, tmp_path, monkeypatch, page_files, few_headers):
    """Types come from all files: of one header in several pages, and of several headers."""
    (tmp_path / "a.csv").write_text("x,y,day,note,none\n1,2,2024-01-01,5,\n")
    (tmp_path / "b.csv").write_text("x,y,day,note,none\n3000000000,2.5,2024-01-02,abc,\n")
    (tmp_path / "c.csv").write_text("y,x,flag\n4,5,true\n")
    (tmp_path / "d.csv").write_bytes("y,x,note\n,6,é \n".encode("latin-1"))
    monkeypatch.setattr(files, "PAGE_FILES", page_files)
    monkeypatch.setattr(files, "FEW_HEADERS", few_headers)
    df = files.scan_csv(spark, str(tmp_path), infer_types=True, source=True)
    assert {c: t for c, t in df.dtypes if c not in ("original_file", "file_columns")} == {
        "x": "bigint", "y": "double", "day": "date", "note": "string", "none": "string", "flag": "boolean"}
    assert sorted(tuple(r) for r in df.select("x", "y", "day", "note", "flag").collect()) == [
        (1, 2.0, date(2024, 1, 1), "5", None), (5, 4.0, None, None, True), (6, None, None, "é ", None),
        (3000000000, 2.5, date(2024, 1, 2), "abc", None)]


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n')
    df = files.scan_csv(spark, str(tmp_path), multi_line=True)
    assert rows(df, "x", "y") == [("1", "two\nlines")]


def test_no_csv(spark, tmp_path):
    with pytest.raises(ValueError, match="no CSV"):
        files.scan_csv(spark, str(tmp_path))


XML = """<?xml version="1.0" encoding="UTF-8"?>
<surveillance_data><metadata><source>x</source></metadata><records>
<record><region>London</region><case_count>100</case_count></record>
<record><region>Wales</region></record></records></surveillance_data>"""


def test_xml(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    (tmp_path / "b.XML").write_text(
        "<surveillance><record><region>Scotland</region><case_count>7</case_count></record></surveillance>")
    df = files.scan_xml(spark, str(tmp_path))
    assert df.dtypes == [("case_count", "string"), ("region", "string")]
    assert {tuple(r) for r in df.collect()} == {("100", "London"), (None, "Wales"), ("7", "Scotland")}


PLAIN = "\n".join(f"  <record><a>{i if i % 5 else 'x'}</a>\n<b> é &lt;{i}</b></record>" for i in range(400)) + \
    "<record></record><record><c>1</c><a/></record>"


@pytest.mark.parametrize("name,content,plain", [
    ("plain", f"<?xml version='1.0'?>\n<records>\n{PLAIN}\n</records>\n", True),
    ("comment", f"<records><!-- <record><a>1</a></record> -->{PLAIN}</records>", False),
    ("cdata", f"<records>{PLAIN}<record><b><![CDATA[</record>]]></b></record></records>", False),
    ("attribute", f"<records>{PLAIN}<record n='1'><a>3</a></record ></records>", False),
    ("nested", "<records><record><a>3</a><record><a>4</a></record></record></records>", False),
    ("cut", "<records><record><a>3</a></record><record><a>4</a>", False),
    ("closed", "<records><record/><record><a>3</a></record></records>", False),
    ("none", "<records></records>", True)])
def test_xml_is_split_at_the_ends_of_plain_records(spark, tmp_path, monkeypatch, name, content, plain):
    (tmp_path / f"{name}.xml").write_text(content, encoding="utf-8")
    (tmp_path / "other.XML").write_text("<records><record><a>5</a></record></records>")
    schema = T.StructType.fromDDL("a int NOT NULL, b string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(files, "WHOLE_BYTES", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = files.scan_xml(spark, str(tmp_path), schema=schema, source=True)
        parts = got.withColumn("p", F.spark_partition_id())
        tasks = parts.where(F.col("original_file").endswith(f"{name}.xml")).select("p").distinct().count()
        found = sorted(map(repr, got.collect()))
        monkeypatch.setattr(files, "_plain_xml", lambda *_: False)
        whole = files.scan_xml(spark, str(tmp_path), schema=schema, source=True)
        assert found == sorted(map(repr, whole.collect())) and got.schema == whole.schema
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 3 if name == "plain" else tasks <= 1


def test_xml_after_a_malformed_record_is_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "WHOLE_BYTES", 0)
    (tmp_path / "a.xml").write_text(
        "<records><record><a>1</a></record><record><a>2</a><b></record><record><a>3</a></record></records>")
    df = files.scan_xml(spark, str(tmp_path), schema=T.StructType.fromDDL("a int, b string"))
    assert df.count() == 3 and {1, 3} <= {r.a for r in df.collect()}


def test_line_files(spark, tmp_path):
    df = spark.createDataFrame([(3, "c", "x"), (1, "é", "x"), (2, None, "x"), (4, "d", "y"), (5, "e", None)],
                               "n int, line string, folder string")
    sinks.write_line_files(df, str(tmp_path / "out"), "folder", "line", "n")
    found = {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("*.*")}
    assert found == {"folder=x": "é\n\nc\n", "folder=y": "d\n", "folder=__HIVE_DEFAULT_PARTITION__": "e\n"}
    sinks.write_line_files(df.limit(0), str(tmp_path / "none"), "folder", "line", "n")
    assert files.file_digests(spark, str(tmp_path / "none")).isEmpty()


def test_json(spark, tmp_path):
    document = {"metadata": {"source": "s"}, "records": [
        {"region": "London", "case_count": 1}, {"region": "Wales", "case_count": 2}]}
    (tmp_path / "a.json").write_text(json.dumps(document, indent=2))
    (tmp_path / "b.json").write_text(json.dumps({"records": document["records"][:1]}))
    df = files.scan_json(spark, str(tmp_path), source=True)
    assert rows(df, "region", "case_count") == [("London", 1), ("London", 1), ("Wales", 2)]
    assert {r.original_file.rsplit("/", 1)[1] for r in df.collect()} == {"a.json", "b.json"}


def test_parquet_merge(spark, tmp_path):
    spark.range(2).withColumn("a", F.lit(1)).write.parquet(f"{tmp_path}/outbreak/x")
    spark.range(2, 4).withColumn("b", F.lit(2)).write.parquet(f"{tmp_path}/outbreak/y")
    df = files.scan_parquet(spark, f"{tmp_path}/outbreak/*")
    assert set(df.columns) == {"id", "a", "b"} and df.count() == 4


def test_rules(spark, tmp_path):
    (tmp_path / "default.json").write_text(json.dumps({"rules": [
        {"id": "a", "type": "schema"}, {"id": "b", "type": "quality", "enabled": False}]}, indent=1))
    (tmp_path / "imm.json").write_text(json.dumps({"dataset_type": "immunisation", "rules": [
        {"id": "c", "type": "value_ranges", "ranges": {}}]}))
    load = lambda *a: {r["rule_id"] for r in files.load_rules(spark, str(tmp_path), *a)}
    assert load() == {"a", "c"}
    assert load("immunisation") == {"a", "c"}
    assert load("outbreak") == {"a"}
    assert load(None, "business_logic") == {"c"}


def test_unreadable_rules_raise(spark, tmp_path):
    with pytest.raises(Exception):
        files.load_rules(spark, str(tmp_path / "absent"))
    (tmp_path / "bad.json").write_text("{not json")
    with pytest.raises(ValueError):
        files.load_rules(spark, str(tmp_path))


def test_manifest_and_digests(spark, tmp_path):
    for name, content in [("a.csv", b"same"), ("sub/b.csv", b"same"), ("c.xml", b"other\xff")]:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    listed = files.file_manifest(spark, str(tmp_path)).collect()
    assert sorted(r.size for r in listed) == [4, 4, 6] and all(r.event_time for r in listed)
    digests = files.file_digests(spark, str(tmp_path))
    assert "content" not in digests.columns
    copies = files.duplicate_uploads(digests).collect()
    assert [(r.copies, r.first_path.rsplit("/", 1)[1]) for r in copies] == [(2, "a.csv")]
    assert copies[0].digest == "0967115f2813a3541eaef77de9d9d5773f1c0c04314b0bbfe4ff3b3b1c55b5d5"


def test_processed_partitions_are_replaced_one_by_one(spark, tmp_path):
    def write(day, n):
        df = spark.range(n).withColumn("etl_date", F.lit(day))
        return sinks.write_processed(df, str(tmp_path), "outbreak", day)

    write(date(2025, 1, 1), 3)
    write(date(2025, 1, 2), 5)
    path = write(date(2025, 1, 1), 2)
    assert path.endswith("processed/outbreak/year=2025/month=01")
    assert rows(spark.read.parquet(path).groupBy("etl_date").count(), "etl_date", "count") == [
        (date(2025, 1, 1), 2), (date(2025, 1, 2), 5)]


def test_table_append_matches_columns_by_name(spark, tmp_path):
    sinks.write_table(spark.range(2).selectExpr("id AS a", "'x' AS b"), "appended", str(tmp_path / "t"))
    sinks.write_table(spark.range(1).selectExpr("'y' AS b", "id AS a"), "appended", append=True)
    assert rows(files.scan_table(spark, "appended"), "a", "b") == [(0, "x"), (0, "y"), (1, "x")]
    spark.sql("DROP TABLE appended")


def _write(root, files_):
    for name, content in files_.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)


def test_manifest_of_deep_trees_and_odd_names(spark, tmp_path):
    _write(tmp_path, {"a b.csv": b"1", "x/y/z/deep.csv": b"22", "x/%20+é.json": b"333", "x/empty.csv": b"",
                      "_held/in.csv": b"4444", "x/.dot/in.csv": b"55555", "x/_part=1/in.csv": b"6", "x/_late.csv": b"7",
                      ".a b.csv.crc": b"sum"})
    (tmp_path / "nothing").mkdir()
    listed = files.file_manifest(spark, str(tmp_path))
    assert listed.columns == ["path", "size", "event_time"]
    base = f"file:{tmp_path}/"
    got = {r.path.removeprefix(base): (r.size, r.event_time.timestamp()) for r in listed.collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "a b.csv": 1, "x/y/z/deep.csv": 2, "x/%20+é.json": 3, "x/empty.csv": 0, "_held/in.csv": 4,
        "x/.dot/in.csv": 5, "x/_part=1/in.csv": 1, "x/_late.csv": 1}
    assert all(abs(t - (tmp_path / name).stat().st_mtime) < 0.002 for name, (_, t) in got.items())
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
    want = {r.path: (r.size, r.digest) for r in read.selectExpr(
        "path", "length AS size", "sha2(content, 256) AS digest").collect()}
    want[base + "x/empty.csv"] = (0, hashlib.sha256(b"").hexdigest())
    assert {r.path: (r.size, r.digest) for r in files.file_digests(spark, str(tmp_path)).collect()} == want


def test_manifest_of_patterns_single_files_and_nothing(spark, tmp_path):
    _write(tmp_path, {"a/1.csv": b"1", "b/2.csv": b"2", "c.csv": b"3"})
    paths = lambda p: sorted(r.path.rsplit("/", 1)[1] for r in files.file_manifest(spark, str(p)).collect())
    assert paths(tmp_path / "[ab]") == ["1.csv", "2.csv"]
    assert paths(tmp_path / "*") == ["1.csv", "2.csv", "c.csv"]
    assert paths(tmp_path / "c.csv") == ["c.csv"]
    assert paths(tmp_path / "absent*") == []
    assert files.file_digests(spark, str(tmp_path / "absent*")).count() == 0


def test_listing_on_the_driver_has_the_same_rows(spark, tmp_path, monkeypatch):
    _write(tmp_path, {"a.csv": b"1", "x/y/b.csv": b"22", "x/empty.csv": b"", "x/_late.csv": b"7", "z.csv.gz": b"not gzip"})
    def tables():
        return [sorted(map(tuple, f(spark, str(tmp_path)).collect())) for f in (files.file_manifest, files.file_digests)]
    by_tasks = tables()
    monkeypatch.setattr(files.handles, "SCHEMES", ("none",))
    assert tables() == by_tasks and len(by_tasks[1]) == 4


def test_digest_of_a_file_above_two_gigabytes(spark, tmp_path):
    size = (2 << 30) + 12_345
    with open(tmp_path / "large.csv", "wb") as f:
        f.truncate(size)
    want, zeros = hashlib.sha256(), bytes(1 << 20)
    for at in range(0, size, len(zeros)):
        want.update(zeros[:size - at])
    assert [(r.size, r.digest) for r in files.file_digests(spark, str(tmp_path)).collect()] == [(size, want.hexdigest())]


def test_gzipped_xml_is_read_on_request(spark, tmp_path):
    plain, packed = (spark.createDataFrame([(i, f"a{i} <&> é") for i in some], "n int, t string") for some in (range(3), range(3, 9)))
    for rows, folder, codec in ((plain, "a", "none"), (packed, "b", "gzip")):
        rows.coalesce(1).write.format("xml").options(rootTag="records", rowTag="record", compression=codec) \
            .save(f"{tmp_path}/{folder}")
    seen = [sorted((r.n, r.t) for r in files.scan_xml(
        spark, str(tmp_path), schema=plain.schema, gzipped=gzipped).collect()) for gzipped in (False, True)]
    assert seen == [[(i, f"a{i} <&> é") for i in range(n)] for n in (3, 9)]
    assert files.scan_xml(spark, str(tmp_path), source=True, gzipped=True) \
        .where("original_file LIKE '%.xml.gz'").count() == 6


def test_xml_of_the_query_takes_little_disk(spark, tmp_path, monkeypatch):
    from workload import connectors

    rows = spark.range(20_000).selectExpr(
        *(f"id * 7919 % 10007 AS {c}" for c in connectors.TIES), "date_add(DATE'2024-01-01', int(id % 365)) AS report_date",
        "concat('NATION_', id % 25) AS region", "concat('Brand#', id % 31) AS disease_name",
        "int(id * 31 % 50) AS case_count", "int(id % 11) AS death_count")
    monkeypatch.setattr(connectors, "communicable", lambda spark, sf: rows)
    monkeypatch.setattr(connectors, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    found = connectors.scan_xml(spark, "")
    assert found.exceptAll(rows).isEmpty() and rows.exceptAll(found).isEmpty()
    assert sum(f.stat().st_size for f in (tmp_path / "xml").rglob("*.xml*")) < 60 * 20_000
