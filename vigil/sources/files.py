"""Readers for uploaded files, tables, rules and file manifests."""

import itertools
import json
import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vigil.operators.rules import rules_from_document
from vigil.plans import scratch
from vigil.schemas import text_sql
from vigil.sources import handles

#: Files whose paths the driver holds at once, and headers it joins in one plan.
PAGE_FILES = 5_000
FEW_HEADERS = 8
#: Size up to which one task reads an XML file as a whole, which takes half the time.
WHOLE_BYTES = 256 << 20

SOURCE_COLUMNS = ["original_file", "validation_timestamp", "record_count", "run"]
CSV_FILES = "*.[cC][sS][vV]"


def file_path() -> Column:
    """Path of the row's file as storage names it (the metadata column is URL-encoded)."""
    encoded = F.col("_metadata.file_path")
    # Decoding is slow, and done for every row; most paths have nothing to decode.
    return F.when(encoded.contains("%"), F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))) \
        .otherwise(encoded)


def literal_path(path: str) -> str:
    """A path without glob meaning."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def with_file(df: DataFrame, wanted: bool = True) -> DataFrame:
    return df.withColumn("original_file", file_path()) if wanted else df


def with_columns_of_file(df: DataFrame) -> DataFrame:
    """Note the columns the row's files have, before other files add theirs."""
    return df.withColumn("file_columns", F.array(*[F.lit(c) for c in df.columns]))


# --- Parquet and tables -----------------------------------------------------------

def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All files of one dataset; their schemas are merged unless one is given."""
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    return reader.parquet(path)


def scan_dataset(spark: SparkSession, root: str, dataset_type: str,
                 schema: T.StructType | None = None, with_source: bool = False) -> DataFrame:
    """The validated rows of a dataset type, with or without the file they came from."""
    rows = scan_parquet(spark, f"{root}/{dataset_type.lower()}", schema)
    return rows if with_source else rows.drop(*SOURCE_COLUMNS)


def scan_table(spark: SparkSession, table: str, database: str | None = None) -> DataFrame:
    return spark.table(f"{database}.{table}" if database else table)


# --- text formats -----------------------------------------------------------------

def inspect_text(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header line and UTF-8 validity per file, from one scan."""
    lines = spark.read.option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", CSV_FILES).text(path)
    position = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    return lines.select(file_path().alias("file"), "value", position.alias("position")) \
        .groupBy("file").agg(
            F.min_by("value", "position").alias("header"),
            F.bool_and(F.expr("is_valid_utf8(value)")).alias("utf8"))


def scan_csv(spark: SparkSession, path: str | list[str], infer_types: bool = False,
             source: bool = False, multi_line: bool = False) -> DataFrame:
    """CSV files with headers; columns are matched by name across files.

    A file that is not valid UTF-8 is read as Latin-1. When headers or encodings
    differ, files are read together per header and encoding. A few of them make
    one plan; of many, page by page, the rows are added to one scratch table,
    whose columns are those of all files. With infer_types the types come from
    the values of all files, however many they are. The driver holds the paths
    of one page. multi_line allows line breaks in quotes, and then reads each
    file in one task.
    """
    inspected, copy = scratch.materialize(inspect_text(spark, path), "headers")

    def read(utf8: bool, files: str | list[str], typed: bool) -> DataFrame:
        reader = spark.read.options(
            header="true", inferSchema=str(typed), multiLine=str(multi_line),
            encoding="UTF-8" if utf8 else "ISO-8859-1",
            recursiveFileLookup="true", pathGlobFilter=CSV_FILES)
        rows = reader.csv(files)
        return with_columns_of_file(rows).transform(with_file) if source else rows

    try:
        kinds = inspected.groupBy("header", "utf8").agg(F.count(F.lit(1)).alias("files"))
        some = kinds.orderBy("header", "utf8").limit(FEW_HEADERS + 1).collect()
        if not some:
            raise ValueError(f"no CSV files under {path}")
        if len(some) == 1:
            return read(some[0].utf8, path, infer_types)
        listed = inspected.orderBy("header", "utf8", "file").toLocalIterator()
        pages = pages_of(listed, lambda f: (f.header, f.utf8))
        if len(some) <= FEW_HEADERS and sum(k.files for k in some) <= PAGE_FILES:
            frames = [read(utf8, [literal_path(f.file) for f in page], False)
                      for (_, utf8), page in pages]
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
            return with_inferred_types(rows, source) if infer_types else rows
        table = scratch.Appended(spark, "csv")
        for (_, utf8), page in pages:
            table.add(read(utf8, [literal_path(f.file) for f in page], False))
        return with_inferred_types(table.read(), source) if infer_types else table.read()
    finally:
        scratch.remove(spark, copy)


def with_inferred_types(rows: DataFrame, source: bool) -> DataFrame:
    """Text columns as the CSV reader types them over all their values."""
    spark = rows.sparkSession
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c, t in rows.dtypes
              if t == "string" and not (source and c == "original_file")}
    if not quoted:
        return rows
    as_is = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    lines = rows.select(F.to_csv(F.struct(*quoted.values()), as_is).alias("value"))
    encoder = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    inferred = spark.read.option("inferSchema", "true")._jreader.csv(getattr(lines._jdf, "as")(encoder))
    kinds = DataFrame(inferred, spark).schema.fields  # none without rows
    typed = {c: F.from_csv(quoted[c], f"v {f.dataType.simpleString()}")["v"].alias(c)
             for c, f in zip(quoted, kinds) if f.dataType != T.StringType()}
    return rows.select(*(typed.get(c, quoted.get(c, c)) for c in rows.columns))


def pages_of(items, key, size: int | None = None) -> Iterator[tuple]:
    """(key, items) of runs of equal keys, in lists of at most `size` items."""
    for k, run in itertools.groupby(items, key):
        while page := list(itertools.islice(run, size or PAGE_FILES)):
            yield k, page


def scan_xml(spark: SparkSession, path: str | list[str], row_tag: str = "record",
             schema: T.StructType | None = None, source: bool = False, gzipped: bool = False) -> DataFrame:
    """One row per record element, one text column per child unless a schema says otherwise.

    Each file is read by one task, which leaves out what follows a malformed record. With
    a schema, if a file is larger than WHOLE_BYTES and all are of plain records (see
    _plain_xml), they are split among tasks at the records' ends, whatever their size;
    then a malformed record costs no other. gzipped: files compressed as .xml.gz are read
    too, unpacked as they are read; nothing splits such a file.
    """
    files = {"recursiveFileLookup": "true", "pathGlobFilter": "*.[xX][mM][lL]" + "{,.[gG][zZ]}" * gzipped}
    if schema and not spark.read.format("binaryFile").options(**files).load(path) \
            .where(F.col("length") > WHOLE_BYTES).select("length").isEmpty():
        pieces = with_file(spark.read.options(lineSep=f"</{row_tag}>", **files).text(path)) \
            .withColumn("__file", F.col("_metadata.file_path"))
        if _plain_xml(pieces, row_tag):
            begin = F.locate(f"<{row_tag}>", F.col("value"))
            record = F.concat(F.col("value").substr(begin, F.length("value")), F.lit(f"</{row_tag}>"))
            kept = ["original_file"] if source else []
            free = T.StructType([T.StructField(f.name, f.dataType) for f in schema])  # files promise no values
            rows = pieces.where(begin > 0).select(
                F.from_xml(record, free, {"rowTag": row_tag}).alias("__r"), *kept)
            return rows.select("__r.*", *kept)
    reader = spark.read.format("xml").options(rowTag=row_tag, **files)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "false")
    return with_file(reader.load(path), source)


def _plain_xml(pieces: DataFrame, row_tag: str) -> bool:
    """Whether texts between the records' end tags hold one record each, in every file.

    Comments, CDATA, attributes or spaces in the records' tags, records in records and
    files that end in one are other forms.
    """
    text, tag = F.col("value"), re.escape(row_tag)
    begins = F.locate(f"<{row_tag}>", text)
    # One search each shows most pieces to be plain; only the others meet the patterns.
    name = text_sql(f"<{row_tag}")
    plain = (begins > 0) & F.expr(f"locate({name}, value) = {{0}} AND locate({name}, value, {{0}} + 1) = 0".format(
        f"locate({text_sql(f'<{row_tag}>')}, value)")) & ~text.contains(f"</{row_tag}") & ~text.contains("<!")
    odd = text.rlike(rf"<!--|<!\[CDATA\[|</?{tag}[\s/]") | (F.regexp_count(text, F.lit(f"<{tag}>")) > 1)
    seen = pieces.groupBy("__file").agg(
        F.bool_or(F.when(plain, False).otherwise(odd)).alias("odd"), F.bool_or(begins == 0).alias("whole"))
    return seen.where("odd OR NOT whole").isEmpty()


def scan_json(spark: SparkSession, path: str | list[str], record: T.StructType | None = None,
              source: bool = False, one_per_line: bool = False,
              as_text: bool = False) -> DataFrame:
    """The rows of {metadata, records: [...]} documents.

    as_text reads values as text, the way CSV and XML files bring them.

    A file is one document, parsed as a whole by one task (admission limits
    files to 100 MB), or has one document per line, which splits freely.
    """
    reader = spark.read.options(multiLine=str(not one_per_line), recursiveFileLookup="true",
                                primitivesAsString=str(as_text))
    if not one_per_line:
        reader = reader.option("pathGlobFilter", "*.[jJ][sS][oO][nN]")
    if record:
        reader = reader.schema(T.StructType([T.StructField("records", T.ArrayType(record))]))
    documents = with_file(reader.json(path), source)
    kept = ["original_file"] if source else []
    return documents.select(*kept, F.explode("records").alias("__r")).select(*kept, "__r.*")


# --- rules and manifests ------------------------------------------------------------

def load_rules(spark: SparkSession, path: str, dataset_type: str | None = None,
               rule_type: str | None = None) -> list[dict]:
    """Enabled rules of the rule documents under path, for one dataset or rule type.

    Rules without a dataset type apply to all. A document that cannot be read
    raises, so that missing rules never let data pass.
    """
    documents = spark.read.text(path, wholetext=True).collect()  # configuration
    if not documents:
        raise ValueError(f"no rule documents under {path}")
    rules = [r for d in documents for r in rules_from_document(json.loads(d.value))]
    return [r for r in rules
            if dataset_type in (None, r.get("dataset_type", dataset_type))
            and rule_type in (None, r["rule_type"])]


def _below(system, path) -> Iterator:
    """Status of every file below a path, one after another on the driver."""
    found = system.listFiles(path, True)
    while found.hasNext():
        yield found.next()


def _named(spark: SparkSession, path: str) -> Iterator[tuple[str, int, int, bool, bool]]:
    """What a path or pattern names, as rows of handles.LISTED.

    In storage that tasks cannot open, files below take the place of folders.
    """
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for root in system.globStatus(pattern) or ():
        known = root.getPath().toString().split(":", 1)[0] in handles.SCHEMES
        if root.isDirectory() and known:
            yield root.getPath().toString(), 0, root.getModificationTime(), True, False
            continue
        for f in _below(system, root.getPath()):
            name = f.getPath().getName()
            yield f.getPath().toString(), f.getLen(), f.getModificationTime(), False, name[:1] in ("_", ".")


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """path, size, event_time and hidden of every file below path (or a pattern).

    Folders are listed by tasks, one level of the tree after another, into scratch:
    as many jobs as the tree is deep, and the driver holds what the pattern names.
    A folder is listed by one task.
    """
    named = scratch.Appended(spark, "manifest")
    named.add(spark.createDataFrame([], handles.LISTED))
    for _, page in pages_of(_named(spark, path), lambda f: None):
        named.add(spark.createDataFrame(page, handles.LISTED))
    level = named.read()
    found, task = level, handles.lister(to_arrow_schema(level.schema))
    while not (folders := level.where("folder")).isEmpty():
        # A number of tasks, so that folders with their few bytes are not dealt to one.
        dealt = folders.select("path", "hidden").repartition(4 * spark.sparkContext.defaultParallelism, "path")
        level, _ = scratch.materialize(dealt.mapInArrow(task, handles.LISTED), "manifest")
        found = found.unionByName(level)
    return found.where("NOT folder").drop("folder")


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """path, size and event_time of every file; contents are not read.

    Empty files and names that Spark's readers skip (they begin with _ or .)
    are listed too. Listed by tasks where they can open the storage.
    """
    return _listed(spark, path).drop("hidden").withColumn("event_time", F.timestamp_millis("event_time"))


def hidden_name(path: Column) -> Column:
    """Whether Spark's readers skip the file: its name begins with _ or a dot."""
    return path.rlike(r"(^|/)[_.][^/]*$")


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path, size and SHA-256 of the content of every file that readers see.

    Tasks read the files in small pieces, so files may be of any size. In storage
    that tasks cannot open, Spark's binary reader brings whole files (below 2 GB);
    it has no row for empty ones, which get the digest of no bytes.
    """
    seen = _listed(spark, path).where("NOT hidden")
    schema = T.StructType.fromDDL(handles.DIGESTS)
    by_task = F.substring_index("path", ":", 1).isin(*handles.SCHEMES)
    dealt = seen.where(by_task).select("path").repartition(4 * spark.sparkContext.defaultParallelism, "path")
    read = dealt.mapInArrow(handles.digester(to_arrow_schema(schema)), schema)
    others = seen.where(~by_task)
    if others.isEmpty():
        return read
    contents = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    cells = with_digest(contents.select("path", F.col("length").alias("size"), "content"), "content")
    empty = others.where("size = 0")
    return read.unionByName(cells.drop("content").join(others.select("path"), "path", "left_semi")).unionByName(
        empty.select("path", "size", F.sha2(F.lit("").cast("binary"), 256).alias("digest")))


# --- files that cannot be read -------------------------------------------------------

def broken_json(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, message) of files that are no JSON, or documents without records."""
    found = spark.read.schema("records string, __corrupt string").options(
        multiLine="true", columnNameOfCorruptRecord="__corrupt").json(paths)
    return found.select(
        file_path().alias("path"),
        F.when(F.col("__corrupt").isNotNull(), "not a JSON document")
        .when(F.col("records").isNull(), "no records in the document").alias("message"),
    ).where(F.col("message").isNotNull()).distinct()


def broken_xml(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, message) of files whose root element is missing or not closed."""
    text = F.regexp_replace("value", r"\s+", "")
    whole = spark.read.text(paths, wholetext=True).select(
        file_path().alias("path"), text.alias("text"),
        F.regexp_extract("value", r"<([A-Za-z_][^\s/>]*)", 1).alias("root"))
    closed = F.endswith("text", F.concat(F.lit("</"), "root", F.lit(">"))) | F.col("text").rlike(
        r"^[^<]*(<[?!][^>]*>)*<[A-Za-z_][^<>]*/>$")
    return whole.where((F.col("root") == "") | ~closed).select(
        "path", F.lit("not a whole XML document").alias("message"))


def with_digest(df: DataFrame, content: str) -> DataFrame:
    return df.withColumn("digest", F.sha2(F.col(content).cast("binary"), 256))


def duplicate_uploads(digests: DataFrame) -> DataFrame:
    """Contents that were uploaded more than once, with the number of copies."""
    return digests.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min("path").alias("first_path"),
    ).where(F.col("copies") > 1)
