"""The test tables in the shape of the datasets, as frames and as SQL.

Each view exists twice: a function (spark, sf_dir) -> DataFrame and a SQL text
over the registered tables. NAMED_SQL holds the texts; `with_views` puts the
ones a query needs in front of it.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

TIES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
# With these, rows that still tie are equal in all that a rolling average shows.
ALL_TIES = TIES + ["case_count", "death_count", "population"]

# Spellings given to the 25 nations and 25 brands, to have labels worth cleaning.
REGION_LABELS = [
    "London", "LONDON", "london", "south_east", "SE", "South West", "SW", "east_england",
    "EM", "East Midlands", "west_midlands", "WM", "yorkshire", "YH", "north_east", "NE",
    "NW", "North West", "wales", "Scotland", "scotland", "ni", "NI", "Manchester", "Leeds",
]
DISEASE_LABELS = [
    "covid", "COVID", "Covid19", "coronavirus", "SARS-CoV-2", "flu", "FLU", "rsv", "RSV",
    "tb", "TB", "hep_a", "Hep_B", "hep_c", "Measles", "Mumps", "Rubella", "Pertussis",
    "Influenza", "COVID-19", "Meningitis", "Other", "Zika", "Dengue", "Malaria",
]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def communicable(spark, sf):
    """One report per line item: date, region, disease, counts."""
    joined = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    return joined.select(
        *TIES, F.col("l_shipdate").cast("date").alias("report_date"),
        F.col("n_name").alias("region"), F.col("p_brand").alias("disease_name"),
        F.floor("l_quantity").cast("int").alias("case_count"),
        F.round(F.col("l_discount") * 100).cast("int").alias("death_count"),
        F.col("l_linenumber").alias("hospitalization_count"),
        F.floor("l_extendedprice").cast("bigint").alias("population"),
        F.col("p_size").alias("age"))


CD = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(l_shipdate AS DATE) AS report_date, n_name AS region, p_brand AS disease_name,
       CAST(FLOOR(l_quantity) AS INT) AS case_count,
       CAST(ROUND(l_discount * 100) AS INT) AS death_count,
       l_linenumber AS hospitalization_count,
       CAST(FLOOR(l_extendedprice) AS BIGINT) AS population, p_size AS age
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"""


def reports(spark, sf):
    """communicable with missing, negative and repeated rows."""
    cd = communicable(spark, sf)
    holes = cd.withColumns({
        "report_date": F.when(F.col("age") != 50, F.col("report_date")),
        "region": F.when(F.col("death_count") != 10, F.col("region")),
        "case_count": F.when(F.col("hospitalization_count") == 6, -F.col("case_count"))
                       .when(F.col("hospitalization_count") != 7, F.col("case_count")),
        "population": F.when(F.col("case_count") != 25, F.col("population")),
        "age": F.when(F.col("age") != 49, F.col("age")),
    })
    return holes.unionByName(holes.where(F.col("disease_name").isin("Brand#3", "Brand#4")))


REPORTS = """
SELECT * FROM reports_once
UNION ALL SELECT * FROM reports_once WHERE disease_name IN ('Brand#3', 'Brand#4')"""
REPORTS_ONCE = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN age <> 50 THEN report_date END AS report_date,
       CASE WHEN death_count <> 10 THEN region END AS region, disease_name,
       CASE WHEN hospitalization_count = 6 THEN -case_count
            WHEN hospitalization_count <> 7 THEN case_count END AS case_count,
       death_count, hospitalization_count,
       CASE WHEN case_count <> 25 THEN population END AS population,
       CASE WHEN age <> 49 THEN age END AS age
FROM cd"""


def _label(labels: list[str], index) -> F.Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), index)


def uploads(spark, sf):
    """reports as text, the way files bring them: mixed formats, labels and junk."""
    d = F.col("report_date")
    n = F.col("hospitalization_count")
    brand = F.substring("disease_name", 7, 2).cast("int")
    nation = F.substring("region", 8, 2).cast("int")
    return reports(spark, sf).select(
        *TIES,
        F.when(n == 2, F.date_format(d, "dd/MM/yyyy")).when(n == 3, F.date_format(d, "MM/dd/yyyy"))
         .when(n == 4, F.date_format(d, "dd-MM-yyyy")).when(n == 5, F.lit("no date"))
         .otherwise(F.date_format(d, "yyyy-MM-dd")).alias("report_date"),
        _label(REGION_LABELS, nation).alias("region"),
        _label(DISEASE_LABELS, brand - 1).alias("disease_name"),
        F.when(n == 1, F.concat(F.col("case_count").cast("string"), F.lit(".5")))
         .when(n == 2, F.lit("n/a")).otherwise(F.col("case_count").cast("string"))
         .alias("case_count"),
        F.col("death_count").cast("string").alias("death_count"),
        F.col("population").cast("string").alias("population"),
        F.when(n != 3, F.col("population") / 7).cast("string").alias("incidence_rate"))


def _sql_list(labels: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in labels) + "]"


UPLOADS = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE hospitalization_count WHEN 2 THEN strftime(report_date, '%d/%m/%Y')
            WHEN 3 THEN strftime(report_date, '%m/%d/%Y')
            WHEN 4 THEN strftime(report_date, '%d-%m-%Y') WHEN 5 THEN 'no date'
            ELSE strftime(report_date, '%Y-%m-%d') END AS report_date,
       {_sql_list(REGION_LABELS)}[CAST(substr(region, 8, 2) AS INT) + 1] AS region,
       {_sql_list(DISEASE_LABELS)}[CAST(substr(disease_name, 7, 2) AS INT)] AS disease_name,
       CASE hospitalization_count WHEN 1 THEN CAST(case_count AS VARCHAR) || '.5'
            WHEN 2 THEN 'n/a' ELSE CAST(case_count AS VARCHAR) END AS case_count,
       CAST(death_count AS VARCHAR) AS death_count, CAST(population AS VARCHAR) AS population,
       CASE WHEN hospitalization_count <> 3 THEN CAST(population / 7 AS VARCHAR) END
         AS incidence_rate
FROM reports"""


def doses(spark, sf):
    """One vaccination record per order; dose numbers go beyond the valid range."""
    joined = table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("vaccination_date"),
        F.col("c_mktsegment").alias("vaccine_type"),
        F.floor(F.col("o_totalprice") / 70000).cast("int").alias("dose_number"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("dose_count"),
        F.col("o_orderstatus").alias("age_group"))


DOSES = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS vaccination_date, c_mktsegment AS vaccine_type,
       CAST(FLOOR(o_totalprice / 70000) AS INT) AS dose_number,
       CAST(FLOOR(o_totalprice / 1000) AS INT) AS dose_count, o_orderstatus AS age_group
FROM orders JOIN customer ON o_custkey = c_custkey"""


def samples(spark, sf):
    """One laboratory sample batch per event; some batches are empty."""
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("date").alias("surveillance_date"),
        F.floor("value").cast("int").alias("sample_count"),
        F.get_json_object("props", "$.k").cast("int").alias("positive_count"))


SAMPLES = """
SELECT event_id, CAST(ts AS DATE) AS surveillance_date,
       CAST(FLOOR(value) AS INT) AS sample_count,
       CAST(json_extract_string(props, '$.k') AS INT) AS positive_count
FROM events"""


def people(spark, sf):
    """One person per customer with identifiers built from the key; some are missing."""
    key = F.col("c_custkey").cast("string")
    nine = F.lpad(key, 9, "0")
    n = F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("patient_id"),
        F.when(n != 3, F.col("c_name")).alias("patient_name"),
        F.col("c_mktsegment").alias("disease_name"),
        F.when(n == 1, F.lit("bad")).when(n != 2, F.concat(
            F.lit("SW"), n.cast("string"), F.lit("A 1AA"))).alias("postcode"),
        F.when(n != 4, F.concat(F.lit("07"), nine)).alias("phone"),
        F.concat(F.lit("ref "), F.lpad(key, 10, "0")).alias("note"),
        F.when(n == 5, F.concat(F.lit("AB"), F.lpad(key, 6, "0"), F.lit("C"))).alias("reference"),
        F.when(n == 6, F.lit("12-03-1980")).otherwise(F.lit("none")).alias("remark"),
        F.floor("c_acctbal").cast("int").alias("case_count"))


PEOPLE = """
SELECT c_custkey AS patient_id,
       CASE WHEN c_nationkey <> 3 THEN c_name END AS patient_name,
       c_mktsegment AS disease_name,
       CASE WHEN c_nationkey = 1 THEN 'bad'
            WHEN c_nationkey <> 2 THEN 'SW' || CAST(c_nationkey AS VARCHAR) || 'A 1AA' END AS postcode,
       CASE WHEN c_nationkey <> 4 THEN '07' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS phone,
       'ref ' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS note,
       CASE WHEN c_nationkey = 5 THEN 'AB' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || 'C' END
         AS reference,
       CASE WHEN c_nationkey = 6 THEN '12-03-1980' ELSE 'none' END AS remark,
       CAST(FLOOR(c_acctbal) AS INT) AS case_count
FROM customer"""


def files(spark, sf):
    """One uploaded-file record per document: a key with extension, a size, some tags."""
    lang = F.col("lang")
    folder = (F.when(lang == "de", "Immunisation").when(lang == "fr", "lab-results")
              .when(lang == "es", "available").otherwise("reports"))
    extension = (F.when(lang == "de", ".XML").when(lang == "fr", ".json")
                 .when(lang == "es", ".txt").otherwise(".csv"))
    source = F.col("source")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("uploads/"), folder, F.lit("/"), source, F.lit(" (v1)__"),
                 F.col("doc_id").cast("string"), extension).alias("path"),
        (F.col("n_chars") * 40000).alias("size"),
        F.when(source == "src1", F.lit("outbreak")).alias("dataset_type"),
        F.when(source != "src2", source).alias("source_organization"),
        "text")


FILES = """
SELECT doc_id,
       'uploads/' || CASE lang WHEN 'de' THEN 'Immunisation' WHEN 'fr' THEN 'lab-results'
                               WHEN 'es' THEN 'available' ELSE 'reports' END
         || '/' || source || ' (v1)__' || CAST(doc_id AS VARCHAR)
         || CASE lang WHEN 'de' THEN '.XML' WHEN 'fr' THEN '.json'
                      WHEN 'es' THEN '.txt' ELSE '.csv' END AS path,
       n_chars * 40000 AS size,
       CASE WHEN source = 'src1' THEN 'outbreak' END AS dataset_type,
       CASE WHEN source <> 'src2' THEN source END AS source_organization, text
FROM documents"""

NAMED_SQL = {
    "cd": (CD, []), "reports_once": (REPORTS_ONCE, ["cd"]),
    "reports": (REPORTS, ["cd", "reports_once"]),
    "uploads": (UPLOADS, ["cd", "reports_once", "reports"]),
    "doses": (DOSES, []), "samples": (SAMPLES, []), "people": (PEOPLE, []), "files": (FILES, []),
}


def with_views(sql: str, *names: str) -> str:
    """The query with the named views, and those they build on, as WITH clauses."""
    ordered = list(dict.fromkeys(x for n in names for x in [*NAMED_SQL[n][1], n]))
    parts = ",\n".join(f"{n} AS ({NAMED_SQL[n][0]})" for n in ordered)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"


def portable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates as text and doubles rounded, so that two engines print them alike."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("date", "timestamp", "timestamp_ntz"):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif kind == "double":
            out.append(F.round(f.name, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
