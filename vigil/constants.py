"""Lists, limits and lookups that results depend on."""

# --- Fixed values: region names -------------------------------------------------
REGIONS = [
    "London", "South East", "South West", "East of England",
    "East Midlands", "West Midlands", "Yorkshire and the Humber",
    "North East", "North West", "Wales", "Scotland", "Northern Ireland",
]

# Lower-cased region spellings and the name they stand for.
REGION_VARIANTS = {
    "london": "London",
    "south_east": "South East",
    "south_west": "South West",
    "east_england": "East of England",
    "east_midlands": "East Midlands",
    "west_midlands": "West Midlands",
    "yorkshire": "Yorkshire and the Humber",
    "north_east": "North East",
    "north_west": "North West",
    "wales": "Wales",
    "scotland": "Scotland",
    "northern_ireland": "Northern Ireland",
    "ni": "Northern Ireland",
}

# Exact-case region aliases of the mapping configuration.
REGION_ALIASES = {
    "london": "London",
    "LONDON": "London",
    "south_east": "South East",
    "SE": "South East",
    "south_west": "South West",
    "SW": "South West",
    "east_of_england": "East of England",
    "east_midlands": "East Midlands",
    "EM": "East Midlands",
    "west_midlands": "West Midlands",
    "WM": "West Midlands",
    "yorkshire_humber": "Yorkshire and the Humber",
    "YH": "Yorkshire and the Humber",
    "north_east": "North East",
    "NE": "North East",
    "north_west": "North West",
    "NW": "North West",
    "wales": "Wales",
    "scotland": "Scotland",
    "northern_ireland": "Northern Ireland",
    "NI": "Northern Ireland",
}

# Disease aliases of the mapping configuration.
DISEASE_ALIASES = {
    "covid": "COVID-19",
    "covid19": "COVID-19",
    "coronavirus": "COVID-19",
    "sars-cov-2": "COVID-19",
    "flu": "Influenza",
    "rsv": "RSV",
    "tb": "Tuberculosis",
    "hep_a": "Hepatitis A",
    "hep_b": "Hepatitis B",
    "hep_c": "Hepatitis C",
}

# Date column names and the aliases accepted for each.
DATE_FIELD_ALIASES = {
    "report_date": ["date", "report_dt", "reporting_date", "date_reported"],
    "vaccination_date": ["vacc_date", "vaccine_date", "immunisation_date"],
    "surveillance_date": ["surv_date", "surveillance_dt", "monitoring_date"],
}

# Allowed diseases and vaccines.
DISEASES = [
    "COVID-19", "Influenza", "RSV", "Measles", "Mumps",
    "Rubella", "Pertussis", "Tuberculosis", "Hepatitis A",
    "Hepatitis B", "Hepatitis C", "Meningitis", "Other",
]
VACCINES = [
    "COVID-19_Pfizer", "COVID-19_AstraZeneca", "COVID-19_Moderna",
    "Influenza", "MMR", "HPV", "Pneumococcal", "Meningococcal",
    "Hepatitis_B", "Other",
]

# Dataset types and the column types enforced for each.
DATASET_TYPES = [
    "communicable_disease", "immunisation", "surveillance", "laboratory", "outbreak",
]
DATASET_COLUMN_TYPES = {
    "communicable_disease": {
        "report_date": "date",
        "case_count": "integer",
        "death_count": "integer",
        "population": "long",
        "incidence_rate": "double",
    },
    "immunisation": {
        "vaccination_date": "date",
        "dose_number": "integer",
        "age": "integer",
        "coverage_percentage": "double",
    },
    "surveillance": {
        "surveillance_date": "date",
        "sample_count": "integer",
        "positive_count": "integer",
        "positivity_rate": "double",
    },
}

# Date formats, tried in this order.
DATE_FORMATS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy"]

# Admission limits.
MAX_FILE_BYTES = 100 * 1024 * 1024
FILE_EXTENSIONS = [".csv", ".xls", ".xlsx", ".xml", ".json"]

# Thresholds of the quality checks (fractions of rows).
NULL_LIMIT = 0.1
DUPLICATE_LIMIT = 0.05
OUTLIER_LIMIT = 0.02
COMPLETENESS_LIMIT = 0.95
VALIDITY_LIMIT = 0.99
UNIQUENESS_LIMIT = 0.95
TIMELINESS_HOURS = 24

# Retention policies, (days kept, action).
RETENTION = {
    "raw": (90, "delete"),
    "processed": (365, "archive"),
    "aggregated": (2555, "archive"),
    "pii": (90, "anonymize_then_archive"),
}

# Metadata fields every table must carry.
LINEAGE_FIELDS = [
    "source_system", "creation_date", "last_modified",
    "data_owner", "retention_period", "classification_level",
]

# Status names, most severe first.
STATUSES = ["ERROR", "FAILED", "WARNING", "PASSED"]

REDACTED = "***REDACTED***"
UNKNOWN = "Unknown"
DATA_VERSION = "1.0"
