"""Column expressions over names, keys and text."""

from pyspark.sql import Column, functions as F

from vigil.constants import DATASET_TYPES


def sanitize_key(name: Column) -> Column:
    """Characters outside A-Z a-z 0-9 - _ . become one underscore per run."""
    return F.regexp_replace(F.regexp_replace(name, r"[^a-zA-Z0-9\-_.]", "_"), "_+", "_")


def file_extension(path: Column) -> Column:
    """Lower-cased extension with its dot, '' when the last path part has none."""
    base = F.regexp_replace(path, r"^.*/", "")
    return F.lower(F.regexp_extract(base, r"^\.*[^.].*?(\.[^.]*)$", 1))


def outward_postcode(postcode: Column) -> Column:
    """Area and district of a postcode, '' when it does not start like one."""
    return F.regexp_extract(postcode, r"^([A-Z]{1,2}\d{1,2})", 1)


def dataset_type_of(path: Column, match: str = "token") -> Column:
    """Dataset type named by a path, communicable_disease by default.

    'token' matches whole words of the path, so that 'available' is not a
    laboratory file; 'substring' matches anywhere.
    """
    lowered = F.lower(path)
    default, named = DATASET_TYPES[0], DATASET_TYPES[1:]
    if match == "token":
        words = F.split(lowered, r"[^a-z]+")

        def names(word):
            return F.array_contains(words, word)
    elif match == "substring":
        def names(word):
            return lowered.contains(word)
    else:
        raise ValueError(f"match must be 'token' or 'substring', not {match!r}")
    result = None
    for dataset in named:
        hit = names(dataset)
        if dataset == "laboratory":
            hit = hit | names("lab")
        result = F.when(hit, dataset) if result is None else result.when(hit, dataset)
    return result.otherwise(F.lit(default))
