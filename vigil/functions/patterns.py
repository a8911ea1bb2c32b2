"""Personal-data patterns and column-name indicators (fixed values)."""

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Pattern:
    name: str
    regex: str
    severity: str = "medium"
    action: str = "redact"
    # A simple expression that every text with a match also matches: most texts
    # are passed over by it alone.
    needs: str | None = None
    # Fewest characters of a match: shorter texts are passed over without any expression.
    least: int = 0


DIGIT, AT = "[0-9]", "@"


def _with_needs(patterns: list[Pattern]) -> list[Pattern]:
    """The built-in patterns all hold an ASCII digit, except e-mail addresses, which hold an @."""
    return [replace(p, needs=AT if p.name == "email" else DIGIT) for p in patterns]


# The patterns of the file validator.
INLINE = _with_needs([
    Pattern("nhs_number", r"\b[0-9]{3}[\s-]?[0-9]{3}[\s-]?[0-9]{4}\b", least=10),
    Pattern("ni_number", r"\b[A-Z]{2}[0-9]{6}[A-Z]\b", least=9),
    Pattern("phone", r"\b(?:0[1-9]\d{8,9}|07\d{9}|\+44\s?7\d{3}\s?\d{6})\b", least=10),
    Pattern("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", least=6),
    Pattern("postcode", r"\b[A-Z]{1,2}[0-9]{1,2}[A-Z]?\s?[0-9][A-Z]{2}\b", least=5),
    Pattern("dob", r"\b(?:0[1-9]|[12][0-9]|3[01])[-/](?:0[1-9]|1[012])[-/](?:19|20)\d\d\b", least=10),
    Pattern("credit_card", r"\b(?:\d{4}[\s-]?){3}\d{4}\b", least=16),
])

# The patterns of the configuration, with severity and action.
UK_CONFIG = _with_needs([
    Pattern("nhs_number", r"\b[0-9]{3}[\s-]?[0-9]{3}[\s-]?[0-9]{4}\b", "high"),
    Pattern("ni_number",
            r"\b[A-CEGHJ-PR-TW-Z]{1}[A-CEGHJ-NPR-TW-Z]{1}[0-9]{6}[A-DFM]{0,1}\b", "high"),
    Pattern("uk_postcode", r"\b[A-Z]{1,2}[0-9]{1,2}[A-Z]?\s?[0-9][A-Z]{2}\b",
            "medium", "partial_redact"),
    Pattern("uk_phone", r"\b(?:0[1-9]\d{8,9}|\+44\s?[1-9]\d{8,9})\b"),
    Pattern("email", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"),
    Pattern("uk_passport", r"\b[0-9]{9}\b", "high"),
    Pattern("uk_driving_license", r"\b[A-Z]{2,5}[0-9]{6}[A-Z0-9]{3}[A-Z]{2}\b", "high"),
    Pattern("date_of_birth",
            r"\b(?:0[1-9]|[12][0-9]|3[01])[-/.](?:0[1-9]|1[012])[-/.](?:19|20)\d\d\b"),
    Pattern("bank_account", r"\b[0-9]{8}\b", "high"),
    Pattern("sort_code", r"\b[0-9]{2}[-\s]?[0-9]{2}[-\s]?[0-9]{2}\b", "high"),
])

# INLINE with a phone that may start with +44 and an e-mail domain without a bar.
_CORRECTED = {
    "phone": r"(?:\b0[1-9]\d{8,9}|\b07\d{9}|\+44\s?7\d{3}\s?\d{6})\b",
    "email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b",
}
UK_FIXED = [replace(p, regex=_CORRECTED.get(p.name, p.regex)) for p in INLINE]

# Fixed value: the managed scanner's identifier, without word boundaries or dashes.
NHS_LOOSE = _with_needs([Pattern("nhs_number", r"[0-9]{3}\s?[0-9]{3}\s?[0-9]{4}", "high")])

PATTERN_SETS = {"inline": INLINE, "uk_config": UK_CONFIG, "uk_fixed": UK_FIXED,
                "nhs_loose": NHS_LOOSE}

# A postcode with its outward part in group 1, for partial redaction.
POSTCODE_PARTS = r"\b([A-Z]{1,2}[0-9]{1,2}[A-Z]?)\s?[0-9][A-Z]{2}\b"

# Words in a column name that suggest personal data.
NAME_INDICATORS = [
    "name", "email", "phone", "address", "postcode", "dob",
    "birth", "ssn", "ni_number", "nhs", "passport", "license",
    "patient", "contact", "mobile", "telephone",
]
NAME_INDICATORS_CONFIG = [
    "name", "patient", "person", "individual", "contact", "email",
    "phone", "mobile", "address", "postcode", "dob", "birth",
    "ssn", "ni_number", "nhs", "passport", "license", "bank",
]
