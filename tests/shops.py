"""A file of market stalls: every kind of failure, alone and together. A stall may stand in several zones."""

from sluice import TableSpec

LINES = [
    "stall|label|zone|since",
    "40|Harbour Tea|north|2024-03-01",
    "41|Old Mill|north|2024-03-02",
    "41|Old Mill|south|2024-03-02",
    "42|Blue Door||2024-03-02",
    "-43|Kite|north|2024-03-05",
    " 44|Lantern|north|2024-03-05",
    "45|Owl|south|05.03.2024",
    "46|Quay|south|2024-03-06",
    "46|Quay|south|2024-03-06",
    "47|Reed|south|2024-03-06",
    "47|Reed & Son|south|2024-03-06",
    "4x|Sparrow|north|2024-03-07",
    "4x|Sparrow|north|2024-03-07",
    "4x|Finch|north|2024-3-7",
    "|Tern|north|",
    "||20240308|x",
    "48|7|east|",
]
CLEAN_IDS = [40, 41, 41, 46, 48]
BAD = [
    ("42", "Blue Door", ("_is_zone_null",)),
    ("-43", "Kite", ("_is_stall_invalid",)),
    (" 44", "Lantern", ("_is_stall_invalid",)),
    ("45", "Owl", ("_is_since_invalid",)),
    ("46", "Quay", ("_row_duplicate",)),
    ("47", "Reed", ("_key_duplicate",)),
    ("47", "Reed & Son", ("_key_duplicate",)),
    ("4x", "Sparrow", ("_is_stall_invalid", "_key_duplicate")),
    ("4x", "Sparrow", ("_is_stall_invalid", "_row_duplicate")),
    ("4x", "Finch", ("_is_since_invalid", "_is_stall_invalid", "_key_duplicate")),
    (None, "Tern", ("_is_stall_null",)),
    (None, None, ("_is_since_invalid", "_is_stall_null")),
]


def reasons_of(records):
    return sorted(((r.stall, r.label, tuple(r.reason)) for r in records.collect()), key=str)


def bad_with(*reasons):
    """The bad rows that have any of these reasons, with these alone."""
    kept = [(stall, label, tuple(r for r in found if r in reasons)) for stall, label, found in BAD]
    return sorted((row for row in kept if row[2]), key=str)


def shop_spec(path, table_name="stalls", **changes):
    fields = {
        "name": "stalls",
        "file_path": str(path),
        "table_name": table_name,
        "columns": {"stall": "int", "label": "string", "zone": "string", "since": "date"},
        "keys": ["stall", "zone"],
        "header": "true",
        "delimiter": "|",
    }
    return TableSpec(**{**fields, **changes})


def write_shops(folder):
    path = folder / "stalls_20240310.csv"
    path.write_text("\n".join(LINES))
    return path
