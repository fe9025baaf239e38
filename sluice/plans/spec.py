"""The description of one table: where it comes from, its columns, its keys, how it is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from sluice.functions.names import check_names
from sluice.sources.files import MALFORMED, file_format

WRITE_MODES = ("append", "overwrite")

# Names the checks give to columns of the result.
RESERVED = {"_sk", "reason", "_row_duplicate", "_key_duplicate", MALFORMED, "_run_id"}


@dataclass(frozen=True)
class TableSpec:
    """Columns keep their order: it is the column order of the clean table.

    `reject_malformed`: rows of a delimited file that have too few or too many fields are bad records, with their whole text.
    """

    name: str
    file_path: str
    table_name: str
    columns: Sequence[tuple[str, str]] | Mapping[str, str]
    keys: Sequence[str]
    header: bool | str | None = None
    delimiter: str | None = None
    write_mode: str = "overwrite"
    reject_malformed: bool = False

    def __post_init__(self) -> None:
        pairs = self.columns.items() if isinstance(self.columns, Mapping) else self.columns
        object.__setattr__(self, "columns", tuple((c, t) for c, t in pairs))
        object.__setattr__(self, "keys", tuple(self.keys))
        if file_format(self.file_path) != "csv" and self.reject_malformed:
            raise ValueError(f"{self.name}: only delimited rows can be malformed")
        if len(set(self.column_names)) != len(self.columns):
            raise ValueError(f"{self.name}: a column is declared twice")
        if RESERVED & {c.lower() for c in self.column_names}:
            raise ValueError(f"{self.name}: these column names are reserved: {sorted(RESERVED)}")
        check_names(self.column_names)
        unknown = [k for k in self.keys if k not in self.column_names]
        if unknown or not self.keys:
            raise ValueError(f"{self.name}: keys must be declared columns, got {list(self.keys)}")
        if self.write_mode not in WRITE_MODES:
            raise ValueError(f"{self.name}: write_mode must be one of {WRITE_MODES}, got {self.write_mode!r}")

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def row_columns(self) -> list[str]:
        """The columns of the rows that are checked."""
        return [*self.column_names, *([MALFORMED] if self.reject_malformed else []), "_sk"]

    @property
    def non_keys(self) -> list[str]:
        return [c for c in self.column_names if c not in self.keys]

    # The suffixes of the first three tables.

    @property
    def raw_table(self) -> str:
        return f"{self.table_name}_bronze"

    @property
    def clean_table(self) -> str:
        return f"{self.table_name}_silver"

    @property
    def bad_table(self) -> str:
        return f"{self.table_name}_bad_record"

    @property
    def counts_table(self) -> str:
        return f"{self.table_name}_run_counts"
