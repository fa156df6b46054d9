"""Options of a delivery run. The defaults follow the current production routine."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from postbud import layout


@dataclass(frozen=True)
class DeliveryOptions:
    # What to run and where the files are.
    months: tuple[str, ...] = ()
    regions: tuple[str, ...] = layout.REGIONS
    base_dir: str = ""
    app_dir: str = ""
    out_dir: str = ""
    cache_dir: str | None = None

    # Reading exports.
    strict_input: bool = True
    export_name: str = layout.EXPORT_NAME
    export_name_without_month: str = layout.EXPORT_NAME_WITHOUT_MONTH
    tie_delimiter: str = ";"
    encoding_override: str | None = None
    repair_mojibake: bool = True
    fail_on_mojibake: bool = False
    multi_line: bool = False
    drop_empty_columns: bool = False
    drop_position: int | None = None
    alias_policy: str = "unique"
    header_aliases: Mapping[str, str] = field(default_factory=lambda: dict(layout.HEADER_ALIASES))
    absent_location_token: str | None = "NULL"
    trim_ids: bool = False

    # Failed checks that otherwise stop a run and are only to be reported, by name: missing_input,
    # missing_key, missing_returns, mojibake_in, map_empty, map_duplicates, unmapped, mojibake_out.
    warn_only: tuple[str, ...] = ()

    # Numbering and enrichment.
    strict_lopenr: bool = False
    fill_missing_kommune: bool = True
    district_fill: str = "original"
    overrides: tuple[tuple[str, int, str], ...] = layout.LOCATION_OVERRIDES

    # Output.
    columns: tuple[str, ...] = layout.DELIVERY_COLUMNS
    missing_token: str | None = "NULL"
    integer_columns: tuple[str, ...] = ()
    fail_on_mojibake_out: bool = True
    max_rows_per_file: int = 1_000_000
    # One file per name, written by one task, for receivers that take no folders of files. It
    # holds for every request and delivery alike, whatever its size.
    one_file: bool = False
    # Table of all deliveries; the text files are an export of it.
    table_dir: str | None = None

    def __post_init__(self):
        for name, allowed in (
            ("alias_policy", ("unique", "first")),
            ("district_fill", ("original", "filled")),
            ("tie_delimiter", (";", ",")),
        ):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, got {getattr(self, name)!r}")
        if self.max_rows_per_file < 1:
            raise ValueError("max_rows_per_file must be at least 1")

    @property
    def delivery_table(self) -> str:
        return self.table_dir or f"{self.out_dir}/deliveries"

    @property
    def suffixes(self) -> tuple[str, ...]:
        """Month suffixes of the run, such as ``des25`` for 2025-12-01."""
        if not self.months:
            raise ValueError("months is empty")
        days = [date.fromisoformat(m) for m in self.months]
        return tuple(dict.fromkeys(f"{layout.MONTHS[d.month - 1]}{d:%y}" for d in days))
