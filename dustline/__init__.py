"""Usage audit and tabular ingest, written as Spark jobs."""

from dustline.operators.checks import object_mentions, stale_rows
from dustline.operators.inference import infer_types, spell_as
from dustline.operators.mentions import (
    all_object_mentions,
    catalog_objects,
    identifier_mentions,
    mention_index,
)
from dustline.operators.sheets import combine_sheets, drop_empty_columns, drop_empty_rows
from dustline.operators.text_tables import as_text, export_csv, read_tables
from dustline.operators.usage import object_usage
from dustline.plans.append import append_folder
from dustline.plans.audit import check_table, data_check, data_check_all, unused_objects
from dustline.plans.flatten import flatten_access_history
from dustline.plans.incremental import UsageState
from dustline.plans.ingest import (
    combine_workbook,
    ingest_folder,
    ingest_workbooks,
    positional_load,
    read_csv_text,
    save_as_text,
)
from dustline.plans.models import access_history, dim_access_history, materialize
from dustline.sources.tables import table
from dustline.sources.workbooks import all_sheets, first_sheet, scan_workbooks, sheet_rows
from dustline.streaming.arrivals import append_arrivals

__all__ = [
    "UsageState",
    "access_history",
    "all_object_mentions",
    "all_sheets",
    "append_arrivals",
    "append_folder",
    "as_text",
    "catalog_objects",
    "check_table",
    "combine_sheets",
    "combine_workbook",
    "data_check",
    "data_check_all",
    "dim_access_history",
    "drop_empty_columns",
    "drop_empty_rows",
    "export_csv",
    "first_sheet",
    "flatten_access_history",
    "identifier_mentions",
    "infer_types",
    "ingest_folder",
    "ingest_workbooks",
    "materialize",
    "mention_index",
    "object_mentions",
    "object_usage",
    "positional_load",
    "read_csv_text",
    "read_tables",
    "save_as_text",
    "scan_workbooks",
    "sheet_rows",
    "spell_as",
    "stale_rows",
    "table",
    "unused_objects",
]
