"""Sources: declared-schema readers for the raw housing files, and the test-table mapping."""

from hearth.sources.csv_import import CsvImport, HeaderError
from hearth.sources.files import RAW_SCHEMAS, import_raw, read_raw, write_table
from hearth.sources.tpch import RawInputs, raw_inputs, read_table
from hearth.sources.versions import ConcurrentLoad, VersionedTable

__all__ = ["RAW_SCHEMAS", "ConcurrentLoad", "CsvImport", "HeaderError", "RawInputs", "VersionedTable", "import_raw", "raw_inputs",
           "read_raw", "read_table", "write_table"]
