"""Sources and sinks: declared schemas, readers/writers, the source catalog and
the fixture builders over the driver tables."""

from . import fixtures, schemas  # noqa: F401
from .catalog import SOURCES, SourceSpec, spec  # noqa: F401
from .io import normalize_headers, read_source, read_table, write_csv, write_parquet  # noqa: F401
