"""Sources and sinks: parquet/CSV tables, match documents, id listings, writers."""

from matchlake.sources.tables import (  # noqa: F401
    empty_table, path_exists, read_csv, read_or_empty, read_parquet, register_view,
)
from matchlake.sources.documents import list_ids, read_documents  # noqa: F401
from matchlake.sources.sinks import jdbc_options, write_jdbc, write_table  # noqa: F401
