"""Scans and sinks."""

from .fixtures import headline_records, headlines_view, recorded_answers  # noqa: F401
from .raw import decode_pages, land_pages, read_raw_pages  # noqa: F401
from .store import (append_snapshot, read_snapshots, read_store, upsert_day,  # noqa: F401
                    upsert_days, write_day, write_labels)
from .tables import (read_day, read_pages, read_prompts, read_table,  # noqa: F401
                     symbol_dim_df, symbols_df)
