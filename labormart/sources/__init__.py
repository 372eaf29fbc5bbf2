"""Sources and sinks."""

from labormart.sources.files import (  # noqa: F401
    Snapshot, bad_files, load_jsonl, load_jsonl_inferred, parquet_view, save_jsonl,
    save_parquet, union_all_by_name,
)
from labormart.sources.messages import (  # noqa: F401
    decode_messages, message_fields, unwrap_pages, vacancy_messages,
)
