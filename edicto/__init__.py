"""Court-bulletin pages to clean, deduplicated records on Spark.

The public API is DataFrame in / DataFrame out (use with `df.transform`)
plus Column functions; see README.md for the operator inventory.
"""

from edicto.functions.classify import classify_subject, contains_any, map_code
from edicto.functions.dates import (
    code_to_date,
    current_month_only,
    day_code,
    month_code,
    month_range,
    parse_spanish_date,
    rolling_window,
    technical_ts,
)
from edicto.functions.extract import (
    case_number,
    case_type,
    claimant_parts,
    defendant_parts,
    origin_case,
    origin_court,
    rulings,
)
from edicto.functions.text import clean, join_nodes, map_compose, take_first, with_clean
from edicto.functions.urls import query_param, url_join
from edicto.operators.html import (
    build_courts,
    calendar_days,
    calendar_nav,
    calendar_year,
    day_page_rows,
    extract_links,
    section_links,
    table_rows,
)
from edicto.operators.joins import absent_from, sized, present_in
from edicto.operators.keywords import classify_words
from edicto.operators.load import count_matches, first_by_key, last_by_key, progress_by_day, work_key
from edicto.operators.records import extract_records, rejected, valid
from edicto.operators.worklist import pending, plan_units
from edicto.session import get_spark
from edicto.sources.io import (
    append_ledger,
    append_records,
    export_json,
    read_captures,
    read_ledger,
    read_records,
    retry_candidates,
    write_captures,
)
from edicto.streaming.ingest import (
    content_keyed,
    dedup_within_watermark,
    first_captures,
    ingest_captures,
    stream_append_if_absent,
    stream_first_captures,
)

__all__ = sorted(n for n, v in list(globals().items()) if not n.startswith("_") and callable(v))
