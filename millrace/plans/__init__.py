from millrace.plans.batch_ingest import BatchIngestResult, run_batch_ingest, transform_orders
from millrace.plans.csv_etl import CsvEtlResult, clean_csv, run_csv_etl
from millrace.plans.event_publish import publish_events

__all__ = [
    "BatchIngestResult",
    "CsvEtlResult",
    "clean_csv",
    "publish_events",
    "run_batch_ingest",
    "run_csv_etl",
    "transform_orders",
]
