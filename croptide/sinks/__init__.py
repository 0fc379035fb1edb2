"""Writers: index store, feature tables, missing partitions, requests, stages."""

from croptide.sinks.requests import RequestMismatch, store_request, stored_requests
from croptide.sinks.stages import clear_stages, fingerprint, materialize_stage
from croptide.sinks.tables import (
    existing_keys,
    replace_table,
    write_features,
    write_index_store,
    write_missing_partitions,
)

__all__ = ["RequestMismatch", "clear_stages", "existing_keys", "fingerprint",
           "materialize_stage", "replace_table", "store_request", "stored_requests",
           "write_features", "write_index_store", "write_missing_partitions"]
