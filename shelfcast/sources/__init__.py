from shelfcast.sources.live import live_rows
from shelfcast.sources.prices import price_file_name, read_prices, stamp_prices, stamped_price_file
from shelfcast.sources.staging import SIZE_RULE_SCHEMA, ZIP_MAP_SCHEMA, read_typed_csv, stage_csv

__all__ = [
    "SIZE_RULE_SCHEMA",
    "ZIP_MAP_SCHEMA",
    "live_rows",
    "price_file_name",
    "read_prices",
    "read_typed_csv",
    "stage_csv",
    "stamp_prices",
    "stamped_price_file",
]
