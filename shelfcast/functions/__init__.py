from shelfcast.functions.dates import local_date
from shelfcast.functions.keys import sequence_label, surrogate_key

__all__ = ["local_date", "sequence_label", "surrogate_key"]
