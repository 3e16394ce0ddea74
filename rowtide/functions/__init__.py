from rowtide.functions.cells import apply_chain, kotlin_trim, regex_extract, slugify
from rowtide.functions.ids import lsn_text, name_uuid
from rowtide.functions.schema import column_names, fingerprint

__all__ = [
    "apply_chain", "column_names", "fingerprint", "kotlin_trim", "lsn_text", "name_uuid",
    "regex_extract", "slugify",
]
