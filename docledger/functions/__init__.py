from docledger.functions.amounts import (
    BUCKET_BOUNDS,
    BUCKET_LABELS,
    bucket_key,
    bucket_label,
    debit_credit,
    rounded_amount,
    text_to_real,
    zero_default,
)
from docledger.functions.text import (
    NA_TOKENS,
    composite_key,
    dotted_date,
    named,
    null_if_na,
    pad_key,
    prefix_int,
    rjust_key,
    row_hash,
    split_bracketed,
    split_fields,
    stripped,
    suffix_match,
    value_text,
)

__all__ = [
    "BUCKET_BOUNDS",
    "BUCKET_LABELS",
    "NA_TOKENS",
    "bucket_key",
    "bucket_label",
    "composite_key",
    "debit_credit",
    "dotted_date",
    "named",
    "null_if_na",
    "pad_key",
    "prefix_int",
    "rjust_key",
    "rounded_amount",
    "row_hash",
    "split_bracketed",
    "split_fields",
    "stripped",
    "suffix_match",
    "text_to_real",
    "value_text",
    "zero_default",
]
