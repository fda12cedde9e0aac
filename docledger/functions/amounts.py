"""Column expressions on amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from docledger.functions.text import stripped

# Upper bounds (exclusive) of difference buckets 0..6, and the
# report labels of buckets 0..7 exactly as the reports spell them.
BUCKET_BOUNDS = (0, 1, 10, 100, 1000, 10000, 100000)
BUCKET_LABELS = (
    "< 0 Rs Difference",
    "0 - 1 Rs Difference",
    "1-10 Rs Difference",
    "11- 100 Rs Difference",
    "101- 1000 Rs Difference",
    "1001 - 100000 Rs Difference",
    "100001 - 1000000 Rs Difference",
    "> 1000000",
)


def zero_default(column: Column) -> Column:
    return F.coalesce(column, F.lit(0).cast("decimal(18,3)"))


def text_to_real(column: Column) -> Column:
    """``'1,234.5'`` to a number; NULL when it is not one."""
    return F.replace(column, F.lit(","), F.lit("")).try_cast("float")


def rounded_amount(column: Column) -> Column:
    """Whole absolute amount as text, halves to even; empty or NULL gives ``'0'``.

    Text that is not a number fails the job, as it should for an amount column.
    """
    digits = F.replace(stripped(column.cast("string")), F.lit(","), F.lit(""))
    number = F.coalesce(F.nullif(digits, F.lit("")).cast("double"), F.lit(0.0))
    return F.bround(F.abs(number), 0).cast("decimal(38,0)").cast("string")


def bucket_key(amount: Column) -> Column:
    """0 for negatives, then one bucket per power of ten, 7 from 100000 on."""
    ladder = F.when(amount.isNull(), F.lit(None).cast("int"))
    for key, bound in enumerate(BUCKET_BOUNDS):
        ladder = ladder.when(amount < bound, F.lit(key))
    return ladder.otherwise(F.lit(len(BUCKET_BOUNDS)))


def bucket_label(key: Column, labels: Sequence[str] = BUCKET_LABELS) -> Column:
    named_keys = [F.when(key == i, label) for i, label in enumerate(labels)]
    return F.coalesce(*named_keys)


def debit_credit(flag: Column, amount: Column, side: str, factor: float = 1.0, other: float | None = None) -> Column:
    """Amount where ``flag`` equals ``side`` (S debit, H credit), else ``other``."""
    scaled = amount.cast("float").cast("double") / F.lit(float(factor))
    return F.when(flag == side, scaled).otherwise(F.lit(other).cast("double"))
