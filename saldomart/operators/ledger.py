"""Second-order balance accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldomart.functions.sizes import broadcast_if_small


def second_order_account(
    df: DataFrame, ledger: DataFrame, number_col: str | None = None, digits: int = 5
) -> DataFrame:
    """``df`` with the ``name`` of its second-order account.

    ``ledger2`` is a column of ``df``, or the first ``digits`` characters of an account
    number in ``number_col``. Few codes cover all accounts, so the chart of accounts is
    broadcast once its measured size allows it.
    """
    if number_col is not None:
        df = df.withColumn("ledger2", F.substring(number_col, 1, digits))
    return df.join(broadcast_if_small(ledger), "ledger2", "left")
