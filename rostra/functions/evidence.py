"""Readable evidence sentence for a funding-dependency score."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dollars(amount: Column) -> Column:
    """Whole dollars with thousands separators and no padding (H6)."""
    return F.format_number(F.round(amount, 0), 0)


def evidence_text(
    pac: Column,
    score: Column,
    receipts: Column,
    cycle: Column,
    committees: Column,
    industries: Column,
) -> Column:
    """NULL where PAC money, score or receipts are NULL (H7)."""
    oversight = F.when(
        committees.isNotNull(),
        F.concat(
            F.lit("Sits on: "), committees,
            F.lit(". These committees oversee: "), industries, F.lit("."),
        ),
    ).otherwise("No committee assignment data available yet.")
    return F.concat(
        F.lit("Received $"), dollars(pac),
        F.lit(" from PACs and political committees ("), score.cast("string"),
        F.lit("% of $"), dollars(receipts),
        F.lit(" total raised in "), cycle.cast("string"),
        F.lit("). "), oversight,
    )
