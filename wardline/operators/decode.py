"""JSON messages to typed, classified records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardline.schema import (
    COUNT_LABEL_COLUMN,
    INCOMPLETE,
    RECORD_SCHEMA,
    REQUIRED_FIELDS,
    STATUS_COLUMN,
    UNPARSEABLE,
    VALID,
)


def decode(
    messages: DataFrame,
    schema: StructType = RECORD_SCHEMA,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed record columns of each message, one row per message.

    Bad messages become rows of nulls.  The struct is flattened with ``inline``
    rather than by field references: filters on record fields are not pushed
    through a generator, so the JSON is parsed once per row and never again
    inside a predicate.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return messages.select(*keep, F.inline(F.array(parsed)))


def fields_present(schema: StructType = RECORD_SCHEMA) -> Column:
    """How many record fields of a row are not null."""
    return F.expr(" + ".join(f"int(`{name}` IS NOT NULL)" for name in schema.fieldNames()))


def status(
    schema: StructType = RECORD_SCHEMA, required: Sequence[str] = REQUIRED_FIELDS
) -> Column:
    """Where a message broke, if it did.

    Nothing decoded at all is a transmission fault; a missing required field is
    a fault of whoever built the message.  The first test comes first because
    such rows also lack every required field.
    """
    nothing = fields_present(schema) == 0
    lacking = F.expr(" OR ".join(f"`{name}` IS NULL" for name in required))
    return F.when(nothing, UNPARSEABLE).when(lacking, INCOMPLETE).otherwise(VALID)


def parse_messages(
    messages: DataFrame,
    schema: StructType = RECORD_SCHEMA,
    required: Sequence[str] = REQUIRED_FIELDS,
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Decode and classify; also names what each row counts as in the totals."""
    classified = decode(messages, schema, value, keep).withColumn(
        STATUS_COLUMN, status(schema, required)
    )
    counted_as = F.when(F.col(STATUS_COLUMN) == VALID, F.col("label")).otherwise(
        F.col(STATUS_COLUMN)
    )
    return classified.withColumn(COUNT_LABEL_COLUMN, counted_as)
