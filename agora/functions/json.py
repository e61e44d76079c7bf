"""JSON encode / decode by a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def encode_json(columns: Sequence[str], keep_nulls: bool = True) -> Column:
    """One JSON object per row with the given fields, in the given order.

    ``keep_nulls`` writes missing values as ``null`` (Python ``json.dumps`` of a
    dict with None values); Spark would drop those keys by default.
    """
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*[F.col(c) for c in columns]), opts)


def decode_json(value: Column | str, schema: StructType, corrupt_column: str | None = None) -> Column:
    """Parse a JSON text column into a struct of ``schema`` (PERMISSIVE mode).

    With ``corrupt_column`` the schema gains that STRING field, which holds the
    raw text of a record that does not parse; the caller routes such rows to a
    quarantine output.
    """
    col = F.col(value) if isinstance(value, str) else value
    if corrupt_column:
        schema = StructType(list(schema.fields)).add(corrupt_column, "string")
        return F.from_json(
            col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
        )
    return F.from_json(col, schema)
