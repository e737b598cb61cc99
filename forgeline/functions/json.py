"""Re-deriving fields from the preserved JSON payload (no re-fetch needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payload_fields(df: DataFrame, fields: dict[str, tuple[str, str]], payload: str = "raw_payload") -> DataFrame:
    """Add ``name -> (json_path, type)`` columns read from ``payload``.

    ``get_json_object`` is null-safe along the path: a missing key or a JSON
    null anywhere yields NULL, like ``(d.get("a") or {}).get("b")``.
    """
    return df.withColumns({
        name: F.get_json_object(F.col(payload), path).cast(dtype) for name, (path, dtype) in fields.items()
    })

