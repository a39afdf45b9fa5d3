"""Column-level helpers shared by the operators (all JVM-side expressions)."""

from recfold.functions.portable import (  # noqa: F401
    clip,
    portable_hash,
    portable_hash_sql,
    require_columns,
    validate_ratios,
)
