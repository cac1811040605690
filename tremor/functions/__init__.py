"""Column-expression helpers (JVM-side, codegen friendly)."""

from tremor.functions.columns import (  # noqa: F401
    fitted,
    hash_unit,
    hash_bigint,
    nan_to_null,
    safe_corr,
    sig,
    to_double,
)
