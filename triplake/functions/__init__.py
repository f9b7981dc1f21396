"""Column-level functions: coercion of untyped values and row features."""

from triplake.functions.scalars import (  # noqa: F401
    default_strip,
    default_if_empty,
    in_closed_range,
    strip_whitespace,
    to_bigint,
    to_double,
    to_naive_ts,
)
from triplake.functions.features import (  # noqa: F401
    build_features,
    feature_columns,
    label_column,
)
