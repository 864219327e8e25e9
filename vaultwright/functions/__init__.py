from vaultwright.functions.values import (
    audit_columns,
    check_order,
    column,
    comparable,
    empty_to_null,
    identity_millis,
    is_blank,
    to_column_type,
    valid_or_fail,
)

__all__ = [
    "audit_columns",
    "check_order",
    "column",
    "comparable",
    "empty_to_null",
    "identity_millis",
    "is_blank",
    "to_column_type",
    "valid_or_fail",
]
