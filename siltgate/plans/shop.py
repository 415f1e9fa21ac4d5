"""Customers and orders: contracts and the plans built from them."""

from __future__ import annotations

from collections.abc import Sequence

from siltgate.contracts import CheckSpec, Intake, Lookup, Rule
from siltgate.functions import predicates as bad

# The order states a silver order may have, and the stand-in for a
# missing country.
ALLOWED_STATUS = ("pending", "paid", "shipped", "cancelled", "refunded")
UNKNOWN_COUNTRY = "UNKNOWN"

CUSTOMER_SILVER = ("customer_id", "name", "email", "country", "signup_date")
ORDER_SILVER = ("order_id", "customer_id", "order_date", "amount", "currency", "status")


def customer_intake(
    bronze_columns: Sequence[str],
    silver_columns: Sequence[str] = CUSTOMER_SILVER,
    order_by: Sequence[str] = ("_arrival",),
) -> Intake:
    return Intake(
        name="customers",
        key=("customer_id",),
        order_by=tuple(order_by),
        duplicate_reason="duplicate_customer_id",
        rules=(
            Rule("invalid_or_blank_email", f"({bad.blank('email')} OR {bad.malformed('email')})"),
            Rule("blank_name", bad.blank("name")),
        ),
        bronze_columns=tuple(bronze_columns),
        silver_columns=tuple(silver_columns),
        fills={"country": f"if({bad.blank('country')}, '{UNKNOWN_COUNTRY}', country)"},
    )


def order_intake(
    bronze_columns: Sequence[str],
    silver_columns: Sequence[str] = ORDER_SILVER,
    order_by: Sequence[str] = ("_arrival",),
    allowed_status: Sequence[str] = ALLOWED_STATUS,
) -> Intake:
    """Orders are judged against *silver* customers: rejecting a customer rejects the
    customer's orders."""
    return Intake(
        name="orders",
        key=("order_id",),
        order_by=tuple(order_by),
        duplicate_reason="duplicate_order_id",
        rules=(
            Rule("non_positive_or_null_amount", bad.not_positive("amount")),
            Rule("invalid_status", bad.not_in("status", allowed_status)),
            Rule("blank_customer_id", bad.blank("customer_id")),
        ),
        lookup=Lookup("customer_id", "customer_id", "orphan_customer_id"),
        bronze_columns=tuple(bronze_columns),
        silver_columns=tuple(silver_columns),
    )


def customer_checks(intake: Intake) -> CheckSpec:
    return CheckSpec(
        table="customers",
        bronze_columns=intake.bronze_columns,
        silver_columns=intake.silver_columns,
        max_null_pct={"email": 0.0, "name": 0.0, "country": 0.0},
        unique_columns=("customer_id", "email"),
        email_column="email",
        max_drop_pct=50.0,
    )


def order_checks(intake: Intake, allowed_status: Sequence[str] = ALLOWED_STATUS) -> CheckSpec:
    return CheckSpec(
        table="orders",
        bronze_columns=intake.bronze_columns,
        silver_columns=intake.silver_columns,
        max_null_pct={"order_id": 0.0, "customer_id": 0.0, "amount": 0.0, "status": 0.0},
        unique_columns=("order_id",),
        positive_column="amount",
        allowed={"status": tuple(allowed_status)},
        max_drop_pct=50.0,
    )
