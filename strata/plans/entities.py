"""The declared record kinds: CRM customers, billing invoices and support tickets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import functions as F

from strata.functions.cleaning import amount, code, in_base_currency, instant, label, person_name, prefixed_id, rate_of
from strata.operators.refine import Entity

# The domains and rates the business rules are written for.
REGIONS = ("NA", "EMEA", "APAC", "LATAM")
SEGMENTS = ("enterprise", "midmarket", "smb")
PRIORITIES = ("P1", "P2", "P3")
INVOICE_STATUSES = ("paid", "open", "void")
TICKET_STATUSES = ("open", "closed", "pending")
USD_RATES = {"USD": "1.00", "EUR": "1.08", "GBP": "1.27"}
ID_PREFIX = "C"
ID_DIGITS = 4

CUSTOMER_COLUMNS = ("customer_id", "full_name", "email", "region", "segment", "updated_at")
INVOICE_COLUMNS = ("invoice_id", "customer_ref", "amount", "currency", "status", "issued_at")
TICKET_COLUMNS = ("ticket_id", "customer_id", "subject", "priority", "status", "opened_at")


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} in ({', '.join(repr(v) for v in values)})"


def _present(column: str) -> str:
    return f"{column} is not null and {column} != ''"


def customers(
    digits: int = ID_DIGITS, regions: Sequence[str] = REGIONS, segments: Sequence[str] = SEGMENTS
) -> Entity:
    return Entity(
        name="customers",
        source_columns=CUSTOMER_COLUMNS,
        typed={
            "customer_id": code("customer_id"),
            "full_name": person_name("full_name"),
            "email": label("email"),
            "region": code("region"),
            "segment": label("segment"),
            "updated_at": instant("updated_at"),
        },
        key="customer_id",
        version="updated_at",
        rules={
            "customer_id_format": f"customer_id rlike '^{ID_PREFIX}[0-9]{{{digits}}}$'",
            "region_valid": _one_of("region", regions),
            "segment_valid": _one_of("segment", segments),
            "updated_at_valid": "updated_at is not null",
            "email_has_at": "email like '%@%'",
        },
    )


def invoices(digits: int = ID_DIGITS, rates: Mapping[str, str] = USD_RATES) -> Entity:
    """Billing names a customer by the bare number; the typed row carries the CRM form of the id."""
    return Entity(
        name="invoices",
        source_columns=INVOICE_COLUMNS,
        typed={
            "invoice_id": F.trim("invoice_id"),
            "customer_id": prefixed_id("customer_ref", ID_PREFIX, digits),
            "amount": amount("amount"),
            "currency": code("currency"),
            "status": label("status"),
            "issued_at": instant("issued_at"),
        },
        key="invoice_id",
        version="issued_at",
        rules={
            "invoice_id_present": _present("invoice_id"),
            "amount_not_null": "amount is not null",
            "amount_positive": "amount > 0",
            "currency_valid": _one_of("currency", list(rates)),
            "status_valid": _one_of("status", INVOICE_STATUSES),
            "issued_at_valid": "issued_at is not null",
        },
        reference="customer_id",
        derived={"amount_usd": in_base_currency(F.col("amount"), rate_of(F.col("currency"), rates))},
    )


def tickets() -> Entity:
    return Entity(
        name="tickets",
        source_columns=TICKET_COLUMNS,
        typed={
            "ticket_id": F.trim("ticket_id"),
            "customer_id": code("customer_id"),
            "subject": F.trim("subject"),
            "priority": code("priority"),
            "status": label("status"),
            "opened_at": instant("opened_at"),
        },
        key="ticket_id",
        version="opened_at",
        rules={
            "ticket_id_present": _present("ticket_id"),
            "priority_valid": _one_of("priority", PRIORITIES),
            "status_valid": _one_of("status", TICKET_STATUSES),
            "opened_at_valid": "opened_at is not null",
        },
        reference="customer_id",
    )
