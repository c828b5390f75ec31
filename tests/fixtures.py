"""Small source tables for the tests: one valid order and everything it refers to."""

from __future__ import annotations

import csv
import os

from tradeloom.contracts import SOURCE_SCHEMAS, SOURCE_TABLES

VALID_ROWS = {
    "customers": ["CUST-7", "Mira", "Okafor", "mira@example.org", "+44-20", "Leeds", "Yorkshire",
                  "United Kingdom", "VIP", "2022-03-04"],
    "products": ["PRD-3", "Kettle", "Home", "Kitchen", "Brightco", "Northline", "30.00", "75.00", "4.2"],
    "stores": ["STR-9", "Leeds Hub", "DARK_STORE", "United Kingdom", "Yorkshire", "Leeds", "53.8",
               "-1.5", "2019-05-06"],
    "orders": ["ORD-5", "CUST-7", "STR-9", "2024-02-03", "MOBILE_APP", "DELIVERED", "GBP", "202.50"],
    "order_items": ["ITEM-1", "ORD-5", "PRD-3", "3", "75.00", "10"],
    "payments": ["PAY-1", "ORD-5", "UPI", "SUCCESS", "202.50", "2024-02-03", "GBP"],
    "deliveries": ["DEL-1", "ORD-5", "STR-9", "EXPRESS", "DELIVERED", "8.25", "95", "4.50"],
    "exchange_rates": ["2024-02-03", "GBP", "105.5"],
}


def row(table: str, **changes: str) -> dict[str, str]:
    """The table's valid row with some cells replaced."""
    out = dict(zip(SOURCE_SCHEMAS[table], VALID_ROWS[table]))
    unknown = set(changes) - set(out)
    assert not unknown, unknown
    return {**out, **changes}


def text_frame(spark, table: str, rows: list[dict[str, str]]):
    """Rows as an extract delivers them, numbered in order."""
    columns = ["_raw_id", *SOURCE_SCHEMAS[table]]
    data = [(i, *[r[c] for c in columns[1:]]) for i, r in enumerate(rows)]
    ddl = ", ".join(["_raw_id bigint", *[f"{c} string" for c in columns[1:]]])
    return spark.createDataFrame(data, ddl)


def sources(spark, **rows: list[dict[str, str]]):
    """All eight sources; tables not named hold their valid row."""
    return {t: text_frame(spark, t, rows.get(t, [row(t)])) for t in SOURCE_TABLES}


def write_csvs(directory: str, **rows: list[dict[str, str]]) -> str:
    """The same as CSV files in a folder."""
    os.makedirs(directory, exist_ok=True)
    for table in SOURCE_TABLES:
        with open(f"{directory}/{table}.csv", "w", newline="") as f:
            writer = csv.DictWriter(f, fieldnames=list(SOURCE_SCHEMAS[table]))
            writer.writeheader()
            writer.writerows(rows.get(table, [row(table)]))
    return directory
