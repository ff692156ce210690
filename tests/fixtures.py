"""Small retail CSV sets with known properties, written by rule (no randomness)."""

from __future__ import annotations

import csv
import pathlib
from datetime import datetime, timedelta

STATUSES = ["Delivered", "Shipped", "Processing", "Cancelled", "Returned", "Pending", "In Transit"]
PAYMENTS = ["Credit Card", "PayPal", "Apple Pay", "Google Pay", "Gift Card", "Bank Transfer"]
START = datetime(2026, 1, 1, 8)


def _iso(moment: datetime | None) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S") if moment else ""


def rows(orders: int = 120) -> dict[str, list[dict]]:
    categories = [
        {"category_id": i, "name": f"Category {i}", "description": "", "parent_id": "" if i <= 3 else (i - 1) % 3 + 1}
        for i in range(1, 13)
    ]
    products = [
        {
            "product_id": i, "name": f"Product, \"{i}\"", "description": "line one\nline two" if i == 1 else "d",
            "price": f"{10 + i}.50", "cost": "", "category_id": 4 + i % 9, "sku": f"SKU-{i}",
            "inventory_count": i, "weight": "1.25", "is_active": "true" if i % 7 else "false",
        }
        for i in range(1, 21)
    ]
    customers = [
        {
            "customer_id": i, "email": f"Person{i}@Example.com", "first_name": f"F{i}", "last_name": f"L{i}",
            "street_address": "1 St", "city": "T", "state": "CA", "zip_code": "90210", "country": "US",
            "phone": "", "registration_date": _iso(START - timedelta(days=40 - i % 30)), "last_login": "",
        }
        for i in range(1, 41)
    ]
    heads, lines = [], []
    for i in range(1, orders + 1):
        placed = START + timedelta(hours=29 * i)
        items = [
            {
                "order_item_id": i * 10 + n, "order_id": i, "order_date": _iso(placed),
                "product_id": (i * 3 + n) % 20 + 1, "quantity": n + 1,
                "price": f"{10 + (i * 3 + n) % 20 + 1}.50", "discount": "1.00" if n else "",
            }
            for n in range(1 + i % 4)
        ]
        for item in items:
            total = float(item["price"]) * item["quantity"] - float(item["discount"] or 0)
            item["total"] = f"{total:.2f}"
        heads.append(
            {
                "order_id": i, "customer_id": 1 if i % 3 == 0 else i % 38 + 1, "order_date": _iso(placed),
                "status": STATUSES[i % 7], "payment_method": PAYMENTS[i % 6], "shipping_address": "1 St",
                "shipping_city": "T", "shipping_state": "CA", "shipping_zip": "90210", "shipping_country": "US",
                "processing_date": _iso(placed + timedelta(days=1)), "shipping_date": "", "delivery_date": "",
                "total_amount": f"{sum(float(x['total']) for x in items):.2f}",
            }
        )
        lines += items
    return {
        "product_categories": categories, "products": products, "customers": customers,
        "orders": heads, "order_items": lines,
    }


def write(folder: pathlib.Path, data: dict[str, list[dict]]) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name, records in data.items():
        with open(folder / f"{name}.csv", "w", newline="", encoding="utf-8") as out:
            writer = csv.DictWriter(out, fieldnames=list(records[0]))
            writer.writeheader()
            writer.writerows(records)
    return str(folder)
