"""Small hand-made shops."""

import datetime as dt

from patronage.sources.schemas import RAW_TABLES
from patronage.sources.shop import Shop


def day(text):
    return dt.datetime.fromisoformat(text)


def frame(spark, table, rows):
    """Rows as dictionaries; missing columns are null."""
    schema = spark.createDataFrame([], RAW_TABLES[table]).schema
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def shop(spark, **tables):
    names = ("orders", "items", "payments", "reviews", "customers", "products", "categories")
    return Shop(**{name: frame(spark, name, tables.get(name, [])) for name in names})


def order(order_id, customer, bought, delivered=None, promised=None, status="delivered"):
    return {
        "order_id": order_id,
        "customer_id": customer,
        "order_status": status,
        "order_purchase_timestamp": day(bought),
        "order_delivered_customer_date": day(delivered) if delivered else None,
        "order_estimated_delivery_date": day(promised) if promised else None,
    }


def same(left, right, key="customer_id"):
    """Equal rows by key; floating point numbers up to the noise of summation."""
    import math

    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    a, b = ({r[key]: r for r in df.collect()} for df in (left, right))
    assert set(a) == set(b)
    for k in a:
        for c in columns:
            x, y = a[k][c], b[k][c]
            close = isinstance(x, float) and math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9)
            assert x == y or close, (k, c, x, y)
