import datetime as dt
import decimal
import math

SF_SMALL = "/root/testdata/sf0.001"


def norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def canonical(columns, rows):
    """Rows with columns sorted by name, as an order-insensitive sorted list."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(norm(r[i]) for i in order) for r in rows), key=repr
    )
