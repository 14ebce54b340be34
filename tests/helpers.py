from datetime import datetime, timedelta

T0 = datetime(2024, 1, 1)


def at(secs: float) -> datetime:
    return T0 + timedelta(seconds=secs)


def us(secs: float) -> int:
    return int((at(secs) - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=repr)
