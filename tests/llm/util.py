from collections import Counter

import pandas as pd


def rows(df) -> Counter:
    return Counter(map(str, df.collect()))


def _plain(v):
    v = v.item() if hasattr(v, "item") else v
    if v is None or pd.isna(v):
        return None
    if isinstance(v, float):
        return int(v) if v == int(v) else float(f"{v:.9g}")
    return v


def same_as_sql(df, con, sql) -> None:
    a, b = df.toPandas(), con.execute(sql).df()
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    x, y = (sorted(str(tuple(_plain(v) for v in r)) for r in p[columns].astype(object).itertuples(index=False)) for p in (a, b))
    assert x == y
