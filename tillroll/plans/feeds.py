"""Feed files of a landing folder -> feed DataFrames for ``run_pipeline``.

Default names as in the reference: customers.csv, stores.csv, products.csv,
orders.csv, order_items.csv, payments.json; an optional landed products API
extract (products_api.json: id, title, price) is overlaid on the snapshot and
the snapshot alone is used when it cannot be read. Any feed may instead be a
JSON Lines file or folder (customers.jsonl ...), which Spark can split, and a CSV
feed may be a folder of files under its name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.schemas import SPECS
from tillroll.sources import fs
from tillroll.sources.files import load_csv, load_json
from tillroll.sources.overlay import products_input

FILES = {
    "customers": "customers.csv",
    "stores": "stores.csv",
    "products": "products.csv",
    "orders": "orders.csv",
    "order_items": "order_items.csv",
    "payments": "payments.json",
}
API_EXTRACT = "products_api.json"


def file_feeds(spark: SparkSession, feed_dir: str) -> tuple[dict[str, Callable[[], DataFrame]], dict[str, str]]:
    """(feed callables, source labels) for every feed of ``feed_dir``."""
    base = feed_dir.rstrip("/")
    feeds: dict[str, Callable[[], DataFrame]] = {}
    labels: dict[str, str] = {}
    for name, fname in FILES.items():
        path = f"{base}/{fname}"
        req = ["store_id", "store_name"] if name == "stores" else SPECS[name].required_columns
        jsonl = f"{base}/{name}.jsonl"
        if fs.exists(spark, jsonl):
            # values as text, like CSV; the rules and casts come later
            feeds[name] = lambda p=jsonl, r=req, s=SPECS[name].feed_struct(): load_json(spark, p, required_columns=r, lines=True, schema=s)
            labels[name] = f"jsonl:{name}.jsonl"
        elif fname.endswith(".json"):
            feeds[name] = lambda p=path, r=req, s=SPECS[name].feed_struct(): load_json(spark, p, required_columns=r, schema=s)
            labels[name] = f"json:{fname}"
        else:
            feeds[name] = lambda p=path, r=req: load_csv(spark, p, required_columns=r)
            labels[name] = f"csv:{fname}"
    api = f"{base}/{API_EXTRACT}"
    snapshot = feeds["products"]
    extract = (lambda: load_json(spark, api, required_columns=["id", "title", "price"])) if fs.exists(spark, api) else None

    def products() -> DataFrame:
        df, label = products_input(snapshot, extract)
        labels["products"] = label
        return df

    feeds["products"] = products
    return feeds, labels
