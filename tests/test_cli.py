"""The command line runs the load and the ingest end to end."""

import json
import os

from conftest import SF_SMALL
from martlet.__main__ import main
from martlet.sources.fixtures import sources


def test_cli_etl_and_ingest(spark, scratch):
    src = sources(spark, SF_SMALL)
    for t in ["customers", "products", "transactions", "transaction_items", "marketing_campaigns"]:
        src.table(t).write.parquet(os.path.join(scratch, "src", t))
    assert main(["etl", "--source-dir", os.path.join(scratch, "src"), "--warehouse",
                 os.path.join(scratch, "wh"), "--as-of", "2000-01-01T00:00:00"]) == 0
    assert spark.read.parquet(os.path.join(scratch, "wh", "fact_sales")).count() > 0
    inbox = os.path.join(scratch, "in")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "a.json"), "w") as f:
        for i in (1, 2, 2):
            f.write(json.dumps({"transaction_id": i, "customer_id": 5, "product_id": 3, "quantity": 2,
                                "price": 1.5, "transaction_date": "2024-01-01 00:00:05",
                                "total_amount": 3.0}) + "\n")
    assert main(["ingest", "--files", inbox, "--reference", os.path.join(scratch, "src"), "--out",
                 os.path.join(scratch, "out"), "--checkpoint", os.path.join(scratch, "ck"), "--once"]) == 0
    assert spark.read.parquet(os.path.join(scratch, "out", "transactions")).count() == 2
