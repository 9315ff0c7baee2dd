from __future__ import annotations

import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkpact import configure  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture
def sf_dir():
    return SF_DIR


def columns(spec: str) -> list[dict]:
    """``"id string!, price number"`` as column entries; ``!`` is not nullable."""
    out = []
    for part in spec.split(","):
        name, data_type = part.split()
        out.append({"name": name, "data_type": data_type.rstrip("!"), "nullable": not data_type.endswith("!"), "description": f"the {name}"})
    return out


def document(contract_id: str, spec: str, version: str = "1.0.0", **changes) -> dict:
    doc = {
        "contract_id": contract_id,
        "name": "A Contract",
        "description": "What it is about",
        "version": version,
        "columns": columns(spec),
        "metadata": {
            "data_owner": "Some Team",
            "data_owner_email": "some-team@example.org",
            "data_steward": "Stewards",
            "data_steward_email": "stewards@example.org",
            "sla_uptime_percentage": 99.5,
            "sla_max_latency_ms": 1000,
        },
    }
    doc.update(changes)
    return {key: value for key, value in doc.items() if value is not ...}


def table_of(spark, docs: list) -> "DataFrame":  # noqa: F821
    """Documents (dicts or texts) as ``file_path, seq, raw``."""
    rows = [(f"f{i:03d}.json", i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "file_path string, seq bigint, raw string")


USERS = "user_name string!, email string!, date_of_birth date!"
USERS_2 = USERS + ", zip_code string, last_login_at timestamp"
USERS_3 = USERS_2 + ", is_active boolean!"
PAYMENTS = (
    "transaction_id string!, timestamp timestamp!, account_id string!, merchant_id string!, amount number!, "
    "currency string, status string, description string, card_last_four string!, category string!"
)
PAYMENTS_2 = PAYMENTS.replace("card_last_four string!, ", "") + ", merchant_category_code string, fraud_score number"
AVRO_USERS = {
    "type": "record",
    "name": "Users",
    "doc": "People\n\nMetadata:\n  Data Owner: Some Team (some-team@example.org)\n  SLA Uptime: 99.9%\n  SLA Max Latency: 700ms",
    "fields": [{"name": "user_name", "type": "string"}, {"name": "email", "type": "string", "doc": "mail"}],
}
