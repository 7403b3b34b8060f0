from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewatch import load_contract, prepare  # noqa: E402

TEXT = ("unique_key string, created_date string, closed_date string, agency string, "
        "complaint_type string, descriptor string, status string, borough string, "
        "incident_zip string, latitude string, longitude string")
FIRST_DAY, SECOND_DAY, ROWS = "2031-05-04", "2031-05-05", 36
KINDS, SIDES = ("Pothole", "Graffiti", "Leak"), ("Quay", "Hill", "Park")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


@pytest.fixture(scope="session")
def contract():
    return load_contract()


def clean_rows() -> list[dict]:
    """Thirty-six clean rows: two thirds on the first day, half of them one kind and one side."""
    rows = []
    for n in range(ROWS):
        day, hour = FIRST_DAY if n < 24 else SECOND_DAY, 6 + n % 12
        rows.append({
            "row_id": n, "unique_key": str(7000 + 3 * n),
            "created_date": f"{day}T{hour:02d}:30:00.000", "closed_date": f"{day}T{hour + 1:02d}:15:00.000",
            "agency": "PW", "complaint_type": KINDS[(n % 6) // 3 + (n % 6) // 5], "descriptor": f"case {n}",
            "status": "Closed", "borough": SIDES[(n % 4) // 2 + (n % 4) // 3], "incident_zip": "01234",
            "latitude": str(52 + n / 64), "longitude": str(4 + n / 128),
        })
    return rows


def to_frame(spark, rows, schema="row_id long, " + TEXT):
    names = [part.strip().split(" ")[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


@pytest.fixture(scope="session")
def feed(spark):
    return to_frame(spark, clean_rows()).coalesce(2).cache()


def as_set(frame, *columns):
    return {tuple(r) if len(columns) > 1 else r[0] for r in frame.select(*columns).collect()}
