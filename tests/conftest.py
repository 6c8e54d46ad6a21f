import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from obsledger.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(base / "warehouse"), "spark.checkpoint.dir": str(base / "checkpoint")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def weather(spark):
    """Small station table: three stations, a date gap, a repeated day, an unreadable date, missing values."""
    from obsledger.roles import OBSERVATION_SCHEMA

    rows = []
    for s, name in enumerate(("Sydney", "Perth", "Darwin")):
        for i in range(8):
            if name == "Perth" and i == 3:
                continue  # gap
            row = {f.name: None for f in OBSERVATION_SCHEMA.fields}
            row.update(Date=f"2024-0{1 + 3 * s}-{i + 1:02d}", Location=name, RISK_MM=0.0,
                       RainToday="Yes" if (i + s) % 3 == 0 else "No", RainTomorrow="Yes" if (i + 1 + s) % 3 == 0 else "No",
                       WindGustDir="N" if i % 2 else "W", WindDir9am="E", WindDir3pm="S", Cloud9am=4.0, Cloud3pm=4.0)
            for j, m in enumerate(f.name for f in OBSERVATION_SCHEMA.fields if f.dataType.typeName() == "double"):
                if row[m] is None:
                    row[m] = float(10 * j + i + 3 * s + ((i * 7 + j) % 5) / 2)
            row["Rainfall"] = 0.5 * i
            rows.append(row)
    rows[1]["MinTemp"] = rows[2]["MaxTemp"] = rows[4]["Rainfall"] = rows[5]["RainToday"] = None
    rows[7]["Rainfall"] = 300.0
    rows[-1]["Date"] = "not a date"
    rows.append(dict(rows[0], RainToday="No"))
    return spark.createDataFrame([tuple(r[f.name] for f in OBSERVATION_SCHEMA.fields) for r in rows], OBSERVATION_SCHEMA)
