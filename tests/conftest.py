import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="2",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


COMPANIES = (
    "company_id string, domain string, funding_stage string, ai_adoption_level string, "
    "founding_year bigint, total_funding double, valuation double, revenue double, "
    "headcount bigint, status string"
)


@pytest.fixture(scope="session")
def companies(spark):
    """24 labelled rows, 12 per class, two gaps in a category."""
    rows = []
    for i in range(24):
        good = i % 2 == 0
        rows.append(
            (
                f"S{i + 1:03d}",
                ("Fintech", "Health", "Robotics")[i % 3],
                ("Seed", "Series A", "Series B", "Series C")[i % 4],
                None if i in (7, 17) else ("High", "Medium", "Low")[i % 3],
                2008 + i % 14,
                5.0 + 3.5 * i,
                (60.0 if good else 20.0) + 4.0 * i,
                1.5 + 0.8 * i,
                0 if i == 5 else 20 + 6 * i,
                "Acquired" if good else "Independent",
            )
        )
    return spark.createDataFrame(rows, COMPANIES)


def as_set(df):
    return sorted(map(tuple, df.collect()), key=str)
