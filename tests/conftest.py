import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabspark.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", 4, **{"spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def app(spark):
    from catalog.base import applications

    frame = applications(spark, SF).persist()
    frame.count()
    return frame


@pytest.fixture(scope="session")
def app_pd(app):
    return app.toPandas()


@pytest.fixture(scope="session")
def people(spark):
    """100 rows without randomness: skewed income with one huge value and nulls, ages, genders, a rare job, 10 percent positives."""
    rows = []
    for i in range(100):
        income = None if i % 10 == 3 else 20000.0 + 900.0 * ((i * 37) % 100) ** 1.3
        age = None if i % 20 == 7 else float(20 + (i * 13) % 50)
        gender = None if i % 9 == 4 else ("M" if i % 2 else "F")
        job = "Astronaut" if i in (17, 61) else ("Engineer", "Doctor", "Teacher", "Engineer")[i % 4]
        rows.append((i, 5_000_000.0 if i == 5 else income, age, gender, job, int(i % 10 == 0)))
    return spark.createDataFrame(rows, "id bigint, income double, age double, gender string, occupation string, target int").persist()
