import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from voltide.session import local_session

    session = local_session("8", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bars(spark):
    """Three long daily series from the smallest tables, one of them hot."""
    from voltide.sources.ticks import flag_bars

    return flag_bars(spark, "/root/testdata/sf0.001").cache()


@pytest.fixture(scope="session")
def walk(spark):
    """A random walk of 5,000 days (three blocks) as pandas and Spark."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    n = 5000
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    open_ = close * np.exp(rng.normal(0, 0.004, n))
    spread = np.abs(rng.normal(0, 0.004, (2, n)))
    pdf = pd.DataFrame(
        {
            "series_id": "W",
            "date": pd.date_range("1995-01-01", periods=n).date,
            "open": open_,
            "high": np.maximum(open_, close) * (1 + spread[0]),
            "low": np.minimum(open_, close) * (1 - spread[1]),
            "close": close,
            "volume": rng.integers(100, 1000, n).astype(float),
        }
    )
    return pdf, spark.createDataFrame(pdf).cache()
