"""tidecast — forecast many time series at once on Spark, and score the forecasts.

Layout
------
``sources/``    readers (tables, CSV, JSON lines, JDBC, forecast documents) and sinks
``functions/``  column expressions: IEEE ratios, time grids, calendar and Fourier terms
``operators/``  series reshaping, metrics, and the forecast models (``operators/models``)
``plans/``      composed jobs: backtest, leaderboard, dataset generation, batch scoring,
                and the named query catalog used by ``__spark_entry__``
``streaming/``  incremental ingest of newly landed files

Every operator takes and returns DataFrames in the long forms of ``tidecast.schema``.
"""

from tidecast.session import get_session  # noqa: F401

__version__ = "0.1.0"
