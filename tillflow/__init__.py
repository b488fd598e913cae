"""tillflow: sales cleaning, star-schema modelling, reports, KPIs and forecasts as Spark jobs."""

__version__ = "0.1.0"
