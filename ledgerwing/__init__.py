"""ledgerwing: company filings, fundamentals and market signals as Spark jobs."""

__version__ = "0.1.0"
