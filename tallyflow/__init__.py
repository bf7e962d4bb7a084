"""tallyflow: a real-time retail warehouse expressed as Spark DataFrame jobs.

Two raw feeds (application logs and database row changes) become facts,
event-time window metrics and dated reports.  Every operator is a plain
``DataFrame -> DataFrame`` function.
"""

__version__ = "0.1.0"
