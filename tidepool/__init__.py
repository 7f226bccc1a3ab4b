"""tidepool: word, tag and trade-record analytics on Spark tables and streams.

Every operator is a function over DataFrames or Columns built from Spark's
own functions, so the same logic runs on a batch table and on a stream and
Catalyst plans all of it.
"""

__version__ = "0.1.0"
