"""martlet: a Spark-native retail sales mart.

Batch: snapshot five order-taking tables into staging, clean them, build
date / customer / product / campaign dimensions with stable surrogate keys and
load a line-grain ``fact_sales`` incrementally into month partitions.
Streaming: parse JSON sale events, validate them, split them into header and
line tables without duplicating replays, and publish completed per-minute
transaction counts.

Everything is expressed with DataFrames, SQL and Structured Streaming.
"""

from martlet.session import build_session, configure, checkpoint_dir

__all__ = ["build_session", "configure", "checkpoint_dir"]
