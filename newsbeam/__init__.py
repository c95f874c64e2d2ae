"""newsbeam: a PySpark engine for news headlines.

Extract headlines from landed pages, keep the recent ones, merge feeds into
one set per day and symbol without repeats, score them with a pluggable
sentiment scorer and rank symbols by net sentiment, in batch and as a
Structured Streaming job.
"""

__version__ = "0.1.0"
