"""Fixed schemas of the engine's tables."""

from pyspark.sql import types as T

# one stored headline; the store is long form, partitioned by day
RECORD_FIELDS = [
    T.StructField("pos", T.LongType()),
    T.StructField("headline", T.StringType()),
    T.StructField("created", T.TimestampType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("labelled", T.IntegerType()),
]
RECORD = T.StructType(RECORD_FIELDS)

HEADLINES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("feed", T.StringType()),
    *RECORD_FIELDS,
    T.StructField("day", T.DateType()),
])

# keyed rows of the store: the digest of the headline stands for it, its text is in the store's table of headlines
KEYED_HEADLINES = T.StructType([T.StructField("headline_key", T.BinaryType()) if f.name == "headline" else f for f in HEADLINES.fields])
HEADLINE_TEXTS = T.StructType([
    T.StructField("headline_key", T.BinaryType()),
    T.StructField("headline", T.StringType()),
])

# items as they come out of a page: position, date text and headline text
ITEMS = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("feed", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("date_text", T.StringType()),
    T.StructField("headline", T.StringType()),
])

DAY_SYMBOLS = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("ord", T.IntegerType()),
])

SCORES_SNAPSHOT = T.StructType([
    T.StructField("created", T.TimestampType()),
    T.StructField("day", T.DateType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("score", T.LongType()),
])

QUARANTINE = T.StructType([
    T.StructField("reason", T.StringType()),
    T.StructField("feed", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("date_text", T.StringType()),
    T.StructField("headline", T.StringType()),
])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

# pages as they land for the recurring job, one per (symbol, feed) and run
LANDED_PAGES = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("feed", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
])
MESSAGES = T.ArrayType(MESSAGE)

# answers by content: the digest of a prompt's text, one folder per run
ANSWER_MEMO = T.StructType([
    T.StructField("prompt_key", T.BinaryType()),
    T.StructField("answer", T.StringType()),
    T.StructField("run", T.StringType()),
])

# the labels a headline got, batch by batch; key is the digest of (day, symbol, headline)
LABEL_LOG = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("label", T.IntegerType()),
    T.StructField("day", T.DateType()),
    T.StructField("batch_id", T.LongType()),
])

SCORE_DELTAS = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("delta", T.LongType()),
    T.StructField("headlines", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])

# headlines seen by a stream, as digests
SEEN_KEYS = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("day", T.DateType()),
    T.StructField("batch_id", T.LongType()),
])
