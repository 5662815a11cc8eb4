"""quarry: a Spark-native batch record pipeline.

Raw JSON lands by day, a gate checks each record without altering it, staging
reads the files back under a pinned schema and keeps the newest version of each
key, arrays fan out into a normalised key-and-tag grain, count and popularity
marts are built from that grain, titles are labelled by ordered whole-word
rules or by a pluggable batched function that only sees new keys, data-quality
checks gate the build, and finished tables are swapped into place with their
provenance.

Every step is a ``DataFrame -> DataFrame`` function; nothing collects rows to
the driver.
"""

__version__ = "0.1.0"
