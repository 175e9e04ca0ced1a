"""lamina: a Spark-native fact store and batch views for web analytics.

Immutable, timestamped facts are ingested into a vertically partitioned master
dataset; DataFrame jobs normalize URLs, resolve person ids to one canonical id,
remove duplicate page views and count page views per URL by hour, day, week and
month.
"""

__version__ = "0.1.0"
