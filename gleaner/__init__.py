"""gleaner — a Spark-native item-curation engine.

Landed feeds, sitemaps, listing pages and documents become one tagged
DataFrame (every raw item gets one ``disposition``); ranked items, run
statistics, health boards, report lines and export tables are all
aggregates, windows or projections over it.
"""

__version__ = "0.1.0"
