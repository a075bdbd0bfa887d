"""skyfold — Spark-native flight-telemetry analytics.

Batch and Structured Streaming jobs over aircraft position reports: latest and
previous positions, bounded tracks, geofence membership, per-minute activity,
aircraft reference enrichment and classification, map-list / detail / KPI
answers, track segmentation, motion interpolation, fetch-quota accounting,
sustained-condition alerts and network-log summaries.
"""

__version__ = "0.1.0"
