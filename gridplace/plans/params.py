"""Fixed run parameters of the registered queries.

Every report takes an explicit point in time; the registered queries use
these values so the Spark result and the DuckDB oracle describe the same
run.  They are chosen so that every NULL path of the operators is reached
on the test tables.
"""

JOBS_AS_OF = "1998-07-01"      # occupancy / efficiency / metrics
JOBS_DAYS = 7
SHARES_DAYS = 30               # job shares, label 'user'
SHARES_LABEL = "user"
SCORING_DAYS = 30              # metrics feeding the candidate scoring (no label)
SNAPSHOT_AS_OF = "1998-07-01"  # stamp of catalogue / storage / replica snapshots
POPULARITY_AS_OF = "1998-07-01"
POPULARITY_DAYS = 365
POPULARITY_MIN_TASKS = 10
LATENCY_AS_OF = "2024-01-31"
LATENCY_DAYS = 1
LATENCY_LABEL = "user"
SELECTED_THRESHOLDS = {"Difference": (">", 5), "queue_efficiency": ("<=", 0.3)}
SELECTED_BAND = (0, 9)         # distances of the scoring of listed datasets, both ends excluded
DAILY_AS_OF = "1998-07-01 10:30:00"  # reports from partial counts: a window with a part of a day at either end
DAILY_DAYS = 6.4
SINK_DAYS = ("1998-07-01", "1998-07-02")  # stamps of the snapshot that is written and read back
