"""The reference jobs' parameters and formats, used as this library's defaults.

Every one of them is also a parameter of the operator, job or command that uses it.
"""

# --- fixed values (as in the reference) ---------------------------------------------------------
TOP_CATEGORIES = 10                # Q1: hot categories kept
TOP_SESSIONS = 10                  # Q2: sessions kept per hot category
TOP_ADS = 3                        # Q6: ads kept per (day, area)
BLACKLIST_THRESHOLD = 100          # Q4: clicks by one user on one ad in one day that list the user (>=)
TREND_WINDOW_S = 60                # Q7: the trend covers the last minute ...
TREND_SLIDE_S = 10                 # Q7: ... in 10-second buckets, sliding every 10 seconds
TRIGGER_INTERVAL_S = 5             # streaming micro-batch interval
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"  # action and bucket time text
DAY_FORMAT = "yyyy-MM-dd"          # day text
LINE_SEPARATOR = " "               # ad-click line: epoch_ms area city userid adid
CSV_SEPARATOR = ","                # category id lists
# -------------------------------------------------------------------------------------------------
