"""Parameters of the registered query scenarios, shared by the Spark side and
the DuckDB oracle.  The driver tables' events span 2024-01-01 .. 2024-01-30
at every scale."""

DAY = "2024-01-15"              # one-day breakdowns (F2) and the incremental day (R1)
SPLIT_HOUR = 12                 # R1: the first load holds DAY's rows before this hour
ERASE_USERS = (1, 3)            # users named in the erasure request (R3)
UPSERT_FROM = "2024-01-28"      # R2: updates restate the last three days ...
BASE_BEFORE = "2024-01-30"      # ... of a table that lacks the last day
MOVED_MERCHANT = "merchant_3"   # R2: the latest update moves these rows one day back
CORRECTIONS_FROM = "2024-01-28"  # R4: batch 2 restates these days with amount + 1
# quarantine_amounts: amounts of these merchants that DECIMAL(12,2) cannot hold, or only as 0.00
ODD_AMOUNTS = {"merchant_3": "1e11", "merchant_5": "0.004", "merchant_9": "NaN", "merchant_13": "Infinity"}
