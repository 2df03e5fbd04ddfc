"""Parameters of the registered queries (the reference's stored tasks use
the same kinds of values: a five-monitor path, top 5, a car list, an
extraction count)."""

# Fixed query parameters.
PATH = ["0001", "0002", "0003", "0004", "0005"]
TOP_N = 5
TOP_DETAIL_PER_MONITOR = 10
AREA_TOP_N = 3
EXTRACT_NUM = 600
TRACK_BLOCK = 16
SEED = 42
TARGET_CARS = ["U00001", "U00002", "U00003"]
STATE_DATE = "2024-01-05"
RANGE_START = "2024-01-08"
RANGE_END = "2024-01-21"
WATERMARK = "10 minutes"
WINDOW = "5 minutes"
AREA_NAME = "ASIA"

# A hundred five-monitor paths over the nine monitors; many share their beginnings.
MANY_PATHS = {f"path{i}": [f"{(i + j * (1 + i // 18) + j * j * (i % 3)) % 9:04d}" for j in range(5)] for i in range(100)}

# Stored tasks, as the task table has them.
_SPAN = f'"startDate":["{RANGE_START}"],"endDate":["{RANGE_END}"]'
TASKS = {
    1: '{' + _SPAN + f',"topNum":["{TOP_N}"]' + '}',
    2: '{' + _SPAN + f',"extractNum":["{EXTRACT_NUM}"]' + '}',
    3: '{' + _SPAN + f',"cars":["{",".join(TARGET_CARS)}"]' + '}',
}
CATALOG_BUCKETS = 8
COMPANION_SECONDS = 900
LOOKUP_CARS = [f"U{i:05d}" for i in range(3, 60, 7)]
SKETCH_RANGES = [("2024-01-01", "2024-01-01"), ("2024-01-01", "2024-01-07"), ("2024-01-08", "2024-01-21"), ("2024-01-01", "2024-01-31")]
