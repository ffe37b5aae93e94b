"""Defaults of the original jobs.

Fixed values (taken as-is from the original jobs' settings):
- record layout: categorical fields at positions 1, 2, 3; the label is the last field
- field separator ",", word separator " "
- production k-means: k = 150, runs = 10, epsilon = 1e-6
- anomaly threshold: the 100th largest training distance
- default k-means: k = 2, 20 iterations, epsilon = 1e-4; k-means|| with today's 2 steps
- online k-means: decay factor 1.0, random centres with weight 0.0, time unit "batches"
- micro-batch interval: 10 seconds (k-means), 20 seconds (word count)
- exported sample: fraction 0.05, without replacement
- printed rows per batch: 10
"""

CATEGORICAL_POSITIONS = (1, 2, 3)
FIELD_SEPARATOR = ","
WORD_SEPARATOR = " "
PRODUCTION_K = 150
PRODUCTION_RUNS = 10
PRODUCTION_EPSILON = 1e-6
ANOMALY_RANK = 100
DEFAULT_K = 2
DEFAULT_MAX_ITER = 20
DEFAULT_EPSILON = 1e-4
DEFAULT_INIT_STEPS = 2
ONLINE_DECAY = 1.0
ONLINE_RANDOM_WEIGHT = 0.0
KMEANS_BATCH_INTERVAL = "10 seconds"
WORDCOUNT_BATCH_INTERVAL = "20 seconds"
SAMPLE_FRACTION = 0.05
ECHO_ROWS = 10
