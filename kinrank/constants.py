"""Fixed values.

Values that must equal the reference's for the same results, stated once.
Everything else in the package imports them from here.
"""

# Rater quality.
BIASED_MAX_ITEMS = 2             # a user with at most this many items is biased

# Similarity and prediction.
PEARSON_MIN_COMMON = 2           # Pearson needs at least two co-rated items
PEARSON_MIN_STD = 1e-10          # ... and both population stddevs above this
KNN_EPSILON = 1e-8               # added to the weight sum of a k-rater prediction
CLIP_LOW = 0.0                   # predictions are clipped into [low, high]
CLIP_HIGH = 5.0

# Experiment set-ups.
N_NEIGHBOURS = 10                # neighbours per user
THRESHOLD = 0.5                  # similarity a neighbour must exceed
DEMO_THRESHOLD = 0.3             # threshold of the history-aware recommendation
TOP = 5                          # recommendations kept per user
SWEEP = (2, 16)                  # neighbourhood sizes of the RMSE sweep
K_RATERS = 10                    # raters per prediction in k-nearest-rater scoring
N_RECOMMEND = 10                 # catalogue recommendations per user (or item)
ALS_RANK = 6
ALS_REG = 0.001
ALS_ITER = 20
ALS_EPSILON = 1e-8               # loss-change bound of the early-stopping rule
SEED = 42
FRACTIONS = (10, 30, 50, 70, 100)  # evaluation sample sizes, percent

# Our own fixed values (not the reference's): hash split and sample buckets.
SPLIT_USER_MULT = 7919
SPLIT_ITEM_MULT = 104729
SPLIT_BUCKETS = 10
SPLIT_TRAIN_BUCKETS = 8
SAMPLE_USER_MULT = 31
SAMPLE_ITEM_MULT = 17
TEST_PERCENT = 20                # share of each user's cells held out by the exact split
SPLIT_DIGITS = 3                 # hexadecimal digits of a cell's hash that are counted before any is ranked
