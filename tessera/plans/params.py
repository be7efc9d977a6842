"""Parameters of the catalog queries (seeds, fractions, thresholds).

Reference-equal values are marked; the rest are seeds and fixture choices.
"""

# Fixed values from the reference: split fractions, resampling constants,
# correlation threshold, quantile probabilities, top-k sizes, weight buckets.
STRAT_FRAC = 0.8
TRAIN_FRAC = 0.7
REPAIR_FRAC = 0.7
# Kept share of the majority label, in units of the minority's share of the rows.
DOWNSAMPLE_FACTOR = 4.0
UPSAMPLE_N = 15
UPSAMPLE_P = 10 / 15
CORR_THRESHOLD = 0.8
QUANTILE_PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)
QUANTILE_REL_ERR = 0.05
RECOMMEND_K = 5
RANKING_K = 10
SWEEP_THRESHOLDS = (0.2, 0.3, 0.4, 0.5)
WEIGHT_BUCKETS = {0.3: [0], 5.0: [8, 9, 10, 11, 12, 13, 14, 15, 16], 10.0: [17, 18, 19, 20]}
WEIGHT_DEFAULT = 1.0

# Fixture choices (not from the reference).
GENRE_POSITIVE = "Brand#1"
HISTOGRAM_WIDTH = 100.0
TOP_ROWS_N = 20
TOP_PER_USER = 3
LOOKUP_USER = "U000000007"
LIST_LOOKUP_USER = "U000000057"
# Parts of the data that have a state each.
STATE_PARTS = 16
# Share of users held out entirely (cold users), so coverage repair has work.
COLD_USER_FRAC = 0.1

SPLIT_SEED = 42
COLD_SEED = 29
STRAT_SEED = 11
REPAIR_SEED = 13
SAMPLE_SEED = 17
SCORE_SEED = 19
MODEL_SEED = 23
