"""Fixed study parameters shared by all operators."""

SEED = 42
START_DATE = "1990-01-01"
TRAIN_FRACTION = 0.70
VALIDATION_FRACTION = 0.15
CV_FOLDS = 5
BOOTSTRAPS = 1000
CONFIDENCE = 0.95
HORIZONS = (7, 14, 21)
PRIMARY_HORIZON = 7
VOL_WINDOWS = (7, 14, 21, 28)
REGIMES = ("low", "medium", "high")

# Rows of one series that are processed together. Window operators never see
# a larger group than this plus their halo, however long a series is.
BLOCK_ROWS = 2048
