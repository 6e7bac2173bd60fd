"""Fixed values the pipeline must share with the original analysis.

Everything in this module is data, not logic: column names, recode lists,
thresholds and workload sizes, written out in their natural order.
"""

from __future__ import annotations

# --- fixed values: position recode (group -> codes), checked in this order ---
POSITION_GROUPS: list[tuple[str, list[str]]] = [
    ("KEYFWD", ["FF", "CHF"]),
    ("BENCH", ["SUB", "INT"]),
    ("KEYBCK", ["FB", "CHB"]),
    ("RUCK", ["RK"]),
]
POSITION_DEFAULT = "GENERAL"

# --- fixed values: calibration curve tail clamps (curve: above, value above) ---
CURVE_CLAMPS = {
    "v1": (2.45, 0.025),
    "v2": (2.80, 0.075),
    "v3": (3.5, 0.975),
}
CURVE_DEGREES = {"v1": 5, "v2": 4, "v3": 5}

# --- fixed values: score bins used by the calibration tables (start, stop, step) ---
BINS_VALIDATION = (-1.0, 2.75, 0.05)
BINS_ONE_TWO = (-1.0, 3.0, 0.1)
BINS_THREE = (-1.0, 4.0, 0.1)

# --- fixed values: bin rows left out of each curve fit (1-based), and the 2-vote anchor ---
FIT_DROP_ROWS = {"v1": [24, 25, 26], "v2": [19, 28, 30, 31, 32, 33, 34], "v3": [29, 30, 31, 36]}
FIT_ANCHOR_V2 = (3.0, 0.05)

# --- fixed values: workload sizes ---
SIMS_BACKTEST = 250
SIMS_SEASON = 10_000      # simulated seasons of a current season
TRAIN_SHARE = 0.3
CV_FOLDS = 3
BOOST_TREES = 500
RARE_LEVEL_SHARE = 0.01
NZV_FREQ_CUT = 95 / 5
NZV_UNIQUE_CUT = 10.0
TOP_BOARD = 20
TOP_PER_TEAM = 3
