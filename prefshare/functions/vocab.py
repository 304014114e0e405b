"""Bucket labels, bin edges and output column prefixes.

These decide the results, so they are stated here once, in natural order.
"""

from __future__ import annotations

# Output column prefix of each attribute.
DURATION_PREFIX = "Package_Duration"
PRICE_PREFIX = "Price"
SIZE_PREFIX = "Package_Size"

# Ordered bin rules (label, comparison, edge): the first rule that holds wins.
# A duration strictly between 15 and 30 matches none and has no bucket.
DURATION_RULES = (
    ("XS", "<=", 1.0),
    ("S", "<", 7.0),
    ("M", "==", 7.0),
    ("L", "<=", 15.0),
    ("XL", ">=", 30.0),
)
PRICE_RULES = (
    ("XS", "<=", 6.44),
    ("S", "<=", 27.62),
    ("M", "<=", 36.0),
    ("L", "<=", 111.0),
    ("XL", ">", 111.0),
)

STEP_LABELS = ("XS", "S", "M", "L", "XL")

# Plan-type labels of the current attribute file.
SIZE_LABELS = (
    "64Kbps", "256Kbps", "384Kbps", "512Kbps",
    "1Mbps", "2Mbps", "4Mbps", "6Mbps",
    "Unlimit_Timed", "Unlimit",
    "Trotting_S", "Trotting_M", "Trotting_L",
    "Qouta_S", "Qouta_M", "Qouta_L",
    "Social", "Entertain",
)

# Plan-type labels of the older attribute file.
OLDER_SIZE_LABELS = (
    "1Mbps", "256Kbps", "2Mbps", "384Kbps", "4Mbps", "512Kbps", "64Kbps", "6Mbps",
    "Entertain", "Full speed", "Game", "Social", "Time",
)

# Plan-type labels reported by the two label scores. 256Kbps is in neither.
QUOTA_LABELS = (
    "Qouta_S", "Qouta_M", "Qouta_L",
    "Trotting_S", "Trotting_M", "Trotting_L",
    "Social", "Entertain",
)
SPEED_LABELS = (
    "64Kbps", "384Kbps", "512Kbps", "1Mbps", "2Mbps", "4Mbps", "6Mbps",
    "Unlimit_Timed", "Unlimit",
)
