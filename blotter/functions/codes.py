"""Labels and code lists whose values must equal the source analysis.

FIXED VALUES — these are data, not logic: they must stay exactly as listed,
in this order, for results to agree.
"""

from __future__ import annotations

# --- fixed values: category labels -----------------------------------------
VIOLENT = "Violent"
NON_VIOLENT = "Non-Violent"
OTHER = "Other"
UNKNOWN = "Unknown"
NO_WEAPON_DEFAULT = "No weapon / Unknown"

# --- fixed values: weapon labels meaning "no weapon" (compared lower-cased) --
NO_WEAPON_LABELS = ["no weapon / unknown", "unknown weapon/other weapon", "no weapon", "unknown"]

# --- fixed values: victim sex whitelist -------------------------------------
VICTIM_SEX_VALUES = ["M", "F"]

# --- fixed values: weekday names (date_format pattern "E"), Monday first ----
WEEKDAYS_SHORT = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
WEEKDAYS_FULL = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

# --- fixed values: violence filter choices ----------------------------------
VIOLENCE_ALL = "All"
VIOLENCE_ONLY = "Violent only"
VIOLENCE_NONE = "Non-violent only"

# --- fixed values: macro categories of crime codes --------------------------
# Checked in this order; the first list containing the code wins (236 is in
# two lists and therefore maps to the first one).
MACRO_OTHER = "Other / rare"
MACRO_CATEGORIES: list[tuple[str, list[int]]] = [
    ("Domestic & child-related", [
        626, 236, 901, 902, 900, 903, 812, 627, 235, 237, 813, 870, 922, 954]),
    ("Sexual crimes", [
        121, 122, 815, 820, 821, 810, 760, 830, 840, 850, 860, 762, 814, 805, 806, 822, 921]),
    ("Violent crimes", [
        624, 625, 623, 622, 230, 231, 236, 210, 220, 930, 928, 910, 920, 434, 110, 113, 647,
        435, 436, 753, 251, 250, 755]),
    ("Property crimes", [
        510, 520, 522, 433, 330, 410, 310, 320, 440, 441, 341, 350, 351, 450, 352, 452, 470,
        471, 473, 474, 475, 446, 349, 442, 343, 443, 420, 331, 421, 480, 485, 487, 740, 745,
        648, 354, 662, 664, 666, 668, 670, 649, 660, 653, 654, 651, 652, 951, 950, 347, 661,
        940]),
    ("Public order crimes", [
        888, 886, 890, 884, 882, 880, 933, 932, 437, 438, 439, 949, 353, 453, 432, 926]),
    ("Legal / compliance", [845, 904, 906, 942, 944, 948, 924]),
    ("Weapon-related", [761, 756, 931]),
]
MACRO_VIOLENT = "Violent crimes"

# --- fixed values: analysis thresholds --------------------------------------
Z_THRESHOLD = 3.0
ROLLING_DAYS = 7
NIGHT_HOURS = (0, 5)
MIN_TYPE_COUNT = 50
NIGHT_SHARE_MIN = 0.30
LATE_REPORT_DAYS = 7
LABEL_CHARS = 18
