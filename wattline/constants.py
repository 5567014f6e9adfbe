"""Names used across the tables, and the fixed values of the domain."""

from __future__ import annotations

KEYS = ["CONS_ID", "CSQ"]
REMARKS = "REMARKS"
ROW_ORDER = "row_order"

CONSUMER_COLUMNS = ["CONS_ID", "CSQ", "CNO", "MNO", "MCD", "FDT", "XCHG", "ADV"]
CONSUMPTION_COLUMNS = ["CONS_ID", "CSQ", "MNO", "BC_CD", "BL_CD", "ENT_CD", "ADV_UT"]
REPORT_COLUMNS = ["CONS_ID", "CSQ", "CNO", "MNO", "TD REMARKS"]
METER_LIFE_COLUMNS = [
    "CONS_ID", "CSQ", "MNO", "MCD", "adv_ut_list", "bl_cd_list", "ent_cd_list", "is_current_meter",
]
MODEL_PROPERTIES = ["MFG", "AMP", "VLT", "SUP", "SMT", "ELC"]
REJECT_COLUMNS = ["CONS_ID", "CSQ", "CNO", "MNO", REMARKS]
BASE_COLUMNS = ["CONS_ID", "CSQ", "CNO", "MNO", "MCD", *MODEL_PROPERTIES, "defect_range", "LABEL"]
RAW_COLUMNS = [
    "CONS_ID", "CSQ", "CNO", "MNO", "MCD", *MODEL_PROPERTIES,
    "adv_ut_list", "ent_cd_list", "defect_range", "LABEL",
]
Z_COLUMNS = ["z_score_0", "z_score_1", "z_score_2", "z_score_3", "z_score_4", "z_score_5"]
STAT_COLUMNS = [
    *Z_COLUMNS, "max_abs_zscore", "max_residual_zscore",
    "max_consumption", "min_consumption", "consumption_range",
]
WEIGHT_COLUMNS = ["electronic_weight", "electromechanical_weight", "common_weight"]
CATEGORICAL_FEATURES = list(MODEL_PROPERTIES)
NUMERIC_FEATURES = [*STAT_COLUMNS, *(f"{c}_normalized" for c in WEIGHT_COLUMNS)]

# Thresholds and list lengths.
SERIES_TAIL = 36
SHORT_SERIES = 5
MISSING_RATIO_LIMIT = 0.6
LOW_MAX = 1.0
FLAT_STD = 1e-8
NO_RESIDUAL = -99.0
SIGMOID_STEEPNESS = 6.0

# The reasons a consumer is turned away.
# The short-series text says 4, but the threshold has always been SHORT_SERIES.
NO_CONSUMPTION = "Consumer with no consumption data."
MISSING_FDT = "Consumer without FDT value."
DIFFERENT_MNO = "Consumer with different MNO in Master & Consumption."
DEFECT_RANGE = "Consumer with MNO in Defect Range."
LESS_CONSUMPTION = "Consumer with less than 4 consumption."
UNSUPPORTED_MCD = "Consumer with non supported MCD value."

# Marks rows that leave without a reject record.
SILENT_LOW_MAX = "silent: largest reading too low"
SILENT_SPARSE = "silent: too many missing readings"
SILENT_REASONS = [SILENT_LOW_MAX, SILENT_SPARSE]

# Inspector remarks.
REMARK_OK = "METER OK"
REMARK_DEFECTIVE = "METER DEFECTIVE"
REMARK_OTHER_METER_OK = "DIFFERENT METER AT SITE: METER OK"

# Consumer-number prefixes of the two- and three-month billing cycles.
BIMONTHLY_PREFIX = "011"
TRIMONTHLY_PREFIX = "88"

# Meter models the classifier supports.
SUPPORTED_MCD = [
    102, 103, 112, 114, 120, 121, 125, 126, 140, 141, 142, 143, 145, 146, 147, 150, 151, 152, 153,
    155, 212, 401, 402, 403, 404, 405, 406, 407, 408, 409, 410, 411, 412, 413, 421, 423, 425, 431,
    432, 515, 516, 549, 550, 551, 560, 561, 562, 564, 565, 566, 567, 568, 569, 571, 572, 573, 574,
    575, 576, 577, 578, 580, 581, 582, 585, 586, 587, 589, 590, 591, 595, 596, 598, 599, 600, 601,
    602, 603, 604, 605, 606, 607, 608, 609, 617, 621, 634, 637, 639, 641, 680, 681, 682, 800, 802,
    803, 804, 805, 806, 807, 809, 812, 815, 821, 823, 824, 825, 827, 828, 829, 834, 836, 837, 838,
    839, 840, 841, 855, 857, 869, 870, 884, 896, 898, 899, 901, 905, 906, 907, 911, 912, 917, 918,
]

# Rule weights. The first two names are swapped against the meter type their rules
# test; the numbers are what the model was trained on, so they stay.
ELECTRONIC_WEIGHTS = {"t_1_c_1": 0.35, "t_1_c_2": 0.25, "t_1_c_3": 0.39}
ELECTROMECHANICAL_WEIGHTS = {"t_2_c_1": 0.45, "t_2_c_2": 0.55, "t_2_c_3": 0.3}
COMMON_WEIGHTS = {"t_a_c_1": 0.32, "consecutive_NR": 0.35}

# Integer weights of the older score.
SCORE_WEIGHTS = {
    "t_1_c_1": 4, "t_1_c_2": 6, "t_1_c_3": 5, "t_2_c_1": 8, "t_2_c_2": 10, "t_2_c_3": 4,
    "t_2_c_4": 3, "t_a_c_1": 7,
}

# Mean and standard deviation of each weight, for scoring.
FIXED_WEIGHT_STATS = {
    "electronic_weight": (0.0235, 0.1051),
    "electromechanical_weight": (0.0352, 0.1106),
    "common_weight": (0.0269, 0.1001),
}

# Last-reading codes that fire the common rule, and the serials of rule t_2_c_4.
BAD_LAST_CODES = ["LCC", "NR", "Read"]
SUSPECT_SERIALS = (7000001, 7097000)

# Upper edge and name of each score bin (left-closed).
SCORE_BINS = [
    (0.1, "0-0.1"), (0.2, "0.1-0.2"), (0.3, "0.2-0.3"), (0.4, "0.3-0.4"), (0.5, "0.4-0.5"),
    (0.6, "0.5-0.6"), (0.7, "0.6-0.7"), (0.8, "0.7-0.8"), (0.9, "0.8-0.9"), (1.0, "0.9-1.0"),
]

# Texts a CSV cell may hold instead of a value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
