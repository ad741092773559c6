"""Fixed values that must equal the reference's for equal results.

Everything here is data (phrase lists, category names, thresholds, grids),
stated plainly and in natural order.  Operators take these as parameter
defaults, so callers can pass their own tables instead.
"""

# ---------------------------------------------------------------- fixed values
# Feature contract: 24 feature columns in model order, then the target.
FEATURE_COLUMNS = [
    "mean_sentiment", "last_20_sentiment", "std_sentiment",
    "talk_time_ratio", "avg_agent_words", "avg_customer_words", "interruption_count",
    "resolution_flag",
    "empathy_density", "apology_count", "transfer_count",
    "duration_ordinal", "duration_deviation", "repeat_contact",
    "intent_billing", "intent_technical", "intent_account", "intent_payment",
    "intent_network", "intent_delivery", "intent_refund", "intent_complaint",
    "intent_subscription", "intent_login",
]
TARGET = "csat_score"

# Allowed range per feature (None = unbounded); the schema-validation rules.
FEATURE_RANGES = {
    "mean_sentiment": (-1.0, 1.0), "last_20_sentiment": (-1.0, 1.0), "std_sentiment": (0.0, 2.0),
    "talk_time_ratio": (0.0, 1.0), "avg_agent_words": (0.0, None), "avg_customer_words": (0.0, None),
    "interruption_count": (0.0, None), "resolution_flag": (0.0, 1.0),
    "empathy_density": (0.0, 1.0), "apology_count": (0.0, None), "transfer_count": (0.0, None),
    "duration_ordinal": (-1.0, 1.0), "duration_deviation": (None, None), "repeat_contact": (0.0, 1.0),
    **{c: (0.0, 1.0) for c in [
        "intent_billing", "intent_technical", "intent_account", "intent_payment", "intent_network",
        "intent_delivery", "intent_refund", "intent_complaint", "intent_subscription", "intent_login"]},
}

# Feature groups used by the ablation studies.
FEATURE_GROUPS = {
    "A_sentiment": ["mean_sentiment", "last_20_sentiment", "std_sentiment"],
    "B_structure": ["talk_time_ratio", "avg_agent_words", "avg_customer_words",
                    "interruption_count", "resolution_flag"],
    "C_agent": ["empathy_density", "apology_count", "transfer_count"],
    "D_metadata": ["duration_ordinal", "duration_deviation", "repeat_contact",
                   "intent_billing", "intent_technical", "intent_account", "intent_payment",
                   "intent_network", "intent_delivery", "intent_refund", "intent_complaint",
                   "intent_subscription", "intent_login"],
}

# The ten intents of the one-hot encoding, in feature order.
INTENTS = ["billing", "technical", "account", "payment", "network",
           "delivery", "refund", "complaint", "subscription", "login"]

# Issue-type aliases accepted at scoring time -> intent.
ISSUE_ALIASES = {
    "account_access": "account", "billing_error": "billing", "complaint": "complaint",
    "delivery": "delivery", "login": "login", "network": "network", "payment": "payment",
    "refund": "refund", "subscription": "subscription", "technical_support": "technical",
    "account": "account", "billing": "billing", "technical": "technical",
}

# Turn-level phrase lists (lower-case substring tests).
RESOLUTION_PHRASES = ["issue resolved", "that's been sorted", "all set", "fixed that for you",
                      "you're good to go"]
EMPATHY_PHRASES = ["i understand", "i can see why", "i appreciate your patience",
                   "i'm sorry to hear", "that must be frustrating", "i completely understand"]
APOLOGY_PHRASES = ["sorry", "apologise"]
TRANSFER_PHRASES = ["transfer you", "pass you to", "connect you with", "another department",
                    "specialist"]

# Transcript-level 4-vector words.
TRANSCRIPT_REPEAT_PHRASE = "called before"
TRANSCRIPT_TRANSFER_WORD = "transfer"
TRANSCRIPT_EMPATHY_WORDS = ["sorry", "understand", "apologize", "inconvenience"]

# Keyword arc (last 300 characters).
ARC_POSITIVE_END = ["thank you", "resolved", "all set", "appreciate", "sorted"]
ARC_NEGATIVE_END = ["still not", "not fixed", "frustrated", "again"]
ARC_TAIL_CHARS = 300

# Phrase-evidence patterns (line based).  The transfer list is lower-cased
# here so every pattern can match lower-cased lines.
EVIDENCE_REPEAT = ["called before", "last time", "still not fixed", "called last week",
                   "again calling"]
EVIDENCE_TRANSFER = ["transfer you", "connect you", "hold while i transfer", "forward your call"]
EVIDENCE_EMPATHY = ["sorry", "understand", "apologize", "inconvenience", "frustrating"]
EVIDENCE_FEATURES = ["repeat_contact", "transfer_count", "final_sentiment", "empathy_density"]
EVIDENCE_MAX_PER_SIDE = 3

# Synthetic timestamps: total seconds per duration label.
DURATION_TOTAL_SECONDS = {"short": 180, "medium": 300, "long": 480}
DEFAULT_TOTAL_SECONDS = 300

# Duration rules.
DURATION_ORDINAL_TRAIN = (240, 420)     # <=240 -> -1, <=420 -> 0, else 1
DURATION_ORDINAL_CRM = (180, 600)       # <180 -> -1, >600 -> 1, else 0
DURATION_BINS = (0, 240, 390)           # (0,240] short, (240,390] medium, >390 long
DURATION_LABEL_ORDINAL = {"short": -1, "medium": 0, "long": 1}

# Accepted spellings of a true repeat-contact flag.
REPEAT_TRUE = ["yes", "true", "1", "1.0"]

# Score bands and the binary satisfaction threshold.
BAND_AT_RISK, BAND_SATISFACTORY = 2.5, 3.5
SATISFIED_THRESHOLD = 3.0
CSAT_MIN, CSAT_MAX = 1.0, 5.0

# Portfolio CSAT buckets.
CSAT_BUCKETS = [("low_1_to_2.5", None, 2.5), ("medium_2.5_to_3.5", 2.5, 3.5),
                ("high_3.5_to_5", 3.5, None)]

# Arc thresholds.
ARC_DIFF = 0.15
ARC_A_DIP = 0.1
ARC_B_DIP, ARC_B_RECOVER = 0.15, 0.05

# Sentiment scoring constants (rule-based lexicon scorer, Hutto & Gilbert 2014).
NEGATION_SCALAR = -0.74
BOOSTER_INCREMENT = 0.293
MODIFIER_FADE = (1.0, 0.95, 0.9)     # a booster one, two, three tokens before
CAPITALS_INCREMENT = 0.733
CONTRAST_BEFORE, CONTRAST_AFTER = 0.5, 1.5
EXCLAMATION_INCREMENT, EXCLAMATION_MAX = 0.292, 4
QUESTION_INCREMENT, QUESTION_MANY = 0.18, 0.96   # two or three; more
NORMALISATION_ALPHA = 15.0

# Model search spaces.
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 10.0, 100.0]
RF_GRID = [{"numTrees": n, "maxDepth": d, "minInstancesPerNode": leaf}
           for n in (100, 200, 500) for d in (None, 10, 20) for leaf in (1, 5, 10)]
RF_UNLIMITED_DEPTH = 30
RF_BEST = {"numTrees": 200, "maxDepth": 10, "minInstancesPerNode": 5}
ENSEMBLE_CANDIDATES = [
    {"ridge": 1 / 3, "rf": 1 / 3, "text": 1 / 3},
    {"ridge": 0.5, "rf": 0.3, "text": 0.2},
    {"ridge": 0.4, "rf": 0.4, "text": 0.2},
    {"ridge": 0.3, "rf": 0.5, "text": 0.2},
    {"ridge": 0.5, "rf": 0.5, "text": 0.0},
    {"ridge": 0.6, "rf": 0.4, "text": 0.0},
]
INTERVAL_MEMBERS = ("ridge", "rf")   # the report's interval
DEFAULT_WEIGHTS = {"ridge": 0.5, "rf": 0.5, "text": 0.0}
SPLIT_FRACTIONS = (0.70, 0.85)   # cumulative: train <= .70 < val <= .85 < test
SEED = 42

# Turn segments of a transcript; inline flags as in Java (i: any case, s: dot-all, U: Unicode classes).
TURN_PATTERN = r"(?isU)Turn\s*(\d+)\s*:\s*(AGENT|CUSTOMER)\s*:\s*(.*?)(?=Turn\s*\d+\s*:|$)"

# Portfolio insight sentences.
INSIGHT_WORST = "%s scores %d%% below average — consider a dedicated escalation path."
INSIGHT_REPEAT = "%s has the highest repeat-contact rate (%d%%) — first-call resolution is failing here."
INSIGHT_ARC = "Calls that end on a positive note score %.1f points higher than declining calls — how a call ends matters most."

# Display names.
FEATURE_LABELS = {
    "repeat_contact": "Repeat Contact", "transfer_count": "Transfers",
    "empathy_density": "Empathy Density", "last_20_sentiment": "Call Ending Sentiment",
    "mean_sentiment": "Mean Sentiment", "std_sentiment": "Sentiment Volatility",
    "talk_time_ratio": "Agent Talk Ratio", "apology_count": "Apologies",
    "resolution_flag": "Resolution Signal", "interruption_count": "Interruptions",
    "duration_ordinal": "Call Duration", "duration_deviation": "Duration vs Avg",
    "avg_agent_words": "Agent Words/Turn", "avg_customer_words": "Customer Words/Turn",
}
ARC_LABELS = {"rise": "Improving", "fall": "Declining", "flat": "Stable", "v_shape": "Recovered"}

# Coaching sentence templates, in rule order.
COACH_NEGATIVE = [("called", 'Customer frustration detected: "{}"'),
                  ("transfer", 'Multiple transfers may have impacted experience: "{}"'),
                  ("frustrating", 'Customer dissatisfaction increased: "{}"')]
COACH_NEGATIVE_DEFAULT = 'Potential issue detected: "{}"'
COACH_POSITIVE = [("sorry", 'Agent showed empathy: "{}"'),
                  ("understand", 'Agent acknowledged customer concern: "{}"')]
COACH_POSITIVE_DEFAULT = 'Positive interaction: "{}"'

# Columns that must never reach a model (target leakage).
LEAKAGE_COLUMNS = ["csat_score", "csat_range", "emotional_arc"]
# ----------------------------------------------------------- end fixed values
