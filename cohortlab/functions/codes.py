"""Code sets and lookup values.

FIXED VALUES: everything in this module must equal the values the original
cohort definitions use, so that flags and labels come out the same.  They are
kept as plain literals, in their original order; the rest of the library only
reads them.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — ICD-9 prefixes of the sepsis criteria (diagnoses / procedures)
# A code matches a list of k-character entries when substring(code, 1, k) is in it.
# ---------------------------------------------------------------------------

INFECTION_3 = [
    "001", "002", "003", "004", "005", "008", "009", "010", "011", "012", "013", "014", "015", "016", "017", "018",
    "020", "021", "022", "023", "024", "025", "026", "027", "030", "031", "032", "033", "034", "035", "036", "037",
    "038", "039", "040", "041", "090", "091", "092", "093", "094", "095", "096", "097", "098", "100", "101", "102",
    "103", "104", "110", "111", "112", "114", "115", "116", "117", "118", "320", "322", "324", "325", "420", "421",
    "451", "461", "462", "463", "464", "465", "481", "482", "485", "486", "494", "510", "513", "540", "541", "542",
    "566", "567", "590", "597", "601", "614", "615", "616", "681", "682", "683", "686", "730",
]
INFECTION_4 = ["5695", "5720", "5721", "5750", "5990", "7110", "7907", "9966", "9985", "9993"]
INFECTION_5 = ["49121", "56201", "56203", "56211", "56213", "56983"]

EXPLICIT_SEPSIS_5 = ["99592", "78552"]

ORGAN_DYSFUNCTION_3 = ["458", "293", "570", "584"]
ORGAN_DYSFUNCTION_4 = ["7855", "3483", "3481", "2874", "2875", "2869", "2866", "5734"]

MECH_VENT_4 = ["9670", "9671", "9672"]

# criterion name -> {prefix length: codes}
SEPSIS_CODE_SETS = {
    "infection": {3: INFECTION_3, 4: INFECTION_4, 5: INFECTION_5},
    "explicit_sepsis": {5: EXPLICIT_SEPSIS_5},
    "organ_dysfunction": {3: ORGAN_DYSFUNCTION_3, 4: ORGAN_DYSFUNCTION_4},
    "mech_vent": {4: MECH_VENT_4},
}

# ---------------------------------------------------------------------------
# FIXED VALUES — chart item ids of the blood vitals and their labels
# ---------------------------------------------------------------------------

VITAL_ITEM_IDS = [211, 220045, 442, 224167, 228234, 228232, 226329]

ITEM_ID_TO_LABEL = {
    211: "heartRate", 220045: "heartRate", 442: "manualBP", 224167: "manualBP", 228234: "respiration",
    228232: "oxygenSaturation", 226329: "bloodTemperature",
}

# label order used for the wide feature columns (order of first appearance above)
VITAL_LABELS = ["heartRate", "manualBP", "respiration", "oxygenSaturation", "bloodTemperature"]

# ---------------------------------------------------------------------------
# FIXED VALUES — stop words of the note topic model (case-insensitive).
# Duplicates are harmless; "" and "\n" never occur as letter-only tokens.
# ---------------------------------------------------------------------------

NOTE_STOP_WORDS = [
    "were", "number", "year", "old", "number", "status", "report", "contrast", "continue", "history", "well",
    "medical", "icu", "noted", "total", "tablet", "note", "soft", "daily", "", "a", "an", "the", "and", "but", "if",
    "please", "\n", "she", "him", "her", "admission", "to", "on", "with", "for", "in", "was", "of", "it", "from", "is",
    "had", "have", "at", "no", "he", "this", "at", "there", "am", "patient", "hospital", "are", "o", "name", "s",
    "doctor", "as", "not", "mg", "ml", "or", "home", "left", "right", "today", "previous", "dl", "hr", "reason", "w",
    "be", "pm", "c", "pt", "htc", "during", "although", "remain", "small", "within", "gj", "po", "t", "ct", "up",
    "his", "a", "b", "c", "d", "e", "f", "g", "h", "i", "j", "k", "l", "m", "n", "o", "p", "q", "r", "s", "t", "u",
    "v", "w", "x", "y", "z", "imagine", "maybe", "plan", "action", "assesment", "care", "via", "cc", "ef", "rsc",
    "own", "real", "hoping", "mm", "onset", "date", "by", "has", "which", "kg", "due", "seen", "other", "assessed",
    "day", "last", "now", "given", "per", "hx", "bp", "bed", "bedtime", "since", "bs", "tf", "osh", "normal",
    "assessment", "when", "hct", "hours", "will", "needed", "ni", "remains", "meq", "been", "started", "iv", "may",
    "team", "that", "min", "first", "does", "meds", "more", "into", "did", "known", "also", "clip", "prior",
    "present", "clear", "out", "once", "medications", "namepattern", "signs", "lastname", "more", "recent",
    "large", "without", "admitted", "likely", "who", "comments", "labs", "code", "min", "first", "does", "final",
    "allow", "confirm", "goes", "friend", "thought", "perform", "represent", "advice", "former", "initial",
    "extremity", "markedly", "greater", "bfghijk", "dull", "environment", "acknowledge", "addition", "likewise",
    "began", "longest", "exit", "video", "communicated", "targeted", "view", "mmm", "serious", "effectively",
    "able", "however", "after", "end", "see", "put", "follow", "comparison", "all", "spokesperson", "more", "id",
    "done", "whnxcjojqj", "dome", "suddenly", "decisions", "asked", "becoming", "uncle", "oy", "correcting",
    "whom", "showing", "come", "performing", "fix", "arrested", "known", "who", "review", "new", "appears",
    "without", "first", "vs", "clear", "because", "so", "read", "placed", "though", "settings", "temp", "updated",
    "versed", "only", "ends", "looks", "friends", "transfer", "overall", "believe", "shortness", "final",
    "disease", "time", "found",
]

# token pattern of the note tokenizer: runs of letters, matched on lower-cased text
TOKEN_PATTERN = r"\p{L}+"

# ---------------------------------------------------------------------------
# FIXED VALUES — type 1 / type 2 diabetes phenotype criteria
# ---------------------------------------------------------------------------

T1DM_DX = [
    "250.01", "250.03", "250.11", "250.13", "250.21", "250.23", "250.31", "250.33", "250.41", "250.43",
    "250.51", "250.53", "250.61", "250.63", "250.71", "250.73", "250.81", "250.83", "250.91", "250.93",
]

T2DM_DX = [
    "250.3", "250.32", "250.2", "250.22", "250.9", "250.92", "250.8", "250.82", "250.7", "250.72", "250.6",
    "250.62", "250.5", "250.52", "250.4", "250.42", "250.00", "250.02",
]

T1DM_MED = ["lantus", "insulin glargine", "insulin aspart", "insulin detemir", "insulin lente", "insulin nph",
            "insulin reg", "insulin,ultralente"]

# "glucatrol " really ends with a space in the original criteria
T2DM_MED = [
    "chlorpropamide", "diabinese", "diabanase", "diabinase", "glipizide", "glucotrol", "glucotrol xl",
    "glucatrol ", "glyburide", "micronase", "glynase", "diabetamide", "diabeta", "glimepiride", "amaryl",
    "repaglinide", "prandin", "nateglinide", "metformin", "rosiglitazone", "pioglitazone", "acarbose",
    "miglitol", "sitagliptin", "exenatide", "tolazamide", "acetohexamide", "troglitazone", "tolbutamide",
    "avandia", "actos", "actos", "glipizide",
]

DM_DX_RELATED = [
    "790.21", "790.22", "790.2", "790.29", "648.81", "648.82", "648.83", "648.84", "648", "648", "648.01",
    "648.02", "648.03", "648.04", "791.5", "277.7", "V77.1", "256.4", "250.01", "250.03", "250.11", "250.13",
    "250.21", "250.23", "250.31", "250.33", "250.41", "250.43", "250.51", "250.53", "250.61", "250.63",
    "250.71", "250.73", "250.81", "250.83", "250.91", "250.93", "250.3", "250.32", "250.2", "250.22", "250.9",
    "250.92", "250.8", "250.82", "250.7", "250.72", "250.6", "250.62", "250.5", "250.52", "250.4", "250.42",
    "250.00", "250.02",
]

# glucose lab rule: a row is an abnormal reading when its test name is one of
# these and the value crosses the bound (>= for the fasting names, > otherwise)
GLUCOSE_FASTING_NAMES = ["Fasting Glucose", "Fasting blood glucose", "fasting plasma glucose"]
GLUCOSE_PLAIN_NAMES = ["Glucose", "glucose", "Glucose, Serum"]
GLUCOSE_BOUND = 110.0
# a lab row is a glucose test when its name contains one of these
GLUCOSE_NAME_MARKERS = ["glucose", "Glucose"]


def distinct(values):
    """Distinct values, first-seen order (for IN lists and SQL text)."""
    seen = {}
    for v in values:
        seen.setdefault(v, None)
    return list(seen)
