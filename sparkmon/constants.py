"""Fixed values of the plant model, the thresholds and the report vocabulary."""

# Nominal envelope (mean, std) and spec band (lo, hi) per sensor.
SENSOR_SPECS = {
    "temperature_c": {"mean": 62.0, "std": 6.0, "lo": 10.0, "hi": 120.0},
    "vibration_mm_s": {"mean": 2.8, "std": 0.7, "lo": 0.0, "hi": 20.0},
    "spindle_load_pct": {"mean": 68.0, "std": 12.0, "lo": 0.0, "hi": 100.0},
    "power_kw": {"mean": 22.0, "std": 5.0, "lo": 0.0, "hi": 80.0},
    "acoustic_db": {"mean": 78.0, "std": 4.0, "lo": 40.0, "hi": 120.0},
}
SENSORS = list(SENSOR_SPECS)

# Fault signatures (sensor shifts); declaration order breaks score ties.
FAULTS = {
    "bearing_wear": {"vibration_mm_s": 6.0, "acoustic_db": 9.0, "temperature_c": 8.0},
    "spindle_overheat": {"temperature_c": 28.0, "spindle_load_pct": 18.0, "power_kw": 12.0},
    "tool_wear": {"spindle_load_pct": 22.0, "power_kw": 9.0, "acoustic_db": 7.0},
    "coolant_loss": {"temperature_c": 18.0, "vibration_mm_s": 3.0},
}
NO_FAULT = "general"

# Guide that explains each fault (other causes are found by retrieval).
FAULT_GUIDES = {
    "bearing_wear": "bearing_wear",
    "spindle_overheat": "spindle_overheat",
    "tool_wear": "tool_wear",
    "coolant_loss": "coolant_loss",
}

# Words a sensor contributes to the retrieval query.
SENSOR_KEYWORDS = {
    "temperature_c": "temperature heat",
    "vibration_mm_s": "vibration",
    "spindle_load_pct": "spindle load",
    "power_kw": "power draw",
    "acoustic_db": "acoustic noise",
}

# Plant dimensions.
SITES = ["Zurich", "Basel", "Geneva"]
MACHINE_TYPES = ["CNC_Mill", "Lathe", "Hydraulic_Press", "Surface_Grinder"]
CATEGORICAL = ["machine_type", "site"]

# Stream settings, thresholds and model settings.
WINDOW = "1 minute"
WATERMARK = "2 minutes"
MAX_FILES_PER_TRIGGER = 3
EVENTS_PER_FILE = 500
ALERT_PROB_THRESHOLD = 0.60
WARNING_PROB = 0.75
CRITICAL_PROB = 0.90
ELEVATED_Z = 1.0
DRIFT_Z_THRESHOLD = 1.0
SEED = 42
TRAIN_FRACTION = 0.8
GBT_ITERATIONS = 20
GBT_BINS = 32
GBT_DEPTHS = [3, 5]
CV_FOLDS = 3
CV_PARALLELISM = 2

# Report wording.
MODEL_NAME = "GBTClassifier (Spark MLlib Pipeline)"
NO_SYMPTOM = "multiple sensors elevated"
ACTION_HEADING = "recommended action"
ACTION_FALLBACK_CHARS = 300
PREVIEW_CHARS = 160
TOP_SYMPTOMS = 3
TOP_INCIDENTS = 4
TAIL_BATCHES = 3

# Default English function words; every retrieval operator takes another list as a parameter.
STOP_WORDS = """
a about above after again against all almost also although am among an and another any are as at
be because been before being below between both but by can cannot could did do does doing down
during each either else ever every few for from further had has have having he her here hers him
his how however if in into is it its itself just least less many may me might more most much must
my neither never no nor not now of off often on once one only or other others our out over own
part per perhaps put quite rather same see several shall she should since so some still such than
that the their them then there therefore these they this those though through thus to together
too toward under until up upon us very was we well were what when where whether which while who
whole whom whose why will with within without would yet you your
""".split()
