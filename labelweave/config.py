"""Settings of the classification engine.

Values under "Fixed values" must equal the behaviour we reproduce; they are
stated plainly and in their natural order.  Everything else is a parameter of
this engine (a design choice), overridable per call.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (semantics of the classification pipeline we reproduce)
# ---------------------------------------------------------------------------
LABELS = [
    "astrophysics",
    "heliophysics",
    "planetary",
    "earthscience",
    "NASA-funded Biophysics",
    "physics",
    "general",
    "Text Garbage",
]
THRESHOLDS = [0.06, 0.03, 0.04, 0.02, 0.99, 0.02, 0.02, 0.99]
RELABEL_ACTIVE = False
RELABEL_THRESHOLD = 0.015
DEFAULT_OPERATION_STEP = "classify_verify"
SCORING_WINDOW = 510
SCORING_STRIDE = 500
SPLITTER_WINDOW = 510
SPLITTER_STRIDE = 255
FILE_INGEST_BATCH_SIZE = 500
CLASSIFY_STAGE_BATCH_SIZE = 100
PRE_FORWARD_BATCH_SIZE = 100
MODEL_INFERENCE_BATCH_SIZE = 16
CLASSIFY_LEASE_S = 300
INDEX_LEASE_S = 120
P95_REGRESSION_LIMIT_PCT = 10.0
MIN_THROUGHPUT_GAIN_PCT = 5.0
PRE_INGEST_OUTPUT_PREFIX = "input-text"
CLS_ID = 101
SEP_ID = 102
PAD_ID = 0
ID_LENGTH = 19
SCIX_PATTERN = r"^scix:[A-Za-z0-9]{4}-[A-Za-z0-9]{4}-[A-Za-z0-9]{4}$"
OUTPUT_HEADER = [
    "bibcode",
    "scix_id",
    "run_id",
    "title",
    "abstract",
    "collections",
    "collection_scores",
    "astrophysics_score",
    "heliophysics_score",
    "planetary_science_score",
    "astronomy_score",
    "earth_science_score",
    "biology_score",
    "physics_score",
    "other_score",
    "general_score",
    "garbage_score",
    "gross_collection",
    "gross_collection_override",
    "override",
]
REQUEST_FIELDS = [
    "bibcode",
    "scix_id",
    "status",
    "title",
    "abstract",
    "operation_step",
    "run_id",
    "override",
    "output_path",
    "scores",
    "collections",
    "collection_scores",
]
RESPONSE_FIELDS = ["bibcode", "scix_id", "status", "collections"]
PERF_NAMED_STAGES = ["task_timing", "app_timing", "classifier_timing", "classifier_batch_shape"]
PER_RECORD_STAGES = ["classify", "index_db"]
FORWARD_STAGES = ["forward", "forward_message"]
CLAIM_STAGES = ["classify_inflight", "classify_done", "index_inflight", "indexed_done"]
STATUS_VALIDATED = "record_validated"
STATUS_PREVIOUSLY_VALIDATED = "record_previously_validated"
STATUS_OTHER_FAILURE = "other_failure"
STATUS_INDEXED = "record_indexed"

# ---------------------------------------------------------------------------
# Engine parameters (design)
# ---------------------------------------------------------------------------
# Token splitter: ASCII letters are lower-cased, runs of ASCII whitespace and
# ASCII punctuation separate tokens, everything else stays inside tokens.
TOKEN_SEPARATORS = r"[\t\n\r !-/:-@\[-`{-~]+"
UPPER_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER_ASCII = "abcdefghijklmnopqrstuvwxyz"
# Hashed linear scorer.
N_BUCKETS = 4096
MODEL_BIAS = [-1.0, -2.0, -2.0, -2.5, -4.0, -1.5, -1.0, -4.0]
MODEL_SCALE = 40.0
# Largest weights table we agree to broadcast (rows = buckets x labels).
MAX_BROADCAST_WEIGHT_ROWS = 1 << 22


@dataclass(frozen=True)
class ClassifierConfig:
    labels: tuple = tuple(LABELS)
    thresholds: tuple = tuple(THRESHOLDS)
    window: int = SCORING_WINDOW
    stride: int = SCORING_STRIDE
    # windows reach the last token; False keeps the source rule of len // stride
    # windows, which leaves up to stride - 1 tokens of a text unscored
    cover_tail: bool = True
    pooling: str = "max"
    select_thresholds: tuple | None = None
    relabel_active: bool = RELABEL_ACTIVE
    relabel_threshold: float = RELABEL_THRESHOLD
    relabel_from: str = "general"
    relabel_to: str = "earthscience"
    micro_batch: int = MODEL_INFERENCE_BATCH_SIZE
    missing_text: str = "None"
    extra: dict = field(default_factory=dict)


DEFAULT = ClassifierConfig()
PARITY = ClassifierConfig(cover_tail=False)
