"""Fixed values.

These must equal the values the original service uses, otherwise results
differ. They are listed here plainly and together.
"""

# --- event envelope: defaults, a deployment passes its own names -----------------
EVENT_BUS_NAME = "MainBus"                # external bus; only accepted bus name
INTERNAL_BUS_NAME = "InternalCopyBus"     # internal bus (sub-folder copies, job ids)
DETAIL_TYPE = "DataCopySync"              # only accepted detail type
EVENT_SOURCE = "copy.manager"             # source of internal events

# --- fixed values: URIs --------------------------------------------------------
PROJECT_SCHEME = "icav2"                  # project data URIs
OBJECT_SCHEME = "s3"                      # external object URIs
SIZED_SCHEMES = ("s3", "icav2")           # schemes whose sizes can be looked up
# source/external/renaming URI pattern, search semantics (no right anchor)
URI_PATTERN = r"^(icav2|s3)://[a-zA-Z0-9_-]*/[a-zA-Z0-9_/-]*"

# --- fixed values: object model --------------------------------------------------
FILE = "FILE"
FOLDER = "FOLDER"
PARTIAL = "PARTIAL"                       # unfinished file at the destination

# --- fixed values: job states ------------------------------------------------------
NON_TERMINAL_STATES = ("INITIALIZED", "WAITING_FOR_RESOURCES", "RUNNING")
# poll summary: non-terminal -> RUNNING, these -> FAILED, anything else -> SUCCEEDED
POLL_FAILED_STATES = ("STOPPED", "PARTIALLY_SUCCEEDED", "FAILED")
# push handling: SUCCEEDED -> success, non-terminal -> ignored, anything else -> failure
PUSH_SUCCESS_STATE = "SUCCEEDED"
REGISTRY_JOB_ID_TYPE = "JOB_ID"
EXECUTION_RUNNING = "RUNNING"

# --- fixed values: schedule and batching --------------------------------------------
HEARTBEAT_EVERY = "3 minutes"
HEARTBEAT_TIMEOUT_SECONDS = 300           # 5 minutes
HEARTBEAT_BATCH = 50                      # external heartbeats per batch
STATUS_BATCH_WINDOW = "10 seconds"
