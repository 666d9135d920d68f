"""Fixed values shared by every load."""

# Template tokens.
SOURCE_SYSTEM = "<source-system>"
SOURCE_SYSTEM_DB = "<source_system>"
CLUSTER = "<cluster>"
COUNTRY = "<country>"
LOAD_ID = "<loadid>"
ENTITY = "<entity>"
FOLDER = "<folder>"
FILE = "<file>"

# Names and codes found in the control tables.
LAYER = "Landing"
SUCCESS = "success"
FAILED = "Failed"
ACTIVE = "1"
QUERY_TABLE = "query"

# Response page status codes that fail a pull.
FAILED_RESPONSES = ("FAILURE", "EXCEPTION")

# File formats a landed entity may have.
FORMATS = ("parquet",)

# Endings of folder markers in an object listing.
MARKER_ENDINGS = ("/", "$folder$")

# Text forms of a load id and of the watermarks derived from it.
LOAD_ID_FORMAT = "yyyyMMddHHmmss"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
ENTITY_WATERMARK_SUFFIX = ".000Z"

# Fixed value: slashes a source key needs before it can be mapped to a target.
MIN_KEY_SLASHES = 3

# Upper bound of tasks for scans that touch only file names and footers. Spark
# cuts scans by bytes, which for such a scan means far too many empty tasks.
METADATA_TASKS = 4096

# Names of files the driver holds at a time while an entity lands.
PATHS_PER_READ = 20_000
