"""Names, lists and formats that results depend on."""

# The change-data-capture connector's own columns.
CONNECTOR_PREFIXES = ("_SNOWFLAKE_", "PAYLOAD__", "PRIMARY_KEY__")
CONNECTOR_COLUMNS = (
    "LEAST_SIGNIFICANT_POSITION",
    "MOST_SIGNIFICANT_POSITION",
    "EVENT_TYPE",
    "SEEN_AT",
    "SF_METADATA",
)
VERSION_COLUMN = "_snowflake_updated_at"
DELETED_COLUMN = "_snowflake_deleted"
INSERTED_COLUMN = "_snowflake_inserted_at"

# A dropped column is renamed with this suffix; journal tables carry this infix.
DROP_SUFFIX = "__SNOWFLAKE_DELETED"
JOURNAL_INFIX = "_JOURNAL_"

# Change types, their priority and rank, and the ones that break readers.
NEW_COLUMN = "NEW_COLUMN"
COLUMN_DROP = "COLUMN_DROP"
TYPE_CHANGE = "TYPE_CHANGE"
NEW_TABLE = "NEW_TABLE"
COLUMN_CHANGES = (NEW_COLUMN, COLUMN_DROP, TYPE_CHANGE)
PRIORITY = {
    COLUMN_DROP: ("HIGH", 1),
    TYPE_CHANGE: ("HIGH", 2),
    NEW_COLUMN: ("MEDIUM", 3),
    NEW_TABLE: ("LOW", 4),
}
BREAKING = (COLUMN_DROP, TYPE_CHANGE)

# States of a change event.
PENDING = "PENDING"
IN_PROGRESS = "IN_PROGRESS"
RESOLVED = "RESOLVED"
GENERATING = "GENERATING"
GENERATED = "GENERATED"
PR_OPEN = "PR_OPEN"
CI_PASSED = "CI_PASSED"
CI_FAILED = "CI_FAILED"
LIVE_STATES = (PENDING, IN_PROGRESS)
IN_REVIEW_STATES = (PR_OPEN, CI_PASSED, CI_FAILED)

# Text formats.
PATH_ARROW = " → "
MODEL_ARTIFACT = "dbt_model"
LOOK_BACK_MINUTES = 15
JSON_OPTIONS = {
    "maxStringLen": "2147483647",
    "maxNestingDepth": "2147483647",
    "maxNumLen": "2147483647",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
BRANCH_PREFIX = "schema-change/"
ADDED_COLUMN_NOTE = ("Column added to ", " by schema drift; review/extend tests as needed.")

# White space that a strip takes off both ends.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Patterns over model text.
OPEN_FENCE = r"^```[a-zA-Z]*\n?"
CLOSE_FENCE = r"\n?```$"
FENCED_BLOCK = r"(?s)```[a-zA-Z]*\n(.*?)```"
HEADER_BLOCK = r"(?s)^(\{\{.*?\}\})"
REF_CALL = r"\{\{\s*ref\(\s*['\"](\w+)['\"]\s*\)\s*\}\}"
ANY_SOURCE_CALL = r"\{\{[^}]*source\([^)]*['\"](\w+)['\"]\s*\)\s*\}\}"
SOURCE_CALL_PARTS = r"(\{\{\s*source\(\s*['\"])([^'\"]+)(['\"]\s*,\s*['\"])(\w+)(['\"]\s*\)\s*\}\})"
SOURCE_CALL = r"\{\{\s*source\(\s*['\"](\w+)['\"]\s*,\s*['\"](\w+)['\"]\s*\)\s*\}\}"
CONFIG_BLOCK = r"\{\{[\s]*config\([^}]*\)[\s]*\}\}"
DB_VARIABLE = r"\{\{\s*var\(['\"]db_name['\"]\)\s*\}\}"
REVIEW_NUMBER = r"/pull/(\d+)"
PASS_MARKS = ("OK created", "SUCCESS")
FAIL_MARKS = ("ERROR creating", "Database Error")
CLEAN_RUN_MARK = "ERROR=0"
MODEL_LAYERS = ("SILVER", "GOLD")
