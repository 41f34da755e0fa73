"""Record layouts and fixed values shared by every job."""

from __future__ import annotations

from pyspark.sql import types as T

# Two readings of the same job. INTENDED is the default: what a job is meant to
# compute. REFERENCE keeps every quirk of the jobs this library replaces, so that
# results can be compared row by row during a migration.
INTENDED = "intended"
REFERENCE = "reference"

# They must equal the ones in the existing logs and tables.
MISSING = "-1"
NEW_USER_EVENT = "e_l"
TEST_URLS = ("http://127.0.0.1",)

RAW_FIELDS = (
    "reqSerial", "traceId", "sysId", "sysDesc", "eventName",
    "version", "platformChannel", "channelForm", "deviceNum", "customerId",
    "sessionId", "clientTime", "serverTime", "language", "userAgent",
    "resolution", "ip", "terminalChannel", "domainId", "currentUrl",
    "previousUrl", "title", "orderId", "productId", "amount",
    "category", "action", "duration", "respCode", "memo",
)
PARTITION_COLUMNS = ("day", "hour")
SOURCE_COLUMNS = RAW_FIELDS + PARTITION_COLUMNS
PLATFORM_COLUMNS = (
    "eventId", "deviceNum", "customerId", "sessionId", "serverTime", "ip",
    "channelFrom", "platform", "app_channel", "traffic", "day", "hour",
)
AREA_COLUMNS = (
    "eventId", "deviceNum", "customerId", "sessionId", "serverTime", "ip",
    "ipProvince", "ipCity", "operator", "app_channel", "day", "hour",
)
SESSION_COLUMNS = (
    "deviceNum", "customerId", "sessionID", "startTime", "endTime",
    "entryPage", "leavePage", "visitPageNum", "day", "hour",
)
REPORT_FIELDS = (
    "data_type", "source_name", "source_name_zh", "data_gain_time",
    "task_id", "update_time", "version",
)


def strings(*names: str) -> T.StructType:
    """A schema in which every column is a string."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


SOURCE_SCHEMA = strings(*SOURCE_COLUMNS)
PLATFORM_SCHEMA = strings(*PLATFORM_COLUMNS)
AREA_SCHEMA = strings(*AREA_COLUMNS)
# The page count is text in tables written by the earlier jobs, a number in ours.
SESSION_SCHEMA_REFERENCE = strings(*SESSION_COLUMNS)
SESSION_SCHEMA = T.StructType([
    T.StructField(f.name, T.LongType() if f.name == "visitPageNum" else T.StringType())
    for f in SESSION_SCHEMA_REFERENCE
])


def check_semantics(semantics: str) -> bool:
    """Validate the mode and tell whether it is the reference one."""
    if semantics not in (INTENDED, REFERENCE):
        raise ValueError(f"semantics must be {INTENDED!r} or {REFERENCE!r}, got {semantics!r}")
    return semantics == REFERENCE
