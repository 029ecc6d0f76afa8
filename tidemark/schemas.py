"""Column contracts of every layer."""

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VariantType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# Names and types of every column contract below.
# Fields that are not named here (payload, org, ...) never leave bronze.
ENVELOPE = _struct(
    id=StringType(),
    type=StringType(),
    public=BooleanType(),
    created_at=StringType(),
    actor=_struct(id=LongType(), login=StringType()),
    repo=_struct(id=LongType(), name=StringType()),
)
CORRUPT_RECORD = "_corrupt_record"

SILVER_COLUMNS = [
    "event_id",
    "event_type",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "public",
    "created_at",
]
SILVER_REQUIRED = ["event_id", "event_type", "created_at"]
HOUR_COLUMNS = ["event_date", "event_hour"]
# The hour file a row was read from, as opposed to the hour its timestamp falls in.
SOURCE_COLUMNS = ["source_date", "source_hour"]

SILVER = _struct(
    event_id=StringType(),
    event_type=StringType(),
    actor_id=LongType(),
    actor_login=StringType(),
    repo_id=LongType(),
    repo_name=StringType(),
    public=BooleanType(),
    created_at=TimestampType(),
    event_date=DateType(),
    event_hour=IntegerType(),
)
SILVER_WITH_SOURCE = StructType(
    SILVER.fields
    + [StructField("source_date", DateType()), StructField("source_hour", IntegerType())]
)

# Quarantined rows keep the text of lines that could not be parsed.
RAW_TEXT = "raw_text"
QUARANTINE = StructType(
    [*SILVER.fields, StructField(RAW_TEXT, StringType()), *SILVER_WITH_SOURCE.fields[-2:]]
)

FACT_COLUMNS = [
    "event_id",
    "repo_sk",
    "actor_sk",
    "date_key",
    "event_type",
    "event_date",
    "created_at",
]

MARTS = {
    "trending_repos_daily": _struct(
        repo_sk=StringType(),
        repo_id=LongType(),
        repo_name=StringType(),
        stars=LongType(),
        daily_rank=LongType(),
        date_key=LongType(),
    ),
    "language_momentum": _struct(
        language=StringType(),
        event_count=LongType(),
        active_repos=LongType(),
        momentum_delta=LongType(),
        daily_rank=LongType(),
        date_key=LongType(),
    ),
    "contributor_leaderboard": _struct(
        actor_sk=StringType(),
        actor_id=LongType(),
        actor_login=StringType(),
        contributions=LongType(),
        daily_rank=LongType(),
        date_key=LongType(),
    ),
}

SEED = "repo_id BIGINT, language STRING"

RUN_SUMMARY = _struct(
    raw_rows=LongType(),
    hour_rows=LongType(),
    quarantine_rows=LongType(),
    residual_rows=LongType(),
    quarantine_check=BooleanType(),
    residual_check=BooleanType(),
    great_expectations_suite_check=BooleanType(),
    pipeline_check=BooleanType(),
    partition_date=DateType(),
    partition_hour=IntegerType(),
    timestamp=TimestampType(),
)
RUN_COUNTS = ["raw_rows", "hour_rows", "quarantine_rows", "residual_rows"]

TASKS = ArrayType(_struct(task_id=StringType(), state=StringType(), duration=DoubleType()))

RUN_METADATA = StructType(
    [
        StructField("run_id", StringType(), False),
        StructField("recorded_at", TimestampType(), False),
        StructField("logical_date", TimestampType(), False),
        *[StructField(name, LongType()) for name in RUN_COUNTS],
        StructField("tasks", TASKS),
        StructField("run_summary_json", RUN_SUMMARY),
    ]
)

# Run records as they were logged, with what was absent told from what was NULL.
RUN_RECORDS = StructType(
    [
        *[f for f in RUN_METADATA.fields if f.name not in ("tasks", "run_summary_json")],
        StructField("tasks", VariantType()),
        StructField("run_summary_json", VariantType()),
    ]
)

# The event types a dump may contain.
EVENT_TYPES = [
    "CommitCommentEvent",
    "CreateEvent",
    "DeleteEvent",
    "ForkEvent",
    "GollumEvent",
    "IssueCommentEvent",
    "IssuesEvent",
    "MemberEvent",
    "PublicEvent",
    "PullRequestEvent",
    "PullRequestReviewCommentEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewThreadEvent",
    "PushEvent",
    "ReleaseEvent",
    "SponsorshipEvent",
    "WatchEvent",
]

# The event types that count as a contribution, each with the same weight.
CONTRIBUTION_TYPES = [
    "PushEvent",
    "PullRequestEvent",
    "IssuesEvent",
    "PullRequestReviewEvent",
    "PullRequestReviewCommentEvent",
    "IssueCommentEvent",
    "CommitCommentEvent",
    "CreateEvent",
]

# Fixed value: starring a repository arrives as this type.
STAR_TYPE = "WatchEvent"
