"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

# Shared views.
_VIEWS = """
WITH env AS (
  SELECT cast(e.event_id AS varchar) AS event_id,
         CASE e.event_type WHEN 'click' THEN 'PushEvent' WHEN 'view' THEN 'WatchEvent'
              WHEN 'purchase' THEN 'PullRequestEvent' WHEN 'signup' THEN 'CreateEvent'
              ELSE 'ForkEvent' END AS event_type,
         e.user_id AS actor_id,
         concat('user', cast(e.user_id AS varchar),
                CASE WHEN e.user_id % 5 = 0 AND e.ts >= timestamp '2024-01-16 00:00:00'
                     THEN '_v2' ELSE '' END) AS actor_login,
         e.k AS repo_id,
         concat('org/repo', cast(e.k AS varchar),
                CASE WHEN e.k % 7 = 0 AND e.ts >= timestamp '2024-01-16 00:00:00'
                     THEN '-renamed' ELSE '' END) AS repo_name,
         true AS "public",
         date_trunc('second', e.ts) AS created_at
  FROM (SELECT *, cast(json_extract_string(props, '$.k') AS bigint) AS k FROM events) e
),
stg AS (
  SELECT *, cast(created_at AS date) AS event_date,
         cast(extract(hour FROM created_at) AS integer) AS event_hour
  FROM env
),
fact AS (
  SELECT event_id, md5(cast(repo_id AS varchar)) AS repo_sk,
         md5(cast(actor_id AS varchar)) AS actor_sk,
         cast(strftime(event_date, '%Y%m%d') AS bigint) AS date_key,
         event_type, event_date, created_at
  FROM stg
),
dim_repo AS (
  SELECT md5(cast(repo_id AS varchar)) AS repo_sk, repo_id, repo_name
  FROM stg
  QUALIFY row_number() OVER (PARTITION BY repo_id ORDER BY created_at DESC, repo_name DESC) = 1
),
dim_actor AS (
  SELECT md5(cast(actor_id AS varchar)) AS actor_sk, actor_id, actor_login
  FROM stg
  QUALIFY row_number() OVER (PARTITION BY actor_id ORDER BY created_at DESC, actor_login DESC) = 1
),
seed AS (
  SELECT DISTINCT repo_id, CASE repo_id % 5 WHEN 0 THEN 'Python' WHEN 1 THEN 'Go'
                                WHEN 2 THEN 'TypeScript' ELSE 'Rust' END AS language
  FROM stg WHERE repo_id % 5 <> 3
),
stars AS (
  SELECT date_key, repo_sk, count(*) AS stars
  FROM fact WHERE event_type = 'WatchEvent' GROUP BY ALL
),
trending AS (
  SELECT s.date_key, s.repo_sk, r.repo_id, r.repo_name, s.stars,
         rank() OVER (PARTITION BY s.date_key ORDER BY s.stars DESC) AS daily_rank
  FROM stars s JOIN dim_repo r ON s.repo_sk = r.repo_sk
),
contrib AS (
  SELECT date_key, actor_sk, count(*) AS contributions
  FROM fact
  WHERE event_type IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent', 'PullRequestReviewEvent',
                       'PullRequestReviewCommentEvent', 'IssueCommentEvent',
                       'CommitCommentEvent', 'CreateEvent')
  GROUP BY ALL
),
leaderboard AS (
  SELECT c.date_key, c.actor_sk, a.actor_id, a.actor_login, c.contributions,
         rank() OVER (PARTITION BY c.date_key ORDER BY c.contributions DESC) AS daily_rank
  FROM contrib c JOIN dim_actor a ON c.actor_sk = a.actor_sk
),
enriched AS (
  SELECT f.event_id, f.date_key, f.repo_sk, coalesce(l.language, 'Unknown') AS language
  FROM fact f JOIN dim_repo r ON f.repo_sk = r.repo_sk LEFT JOIN seed l ON r.repo_id = l.repo_id
),
lang_day AS (
  SELECT date_key, language, count(*) AS event_count, count(DISTINCT repo_sk) AS active_repos
  FROM enriched GROUP BY ALL
),
momentum AS (
  SELECT date_key, language, event_count, active_repos,
         event_count - lag(event_count) OVER (PARTITION BY language ORDER BY date_key)
           AS momentum_delta,
         rank() OVER (PARTITION BY date_key ORDER BY event_count DESC) AS daily_rank
  FROM lang_day
),
copies AS (
  SELECT *, 0 AS copy FROM stg
  UNION ALL
  SELECT *, (cast(event_id AS bigint) // 50) % 3 + 1 AS copy
  FROM stg WHERE cast(event_id AS bigint) % 50 = 0
),
flat AS (
  SELECT CASE WHEN e % 211 <> 0 THEN event_id END AS event_id, event_type,
         CASE WHEN e % 173 <> 0 THEN actor_id END AS actor_id,
         CASE WHEN e % 173 <> 0 THEN actor_login || CASE WHEN copy = 2 THEN '_x' ELSE '' END END
           AS actor_login,
         repo_id, repo_name, "public",
         CASE WHEN e % 97 = 0 THEN 'not-a-timestamp'
              ELSE strftime(created_at + CASE WHEN copy = 2 THEN INTERVAL 1 SECOND
                                              ELSE INTERVAL 0 SECOND END, '%Y-%m-%dT%H:%M:%SZ') END
           AS created_at,
         cast(file_time AS date) AS source_date,
         cast(extract(hour FROM file_time) AS integer) AS source_hour
  FROM (SELECT *, cast(event_id AS bigint) AS e,
               created_at + CASE WHEN copy = 3 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END
                 AS file_time
        FROM copies)
),
typed AS (
  SELECT * REPLACE (try_strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at) FROM flat
),
parted AS (
  SELECT *, cast(created_at AS date) AS event_date,
         cast(extract(hour FROM created_at) AS integer) AS event_hour
  FROM typed
),
silver AS (
  SELECT * FROM parted
  QUALIFY event_id IS NULL OR row_number() OVER (
    PARTITION BY source_date, source_hour, event_id
    ORDER BY created_at DESC NULLS LAST, actor_login DESC NULLS LAST) = 1
),
valid AS (
  SELECT * EXCLUDE (source_date, source_hour) FROM silver
  WHERE created_at IS NOT NULL AND event_id IS NOT NULL
),
bad AS (SELECT * FROM silver WHERE created_at IS NULL OR event_id IS NULL),
merged AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (
    PARTITION BY event_id ORDER BY created_at DESC, actor_login DESC NULLS LAST) = 1
),
metrics AS (
  SELECT partition_date, partition_hour, sum(r)::bigint AS raw_rows, sum(h)::bigint AS hour_rows,
         sum(q)::bigint AS quarantine_rows, sum(d)::bigint AS distinct_ids,
         sum(a)::bigint AS actors
  FROM (
    SELECT source_date AS partition_date, source_hour AS partition_hour, 1 AS r, 0 AS h, 0 AS q,
           0 AS d, 0 AS a
    FROM flat
    UNION ALL
    SELECT event_date, event_hour, 0, count(*), 0, count(DISTINCT event_id), count(actor_id)
    FROM valid GROUP BY ALL
    UNION ALL SELECT source_date, source_hour, 0, 0, 1, 0, 0 FROM bad
  ) GROUP BY ALL
),
verdict AS (
  SELECT raw_rows, hour_rows, quarantine_rows,
         raw_rows - hour_rows - quarantine_rows AS residual_rows,
         quarantine_rows = 0 AS quarantine_check,
         raw_rows > 0 AND raw_rows - hour_rows - quarantine_rows >= 0
           AND (raw_rows - hour_rows - quarantine_rows) / raw_rows::double <= 0.1
           AS residual_check,
         hour_rows BETWEEN 2 AND 900000 AND hour_rows = distinct_ids
           AND (hour_rows = 0 OR actors / hour_rows::double >= 0.9999)
           AS great_expectations_suite_check,
         quarantine_check AND residual_check AND great_expectations_suite_check
           AS pipeline_check,
         partition_date, partition_hour, timestamp '2024-02-01 00:00:00' AS "timestamp"
  FROM metrics
),
verdict_table AS (
  SELECT v.* REPLACE (
           b.n AS quarantine_rows, v.raw_rows - v.hour_rows - b.n AS residual_rows,
           b.n = 0 AS quarantine_check,
           v.raw_rows > 0 AND v.raw_rows - v.hour_rows - b.n >= 0
             AND (v.raw_rows - v.hour_rows - b.n) / v.raw_rows::double <= 0.1 AS residual_check,
           b.n = 0 AND v.raw_rows > 0 AND v.raw_rows - v.hour_rows - b.n >= 0
             AND (v.raw_rows - v.hour_rows - b.n) / v.raw_rows::double <= 0.1
             AND v.great_expectations_suite_check AS pipeline_check)
  FROM verdict v, (SELECT count(*) AS n FROM bad) b
),
runs AS (
  SELECT DISTINCT 'scheduled__' || strftime(date_trunc('hour', created_at), '%Y-%m-%dT%H:%M:%S')
           AS run_id,
         date_trunc('hour', created_at) AS logical_date,
         date_trunc('hour', created_at) + INTERVAL 65 MINUTE AS run_start,
         date_trunc('hour', created_at) + INTERVAL 70 MINUTE AS recorded_at
  FROM stg
),
tasks AS (
  SELECT 'scheduled__' || strftime(date_trunc('hour', created_at), '%Y-%m-%dT%H:%M:%S') AS run_id,
         event_type AS task_id,
         CASE WHEN count(*) % 5 = 0 THEN 'failed' ELSE 'success' END AS state,
         CASE WHEN count(*) % 5 <> 0 THEN count(*) * 0.5::double END AS duration
  FROM stg GROUP BY ALL
),
summaries AS (
  SELECT *, partition_date + partition_hour * INTERVAL 1 HOUR
           + CASE WHEN partition_hour % 3 = 0 THEN INTERVAL 60 MINUTE
                  ELSE INTERVAL 66 MINUTE END AS written_at
  FROM verdict
),
fresh AS (
  SELECT r.run_id, r.recorded_at, r.logical_date, s.raw_rows, s.hour_rows, s.quarantine_rows,
         s.residual_rows, s.pipeline_check AS verdict, s.partition_date IS NOT NULL AS is_fresh
  FROM runs r LEFT JOIN summaries s
    ON cast(r.logical_date AS date) = s.partition_date
   AND extract(hour FROM r.logical_date) = s.partition_hour
   AND s.written_at > r.run_start
),
run_tasks AS (
  SELECT run_id, cast(row_number() OVER (PARTITION BY run_id ORDER BY task_id) - 1 AS integer)
           AS pos, task_id, state, duration
  FROM tasks
),
broken AS (
  SELECT DISTINCT run_id FROM tasks WHERE run_id LIKE '%T13:%' AND task_id = 'ForkEvent'
),
logged AS (
  SELECT run_id, cast(row_number() OVER (PARTITION BY run_id ORDER BY task_id) - 1 AS integer) AS pos,
         task_id, 'success' AS state, CASE WHEN kind > 1 THEN n * 0.5::double END AS duration,
         CASE kind WHEN 0 THEN 'absent' WHEN 1 THEN 'null' ELSE 'value' END AS duration_kind
  FROM (
    SELECT 'scheduled__' || strftime(date_trunc('hour', created_at), '%Y-%m-%dT%H:%M:%S') AS run_id,
           event_type AS task_id, count(*) AS n,
           (length(event_type) + max(event_hour) + count(*)) % 4 AS kind
    FROM stg GROUP BY date_trunc('hour', created_at), event_type)
)
"""

_COUNTS = "raw_rows, hour_rows, quarantine_rows, residual_rows"
_STG = (
    "event_id, event_type, actor_id, actor_login, repo_id, repo_name, \"public\", created_at, "
    "event_date, event_hour"
)
_HOURLY_LINES = (
    "SELECT source_date, source_hour, count(*) AS raw_rows FROM flat GROUP BY ALL"
)
_RUN_ROWS = (
    f"SELECT f.run_id, f.recorded_at, f.logical_date, {_COUNTS}, t.pos, t.task_id, t.state, "
    "t.duration FROM fresh f JOIN run_tasks t ON f.run_id = t.run_id"
)
_DOMAIN = (
    "'CommitCommentEvent','CreateEvent','DeleteEvent','ForkEvent','GollumEvent',"
    "'IssueCommentEvent','IssuesEvent','MemberEvent','PublicEvent','PullRequestEvent',"
    "'PullRequestReviewCommentEvent','PullRequestReviewEvent','PullRequestReviewThreadEvent',"
    "'PushEvent','ReleaseEvent','SponsorshipEvent','WatchEvent'"
)
_NULL_COLUMNS = [
    "event_id",
    "event_type",
    "actor_id",
    "actor_login",
    "repo_id",
    "repo_name",
    "public",
    "created_at",
    "event_date",
]


def _nulls(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) AS failures "
        f"FROM {table}"
        for c in columns
    )


def _orphans() -> str:
    known = {
        "repo_sk": "SELECT repo_sk FROM dim_repo WHERE repo_id % 7 <> 3",
        "actor_sk": "SELECT actor_sk FROM dim_actor WHERE actor_id % 7 <> 3",
        "date_key": "SELECT date_key FROM fact WHERE created_at < timestamp '2024-01-20 00:00:00'",
        "event_type": "SELECT event_type FROM fact WHERE event_type <> 'ForkEvent'",
    }
    fks = {
        "fact_events": ("fact", ["repo_sk", "actor_sk", "date_key", "event_type"]),
        "trending_repos_daily": ("trending", ["repo_sk", "date_key"]),
        "language_momentum": ("momentum", ["date_key"]),
        "contributor_leaderboard": ("leaderboard", ["actor_sk", "date_key"]),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS child, '{fk}' AS fk, cast({fk} AS varchar) AS value, count(*) AS n "
        f"FROM {table} WHERE {fk} NOT IN ({known[fk]}) GROUP BY {fk}"
        for name, (table, keys) in fks.items()
        for fk in keys
    )


def _repeats() -> str:
    grains = {
        "trending_repos_daily": ("trending", "date_key, repo_sk"),
        "language_momentum": ("momentum", "date_key, language"),
        "contributor_leaderboard": ("leaderboard", "date_key, actor_sk"),
        "fact_events": ("fact", "date_key, repo_sk"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS failures FROM "
        f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
        for name, (table, keys) in grains.items()
    )


_DIM_DATE = (
    "SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS date_key, d AS full_date, "
    "year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day, "
    "dayofweek(d) + 1 AS day_of_week, strftime(d, '%A') AS day_name, "
    "dayofweek(d) IN (0, 6) AS is_weekend FROM (SELECT cast(unnest(generate_series("
    "timestamp '2024-01-01', timestamp '2024-12-31', INTERVAL 1 DAY)) AS date) AS d)"
)


# The tests declared for each model, written out here so that the code is checked against them.
_DECLARED = {
    "stg_events": {"not_null": "event_id event_type created_at", "unique": "event_id"},
    "repo_languages": {"not_null": "repo_id language", "unique": "repo_id"},
    "dim_event_type": {
        "not_null": "event_type",
        "unique": "event_type",
        "accepted_values": "event_type",
    },
    "dim_repo": {"not_null": "repo_sk repo_id repo_name", "unique": "repo_sk repo_id"},
    "dim_actor": {"not_null": "actor_sk actor_id actor_login", "unique": "actor_sk actor_id"},
    "dim_date": {
        "not_null": "date_key full_date",
        "unique": "date_key full_date",
        "accepted_range": "month:1:12 day_of_week:1:7",
    },
    "fact_events": {
        "not_null": "event_id repo_sk actor_sk date_key event_type",
        "unique": "event_id",
        "relationships": (
            "repo_sk:dim_repo actor_sk:dim_actor date_key:dim_date event_type:dim_event_type"
        ),
    },
    "trending_repos_daily": {
        "not_null": "date_key repo_sk repo_name stars daily_rank",
        "unique_combination": "date_key,repo_sk",
        "relationships": "date_key:dim_date repo_sk:dim_repo",
    },
    "language_momentum": {
        "not_null": "date_key language event_count active_repos daily_rank",
        "unique_combination": "date_key,language",
        "relationships": "date_key:dim_date",
    },
    "contributor_leaderboard": {
        "not_null": "date_key actor_sk actor_login contributions daily_rank",
        "unique_combination": "date_key,actor_sk",
        "relationships": "date_key:dim_date actor_sk:dim_actor",
    },
}


def _failing(test: str, table: str, column: str, tables: dict[str, str]) -> tuple[str, str]:
    """(column name in the result, rows that break the test)."""
    name, *more = column.split(":")
    if test == "not_null":
        return name, f"SELECT 1 FROM {table} WHERE {name} IS NULL"
    if test == "unique":
        return name, (
            f"SELECT {name} FROM {table} WHERE {name} IS NOT NULL GROUP BY {name} HAVING count(*) > 1"
        )
    if test == "unique_combination":
        return name, f"SELECT {name} FROM {table} GROUP BY {name} HAVING count(*) > 1"
    if test == "accepted_values":
        return name, f"SELECT 1 FROM {table} WHERE {name} NOT IN ({_DOMAIN})"
    if test == "accepted_range":
        return name, f"SELECT 1 FROM {table} WHERE {name} NOT BETWEEN {more[0]} AND {more[1]}"
    known = f"SELECT {name} FROM {tables[more[0]]}"
    return name, f"SELECT DISTINCT {name} FROM {table} WHERE {name} NOT IN ({known})"


def _model_tests() -> str:
    """Every declared test as a failure count, over models of which some are broken on purpose."""
    tables = {
        "stg_events": "parted",
        "repo_languages": (
            "(SELECT * FROM seed UNION ALL SELECT * FROM seed WHERE repo_id % 5 = 0)"
        ),
        "dim_event_type": (
            "(SELECT event_type FROM events UNION SELECT event_type FROM stg)"
        ),
        "dim_repo": "(SELECT * FROM dim_repo WHERE repo_id % 7 <> 3)",
        "dim_actor": "(SELECT * FROM dim_actor WHERE actor_id % 7 <> 3)",
        "dim_date": f"(SELECT * FROM ({_DIM_DATE}) WHERE full_date < date '2024-01-20')",
        "fact_events": (
            "(SELECT event_id, md5(cast(repo_id AS varchar)) AS repo_sk, "
            "md5(coalesce(cast(actor_id AS varchar), '_dbt_utils_surrogate_key_null_')) AS actor_sk, "
            "cast(strftime(event_date, '%Y%m%d') AS bigint) AS date_key, event_type FROM parted)"
        ),
        "trending_repos_daily": "trending",
        "language_momentum": "momentum",
        "contributor_leaderboard": "leaderboard",
    }
    counts = []
    for model, tests in _DECLARED.items():
        for test, columns in tests.items():
            for column in columns.split():
                name, rows = _failing(test, tables[model], column, tables)
                counts.append(
                    f"SELECT '{model}' AS model, '{test}' AS test, '{name}' AS column_name, "
                    f"count(*) AS failures FROM ({rows})"
                )
    return " UNION ALL ".join(counts)


_SELECTS = {
    "bronze_json_scan": "SELECT * FROM flat",
    "bronze_line_count": _HOURLY_LINES,
    "silver_hour_slice": (
        f"SELECT {_STG} FROM silver WHERE event_date = date '2024-01-17' AND event_hour = 12"
    ),
    "quarantine_scan": f"SELECT {_STG} FROM silver WHERE created_at IS NULL",
    "seed_scan": "SELECT * FROM seed",
    "run_metadata_scan": (
        f"SELECT run_id, recorded_at, logical_date, {_COUNTS}, "
        "(SELECT count(*) FROM tasks t WHERE t.run_id = f.run_id) AS task_count, verdict "
        "FROM fresh f"
    ),
    "stg_events": "SELECT * FROM stg",
    "silver_partition_path": (
        "SELECT strftime(event_date, 'date=%Y-%m-%d/hour=') || lpad(event_hour::varchar, 2, '0') "
        "AS bronze_path, strftime(event_date, 'event_date=%Y-%m-%d/event_hour=') || event_hour "
        "AS silver_path, strftime(event_date, '%Y%m%d') || lpad(event_hour::varchar, 2, '0') "
        "AS table_partition, count(*) AS n FROM stg GROUP BY event_date, event_hour"
    ),
    "bronze_land": _HOURLY_LINES,
    "silver_partition_overwrite": f"SELECT {_STG} FROM merged",
    "silver_load_hour": f"SELECT {_STG} FROM valid",
    "fact_upsert": "SELECT * FROM fact",
    "mart_table_sink": "SELECT * FROM trending",
    "run_metadata_append": _RUN_ROWS,
    "fact_cluster_layout": (
        "SELECT event_date, event_type, count(*) AS n, max(created_at) AS last_seen "
        "FROM fact GROUP BY ALL"
    ),
    "silver_flatten": "SELECT * FROM flat",
    "silver_typed": "SELECT * FROM typed",
    "silver_partition_columns": "SELECT * FROM parted",
    "silver_quarantine_split": (
        "SELECT source_date, source_hour, "
        "count(*) FILTER (created_at IS NOT NULL AND event_id IS NOT NULL) AS valid_rows, "
        "count(*) FILTER (created_at IS NULL OR event_id IS NULL) AS quarantine_rows "
        "FROM silver GROUP BY ALL"
    ),
    "column_allowlist": "SELECT * EXCLUDE (source_date, source_hour) FROM flat",
    "filter_event_type": "SELECT * FROM fact WHERE event_type = 'WatchEvent'",
    "filter_contribution_types": (
        "SELECT * FROM fact WHERE event_type IN ('PushEvent', 'PullRequestEvent', 'IssuesEvent', "
        "'PullRequestReviewEvent', 'PullRequestReviewCommentEvent', 'IssueCommentEvent', "
        "'CommitCommentEvent', 'CreateEvent')"
    ),
    "fact_watermark_filter": (
        "SELECT * FROM stg WHERE created_at >= (SELECT max(created_at) - INTERVAL 1 HOUR "
        "FROM fact WHERE created_at < timestamp '2024-01-20 00:00:00')"
    ),
    "filter_date_key": "SELECT * FROM fact WHERE date_key = 20240117",
    "default_unknown": (
        "SELECT r.repo_id, coalesce(l.language, 'Unknown') AS language "
        "FROM dim_repo r LEFT JOIN seed l ON r.repo_id = l.repo_id"
    ),
    "join_fact_dim_repo": (
        "SELECT s.date_key, s.repo_sk, r.repo_id, r.repo_name, s.stars "
        "FROM stars s JOIN dim_repo r ON s.repo_sk = r.repo_sk"
    ),
    "join_fact_dim_actor": (
        "SELECT c.date_key, c.actor_sk, a.actor_id, a.actor_login, c.contributions "
        "FROM contrib c JOIN dim_actor a ON c.actor_sk = a.actor_sk"
    ),
    "language_enrichment": "SELECT * FROM enriched",
    "dq_relationships": _orphans(),
    "silver_dedupe": "SELECT * FROM silver",
    "silver_totals": (
        "SELECT count(*) AS total_rows, count(DISTINCT event_id) AS distinct_event_ids FROM flat"
    ),
    "silver_type_breakdown": "SELECT event_type, count(*) AS n FROM silver GROUP BY ALL",
    "dim_event_type": "SELECT DISTINCT event_type FROM stg",
    "stars_per_repo_day": "SELECT * FROM stars",
    "contributions_per_actor_day": "SELECT * FROM contrib",
    "language_day_counts": "SELECT * FROM lang_day",
    "fact_watermark": "SELECT max(created_at) AS watermark FROM fact",
    "hourly_event_counts": (
        "SELECT event_date, event_hour, event_type, count(*) AS n FROM silver GROUP BY ALL"
    ),
    "dim_repo": "SELECT * FROM dim_repo",
    "dim_actor": "SELECT * FROM dim_actor",
    "dim_date": (
        f"SELECT d.*, coalesce(e.n, 0) AS events FROM ({_DIM_DATE}) d LEFT JOIN "
        "(SELECT date_key, count(*) AS n FROM fact GROUP BY ALL) e USING (date_key)"
    ),
    "fact_events": "SELECT * FROM fact",
    "trending_repos_daily": "SELECT * FROM trending",
    "contributor_leaderboard": "SELECT * FROM leaderboard",
    "language_rank": (
        "SELECT *, rank() OVER (PARTITION BY date_key ORDER BY event_count DESC) AS daily_rank "
        "FROM lang_day"
    ),
    "language_momentum": "SELECT * FROM momentum",
    "serve_trending_page": (
        "SELECT date_key, repo_id, repo_name, stars, daily_rank FROM trending "
        "WHERE date_key = 20240117 ORDER BY daily_rank, repo_id DESC LIMIT 20 OFFSET 5"
    ),
    "serve_momentum_page": (
        "SELECT * FROM momentum WHERE date_key = 20240117 "
        "ORDER BY daily_rank, language DESC LIMIT 3 OFFSET 1"
    ),
    "serve_leaderboard_page": (
        "SELECT date_key, actor_id, actor_login, contributions, daily_rank FROM leaderboard "
        "WHERE date_key = 20240117 ORDER BY daily_rank, actor_id DESC LIMIT 20 OFFSET 10"
    ),
    "surrogate_key": (
        "SELECT event_id, md5(cast(repo_id AS varchar)) AS repo_sk, "
        "md5(CASE WHEN event_type <> 'ForkEvent' THEN cast(repo_id AS varchar) "
        "ELSE '_dbt_utils_surrogate_key_null_' END) AS null_repo_sk, "
        "md5(repo_id || '-' || actor_id) AS pair_sk FROM stg"
    ),
    "smart_date_key": (
        "SELECT event_id, cast(strftime(event_date, '%Y%m%d') AS bigint) AS date_key FROM stg"
    ),
    "day_to_date_key": "SELECT * FROM stars WHERE date_key >= 20240117",
    "run_summary_verdict": "SELECT run_id, verdict FROM fresh",
    "run_tasks_array": "SELECT * FROM run_tasks",
    "residual": (
        "SELECT partition_date, partition_hour, raw_rows - hour_rows - quarantine_rows "
        "AS residual_rows FROM metrics"
    ),
    "residual_ok": "SELECT partition_date, partition_hour, residual_check FROM verdict",
    "dq_not_null": _nulls("silver", _NULL_COLUMNS),
    "dq_unique": (
        "SELECT event_id, count(*) AS n FROM flat WHERE event_id IS NOT NULL "
        "GROUP BY event_id HAVING count(*) > 1"
    ),
    "dq_accepted_values": (
        "SELECT event_type, count(*) AS n FROM (SELECT event_type FROM events "
        f"UNION ALL SELECT event_type FROM stg) WHERE event_type NOT IN ({_DOMAIN}) GROUP BY ALL"
    ),
    "dq_accepted_range": " UNION ALL ".join(
        f"SELECT '{name} {low}..{high}' AS check_name, count(*) FILTER (WHERE {expr} "
        f"NOT BETWEEN {low} AND {high}) AS failures FROM stg"
        for name, expr, low, high in [
            ("month", "month(event_date)", 1, 12),
            ("day_of_week", "dayofweek(event_date) + 1", 1, 7),
            ("day_of_week", "dayofweek(event_date) + 1", 2, 6),
        ]
    ),
    "dq_unique_combination": _repeats(),
    "dq_model_tests": _model_tests(),
    "dq_source_freshness": (
        "SELECT m AS max_loaded_at, s AS age_seconds, CASE WHEN s <= 43200 THEN 'pass' "
        "WHEN s <= 86400 THEN 'warn' ELSE 'error' END AS status FROM (SELECT max(created_at) AS m, "
        "date_diff('second', max(created_at), timestamp '2024-01-31 06:00:00') AS s FROM stg)"
    ),
    "dq_columns_match_set": (
        "SELECT count(*) AS row_count, '' AS missing, 'event_date,event_hour' AS unexpected, "
        "false AS success FROM stg"
    ),
    "dq_null_rate_mostly": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count({c}) AS non_null, "
        f"count({c}) / count(*)::double >= 0.9999 AS success FROM silver"
        for c in ["actor_id", "repo_id", "created_at"]
    ),
    "dq_contract_not_null": _nulls("valid", ["event_id", "event_type", "created_at"]),
    "dq_event_id_unique": (
        "SELECT count(event_id) AS n, count(DISTINCT event_id) AS n_distinct, "
        "count(event_id) = count(DISTINCT event_id) AS success FROM flat"
    ),
    "dq_row_count_between": (
        "SELECT count(*) AS row_count, count(*) BETWEEN 50000 AND 900000 AS success FROM silver"
    ),
    "dq_quarantine_zero": (
        "SELECT count(*) AS quarantine_rows, count(*) = 0 AS success FROM bad"
    ),
    "dq_residual": (
        "SELECT r AS raw_rows, h AS hour_rows, q AS quarantine_rows, r - h - q AS residual_rows, "
        "r > 0 AND r - h - q >= 0 AND (r - h - q) / r::double <= 0.0001 AS residual_check "
        "FROM (SELECT (SELECT count(*) FROM flat) AS r, (SELECT count(*) FROM valid) AS h, "
        "(SELECT count(*) FROM bad) AS q)"
    ),
    "dq_suite_verdict": "SELECT * FROM verdict",
    "dq_suite_verdict_table_scope": "SELECT * FROM verdict_table",
    "dq_gate": (
        "SELECT partition_date, partition_hour, quarantine_check, residual_check, "
        "great_expectations_suite_check FROM verdict WHERE NOT pipeline_check"
    ),
    "mart_reconciliation": " UNION ALL ".join(
        f"SELECT '{measure}' AS measure, f AS fact_total, m AS mart_total, f = m AS success "
        f"FROM (SELECT ({fact_side}) AS f, cast(({mart_side}) AS bigint) AS m)"
        for measure, fact_side, mart_side in [
            (
                "stars",
                "SELECT count(*) FROM fact WHERE event_type = 'WatchEvent'",
                "SELECT sum(stars) FROM trending",
            ),
            ("event_count", "SELECT count(*) FROM fact", "SELECT sum(event_count) FROM momentum"),
            (
                "contributions",
                "SELECT count(*) FROM fact WHERE event_type IN ('PushEvent', 'PullRequestEvent', "
                "'CreateEvent')",
                "SELECT sum(contributions) FROM leaderboard",
            ),
            ("repos", "SELECT count(DISTINCT repo_sk) FROM fact", "SELECT count(*) FROM dim_repo"),
        ]
    ),
    "run_metadata_row": _RUN_ROWS,
    "run_summary_freshness": "SELECT run_id, is_fresh, hour_rows FROM fresh",
    "run_history": (
        "SELECT run_id, logical_date, recorded_at, (SELECT count(*) FROM tasks t "
        f"WHERE t.run_id = f.run_id) AS task_count, {_COUNTS}, verdict FROM fresh f "
        "WHERE run_id NOT IN (SELECT run_id FROM broken) ORDER BY recorded_at DESC LIMIT 100"
    ),
    "run_history_errors": (
        "SELECT run_id, 'a task lacks task_id or state' AS reason FROM broken"
    ),
    "silver_totals_from_bitmaps": (
        "SELECT event_date, count(*) AS total_rows, count(DISTINCT event_id) AS distinct_event_ids FROM valid "
        "GROUP BY event_date UNION ALL SELECT NULL, count(*), count(DISTINCT event_id) FROM valid"
    ),
    "run_task_durations": "SELECT run_id, pos, task_id, state, duration, duration_kind FROM logged",
    "run_record_history": (
        f"SELECT run_id, logical_date, recorded_at, l.n AS task_count, l.unknown AS unknown_durations, {_COUNTS}, "
        "verdict FROM fresh f JOIN (SELECT run_id, count(*) AS n, count(*) FILTER (WHERE duration IS NULL) AS unknown, "
        "count(*) FILTER (WHERE duration_kind = 'absent') AS absent FROM logged GROUP BY run_id) l USING (run_id) "
        "WHERE absent = 0 ORDER BY recorded_at DESC LIMIT 100"
    ),
    "run_record_errors": (
        "SELECT run_id, 'tasks[' || cast(min(pos) AS varchar) || '].duration is absent' AS reason "
        "FROM logged WHERE duration_kind = 'absent' GROUP BY run_id"
    ),
}

ORACLE_SQL = {name: f"{_VIEWS}{select}" for name, select in _SELECTS.items()}
