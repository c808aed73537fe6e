"""The same results in plain SQL over the given tables, for the correctness comparison.

`SOURCES` derives the three inputs from the given tables and `MODELS` builds on them, both as chains of
named subqueries that every statement starts with; a statement uses what it needs. Integer sums are cast to BIGINT, since the SQL engine widens them, and means are rounded like
those of the queries.
"""

from __future__ import annotations

SOURCES = """
people AS (
    SELECT c.c_custkey AS user_id,
           DATE '2023-06-01' + CAST(c.c_custkey * 13 % 200 AS INTEGER) AS signup_date,
           n.n_name AS country
    FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
),
shows AS (
    SELECT p_partkey AS episode_id, p_brand AS podcast_id, p_name AS title,
           DATE '2023-07-01' + CAST(p_partkey * 37 % 400 AS INTEGER) AS release_date,
           CAST(300 + 100 * p_size AS BIGINT) AS duration_seconds
    FROM part
),
kinds AS (
    SELECT event_id AS e, user_id AS u, ts, value, props,
           CASE WHEN user_id % 50 = 3 THEN 'seek'
                WHEN event_type = 'view' THEN 'play'
                WHEN event_type = 'purchase' THEN 'complete'
                WHEN event_type = 'click' THEN 'pause'
                WHEN event_type = 'signup' THEN 'seek'
                ELSE 'download' END AS kind
    FROM events
),
single_log AS (
    SELECT e,
           CASE WHEN e % 197 <> 5 THEN kind END AS event_type,
           CASE WHEN e % 83 <> 5 THEN u END AS user_id,
           CASE WHEN e % 109 = 5 THEN NULL
                WHEN u % 50 = 11 THEN u % 100
                ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS episode_id,
           CASE WHEN e % 181 = 5 OR e % 415 = 5 THEN NULL
                WHEN e % 277 = 5 OR e % 830 = 88 THEN 'malformed-date'
                ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_timestamp_raw,
           CASE WHEN kind IN ('play', 'complete') AND e % 331 <> 6
                THEN CAST(1 + floor(20 * value) AS BIGINT) END AS duration
    FROM kinds
),
log AS (
    SELECT * EXCLUDE (e) FROM single_log
    UNION ALL
    SELECT * EXCLUDE (e) FROM single_log WHERE e % 499 = 0
)"""

MODELS = """
once AS (
    SELECT event_type, user_id, episode_id, event_timestamp_raw, duration, count(*) AS copies
    FROM log GROUP BY ALL
),
parsed AS (
    SELECT md5(coalesce(length(event_type) || ':' || event_type, 'n') ||
               coalesce(length(CAST(user_id AS VARCHAR)) || ':' || CAST(user_id AS VARCHAR), 'n') ||
               coalesce(length(CAST(episode_id AS VARCHAR)) || ':' || CAST(episode_id AS VARCHAR), 'n') ||
               coalesce(length(event_timestamp_raw) || ':' || event_timestamp_raw, 'n') ||
               coalesce(length(CAST(duration AS VARCHAR)) || ':' || CAST(duration AS VARCHAR), 'n')) AS event_id,
           *, TRY_CAST(event_timestamp_raw AS TIMESTAMP) AS event_datetime
    FROM once
),
flagged AS (
    SELECT *,
           event_type IS NULL AS is_missing_event_type,
           user_id IS NULL AS is_missing_user_id,
           episode_id IS NULL AS is_missing_episode_id,
           event_timestamp_raw IS NULL AS is_missing_timestamp,
           event_timestamp_raw IS NOT NULL AND event_datetime IS NULL AS is_malformed_timestamp,
           duration IS NULL AND event_type IS NOT NULL AND event_type IN ('play', 'complete')
               AS is_missing_duration
    FROM parsed
),
staged AS (
    SELECT *,
           len(reasons) > 0 AS is_rejected,
           CAST(len(reasons) AS BIGINT) AS rejection_reason_count,
           array_to_string(reasons, ', ') AS rejection_reason_summary
    FROM (
        SELECT *, list_filter([
                   CASE WHEN is_missing_event_type THEN 'missing_event_type' END,
                   CASE WHEN is_missing_user_id THEN 'missing_user_id' END,
                   CASE WHEN is_missing_episode_id THEN 'missing_episode_id' END,
                   CASE WHEN is_missing_timestamp THEN 'missing_timestamp' END,
                   CASE WHEN is_malformed_timestamp THEN 'malformed_timestamp' END,
                   CASE WHEN is_missing_duration THEN 'missing_duration' END],
               lambda r: r IS NOT NULL) AS reasons
        FROM flagged)
),
quarantine AS (SELECT * FROM staged WHERE is_rejected),
catalogue AS (
    SELECT *, round(CAST(duration_seconds AS DOUBLE) / 60, 1) AS duration_minutes,
           CAST(year(release_date) AS BIGINT) AS release_year,
           CAST(month(release_date) AS BIGINT) AS release_month,
           CASE WHEN duration_seconds >= 2700 OR duration_seconds IS NULL THEN 'long'
                WHEN duration_seconds >= 1200 THEN 'medium' ELSE 'short' END AS episode_length_bucket
    FROM shows
),
fact AS (
    SELECT *, CASE WHEN is_listen_event AND episode_duration_seconds <> 0
                   THEN CAST(duration_capped_seconds AS DOUBLE) / episode_duration_seconds END
              AS listen_through_rate
    FROM (
        SELECT s.event_id, s.user_id, s.episode_id, s.event_type, s.event_datetime,
               CAST(s.event_datetime AS DATE) AS event_date,
               CAST(year(s.event_datetime) AS BIGINT) AS event_year,
               CAST(month(s.event_datetime) AS BIGINT) AS event_month,
               CAST(hour(s.event_datetime) AS BIGINT) AS event_hour_of_day,
               dayname(s.event_datetime) AS event_day_of_week,
               s.duration AS duration_raw_seconds,
               CASE WHEN s.duration > c.duration_seconds THEN c.duration_seconds ELSE s.duration END
                   AS duration_capped_seconds,
               s.duration IS NOT NULL AND s.duration > c.duration_seconds AS duration_exceeds_episode_length,
               s.event_type IN ('play', 'complete') AS is_listen_event,
               coalesce(CAST(s.event_datetime AS DATE) < c.release_date, FALSE) AS is_before_episode_release,
               c.duration_seconds AS episode_duration_seconds,
               c.podcast_id, c.episode_length_bucket, c.title
        FROM staged s LEFT JOIN catalogue c USING (episode_id)
        WHERE NOT s.is_rejected)
),
listens AS (SELECT * FROM fact WHERE is_listen_event),
daily AS (
    SELECT user_id, event_date, count(DISTINCT episode_id) AS distinct_episodes,
           count(*) AS total_listen_events
    FROM listens GROUP BY user_id, event_date
),
engagement AS (
    SELECT p.user_id, p.country, p.signup_date,
           a.events AS total_valid_events,
           CASE WHEN a.events IS NOT NULL THEN coalesce(h.listens, 0) END AS total_listen_events,
           h.episodes AS distinct_episodes_listened,
           h.podcasts AS distinct_podcasts_listened,
           h.seconds AS total_capped_listen_seconds,
           h.rate AS avg_listen_through_rate,
           a.first_day AS first_event_date,
           h.first_day AS first_listen_date,
           a.last_day AS last_event_date,
           a.days AS distinct_days_active,
           date_diff('day', p.signup_date, h.first_day) AS days_to_first_listen
    FROM people p
    LEFT JOIN (SELECT user_id, count(*) AS events, min(event_date) AS first_day,
                      max(event_date) AS last_day, count(DISTINCT event_date) AS days
               FROM fact GROUP BY user_id) a USING (user_id)
    LEFT JOIN (SELECT user_id, count(*) AS listens, count(DISTINCT episode_id) AS episodes,
                      count(DISTINCT podcast_id) AS podcasts,
                      CAST(sum(duration_capped_seconds) AS BIGINT) AS seconds,
                      avg(listen_through_rate) AS rate, min(event_date) AS first_day
               FROM listens GROUP BY user_id) h USING (user_id)
),
profiled AS (
    SELECT l.*, c.duration_seconds, c.episode_length_bucket,
           l.duration IS NOT NULL AND l.episode_id IS NOT NULL
               AND coalesce(l.event_type IN ('play', 'complete'), FALSE) AS heard,
           l.event_type IS NULL OR l.user_id IS NULL OR l.episode_id IS NULL
               OR TRY_CAST(l.event_timestamp_raw AS TIMESTAMP) IS NULL
               OR (l.event_type IN ('play', 'complete') AND l.duration IS NULL) AS bad
    FROM log l LEFT JOIN catalogue c USING (episode_id)
),
completed AS (SELECT episode_id, count(*) AS n FROM fact WHERE event_type = 'complete' GROUP BY episode_id)
"""

_STAGED_COLUMNS = """event_id, event_type, user_id, episode_id, event_timestamp_raw, event_datetime, duration,
    is_missing_event_type, is_missing_user_id, is_missing_episode_id, is_missing_timestamp,
    is_malformed_timestamp, is_missing_duration, is_rejected, rejection_reason_count,
    rejection_reason_summary"""

_FACT = "SELECT * EXCLUDE (podcast_id, episode_length_bucket, title) FROM fact"

_PODCASTS = """
    SELECT c.podcast_id, count(DISTINCT c.episode_id) AS episode_count,
           CAST(coalesce(sum(n), 0) AS BIGINT) AS total_completions,
           round(CAST(coalesce(sum(n), 0) AS DOUBLE) / count(DISTINCT c.episode_id), 2)
               AS avg_completions_per_episode
    FROM catalogue c LEFT JOIN completed USING (episode_id)
    GROUP BY c.podcast_id"""


def _one_check(check: str, target: str, failing: str) -> str:
    return f"""SELECT '{check}' AS "check", '{target}' AS target, CAST(({failing}) AS BIGINT) AS failing_rows"""


# Table of the star -> (subquery, key).
_KEYED = {
    "stg_users": ("people", "user_id"),
    "stg_episodes": ("shows", "episode_id"),
    "stg_event_logs": ("staged", "event_id"),
    "dim_users": ("people", "user_id"),
    "dim_episodes": ("catalogue", "episode_id"),
    "fct_listening_events": ("fact", "event_id"),
    "rejected_event_logs": ("quarantine", "event_id"),
    "mart_user_engagement": ("engagement", "user_id"),
}


def _repeated(source: str, keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT {keys} FROM {source} GROUP BY {keys} HAVING count(*) > 1)"


_CHECKS = {
    "check_unique": [
        _one_check("unique", f"{t}.{k}", _repeated(s, k)) for t, (s, k) in _KEYED.items()
    ],
    "check_not_null": [
        _one_check("not_null", f"{t}.{k}", f"SELECT count(*) FROM {s} WHERE {k} IS NULL")
        for t, (s, k) in _KEYED.items()
    ],
    "check_accepted_values": [
        _one_check(
            "accepted_values",
            "fct_listening_events.event_type",
            "SELECT count(*) FROM fact "
            "WHERE event_type NOT IN ('play', 'pause', 'seek', 'complete', 'download')",
        ),
        _one_check(
            "accepted_values",
            "dim_episodes.episode_length_bucket",
            "SELECT count(*) FROM catalogue WHERE episode_length_bucket NOT IN ('short', 'medium', 'long')",
        ),
    ],
    "check_relationships": [
        _one_check(
            "relationships",
            "fct_listening_events.user_id",
            "SELECT count(*) FROM fact f WHERE NOT EXISTS (FROM people p WHERE p.user_id = f.user_id)",
        ),
        _one_check(
            "relationships",
            "fct_listening_events.episode_id",
            "SELECT count(*) FROM fact f WHERE NOT EXISTS (FROM shows s WHERE s.episode_id = f.episode_id)",
        ),
    ],
    "check_unique_combination": [
        _one_check(
            "unique_combination",
            "int_user_daily_activity(user_id, event_date)",
            _repeated("daily", "user_id, event_date"),
        )
    ],
    "check_capped_le_length": [
        _one_check(
            "capped_le_length",
            "fct_listening_events",
            "SELECT count(*) FROM fact JOIN shows USING (episode_id) WHERE duration_capped_seconds > duration_seconds",
        )
    ],
    "check_capped_null_rule": [
        _one_check(
            "capped_null_rule",
            "fct_listening_events",
            "SELECT count(*) FROM fact WHERE is_listen_event <> (duration_capped_seconds IS NOT NULL)",
        )
    ],
    "check_exclusive_split": [
        _one_check(
            "exclusive_split",
            "fct_listening_events, rejected_event_logs",
            "SELECT count(DISTINCT event_id) FROM fact WHERE event_id IN (SELECT event_id FROM quarantine)",
        )
    ],
    "check_rejected_has_reason": [
        _one_check(
            "rejected_has_reason",
            "rejected_event_logs",
            "SELECT count(*) FROM quarantine WHERE rejection_reason_count = 0",
        )
    ],
    "check_reconciliation": [
        _one_check(
            "reconciliation",
            "stg_event_logs",
            "SELECT CASE WHEN (SELECT count(*) FROM staged) = (SELECT count(*) FROM fact)"
            " + (SELECT count(*) FROM quarantine) THEN 0 ELSE 1 END",
        )
    ],
}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


_SUMMARY = """
    SELECT unnest(['total_raw_events', 'duplicate_events_removed', 'staged_events', 'valid_events',
                   'rejected_events', 'missing_event_type', 'missing_user_id', 'missing_episode_id',
                   'missing_timestamp', 'malformed_timestamp', 'missing_duration',
                   'valid_events_before_episode_release']) AS metric,
           unnest([CAST(sum(copies) AS BIGINT), CAST(sum(copies) AS BIGINT) - count(*), count(*),
                   count(*) FILTER (NOT is_rejected), count(*) FILTER (is_rejected),
                   count(*) FILTER (is_missing_event_type), count(*) FILTER (is_missing_user_id),
                   count(*) FILTER (is_missing_episode_id), count(*) FILTER (is_missing_timestamp),
                   count(*) FILTER (is_malformed_timestamp), count(*) FILTER (is_missing_duration),
                   (SELECT count(*) FROM fact WHERE is_before_episode_release)]) AS value
    FROM staged"""


def _busy(definition: str, condition: str) -> str:
    return f"""
    SELECT '{definition}' AS definition, count(DISTINCT user_id) AS users_3plus_episodes_in_a_day
    FROM (SELECT user_id FROM fact WHERE {condition} GROUP BY user_id, event_date
          HAVING count(DISTINCT episode_id) >= 3)"""


def _rejections(dimension: str, value: str, source: str = "staged") -> str:
    return f"""
    SELECT '{dimension}' AS dimension, {value} AS value, count(*) AS staged_events,
           count(*) FILTER (is_rejected) AS rejected_events,
           round(CAST(count(*) FILTER (is_rejected) AS DOUBLE) / count(*), 6) AS rejection_rate
    FROM {source} GROUP BY {value}"""


_DAILY_REJECTIONS = """SELECT CAST(s.event_datetime AS DATE) AS event_date, r.reason, count(*) AS staged_events,
                   count(*) FILTER (CASE r.reason
                       WHEN 'any' THEN is_rejected
                       WHEN 'missing_event_type' THEN is_missing_event_type
                       WHEN 'missing_user_id' THEN is_missing_user_id
                       WHEN 'missing_episode_id' THEN is_missing_episode_id
                       ELSE is_missing_duration END) AS rejected_events
            FROM staged s, (SELECT unnest(['any', 'missing_event_type', 'missing_user_id',
                                           'missing_episode_id', 'missing_duration']) AS reason) r
            WHERE s.event_datetime IS NOT NULL
            GROUP BY ALL"""

_DRIFT = f"""
    SELECT event_date, reason, staged_events, rejected_events,
           round(rate, 6) AS rejection_rate, round(baseline, 6) AS baseline_rate,
           CASE WHEN baseline IS NULL THEN 'no_baseline' WHEN rate > baseline * 1.5 THEN 'warn'
                ELSE 'ok' END AS severity
    FROM (
        SELECT *, CAST(rejected_events AS DOUBLE) / staged_events AS rate,
               CAST(sum(rejected_events) OVER w AS DOUBLE)
                   / CAST(nullif(sum(staged_events) OVER w, 0) AS DOUBLE) AS baseline
        FROM (
{_DAILY_REJECTIONS})
        WINDOW w AS (PARTITION BY reason ORDER BY event_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""

_ALARM = f"""
    , by_day AS ({_DAILY_REJECTIONS}),
    rated AS (SELECT *, CAST(rejected_events AS DOUBLE) / staged_events AS rate, isodow(event_date) AS weekday FROM by_day),
    usual AS (
        SELECT reason, weekday, list_sort(list(rate))[CAST(ceil(0.75 * count(*)) AS INTEGER)] AS usual
        FROM rated WHERE event_date <= '2024-01-17' GROUP BY reason, weekday
    ),
    summed AS (
        SELECT r.*, usual, sum(coalesce(rate - usual, 0.0)) OVER w AS so_far
        FROM rated r LEFT JOIN usual USING (reason, weekday) WHERE event_date >= '2024-01-18'
        WINDOW w AS (PARTITION BY reason ORDER BY event_date)
    ),
    scored AS (
        SELECT *, so_far - least(min(so_far) OVER (PARTITION BY reason ORDER BY event_date), 0.0) AS score FROM summed
    )
    SELECT event_date, reason, staged_events, rejected_events, round(rate, 6) AS rejection_rate,
           round(usual, 6) AS usual_rate, round(score, 6) AS change_score,
           CASE WHEN usual IS NULL THEN 'no_baseline' WHEN score > usual * 0.5 THEN 'warn' ELSE 'ok' END AS severity
    FROM scored
    UNION ALL
    SELECT NULL, 'relationships: fct_listening_events.' || key, NULL, failing, NULL, NULL, NULL,
           CASE WHEN failing > 0 THEN 'error' ELSE 'ok' END
    FROM (
        SELECT 'user_id' AS key, count(*) AS failing FROM fact WHERE user_id NOT IN (SELECT user_id FROM people)
        UNION ALL
        SELECT 'episode_id', count(*) FROM fact
        WHERE episode_id NOT IN (SELECT episode_id FROM shows WHERE episode_id % 7 <> 3)
    )"""

_IN_WINDOWS = """
    , heard AS (
        SELECT episode_id, user_id, bool_or(event_date BETWEEN '2024-01-01' AND '2024-01-14') AS a,
               bool_or(event_date BETWEEN '2024-01-12' AND '2024-01-31') AS b
        FROM listens GROUP BY episode_id, user_id
    )
    SELECT episode_id, count(*) FILTER (a) AS earlier_listeners, count(*) FILTER (b) AS later_listeners,
           count(*) FILTER (a OR b) AS listeners, count(*) FILTER (b AND NOT a) AS new_listeners,
           count(*) FILTER (a AND b) AS returning_listeners
    FROM heard GROUP BY episode_id"""

_BY_DAYS = """
    SELECT cohort, cohort_users, days_since_signup, active_users
    FROM (
        SELECT date_trunc('month', p.signup_date)::DATE AS cohort, w.name AS days_since_signup,
               count(DISTINCT p.user_id) AS cohort_users,
               count(DISTINCT CASE WHEN l.event_date BETWEEN p.signup_date + w.low AND p.signup_date + w.high
                                   THEN p.user_id END) AS active_users
        FROM people p
        CROSS JOIN (VALUES ('0-59', 0, 59), ('60-119', 60, 119), ('100-140', 100, 140), ('120-239', 120, 239))
                   w(name, low, high)
        LEFT JOIN listens l ON l.user_id = p.user_id
        GROUP BY ALL)"""

_HEAVY = """
    SELECT CAST(p.percent AS BIGINT) AS top_percent, count(*) AS heavy_users,
           CAST(sum(n) AS BIGINT) AS heavy_listens,
           round(CAST(sum(n) AS DOUBLE) / CAST(min(total) AS DOUBLE), 6) AS share_of_listens
    FROM (SELECT n, row_number() OVER (ORDER BY n DESC) AS place, count(*) OVER () AS users,
                 sum(n) OVER () AS total
          FROM (SELECT count(*) AS n FROM listens GROUP BY user_id)) u,
         (SELECT unnest([1, 5, 10, 20, 50]) AS percent) p
    WHERE place <= (p.percent * users + 99) // 100
    GROUP BY p.percent"""

_VERSIONS = """
    , snapshots AS (
        SELECT DATE '{0}' AS taken, user_id, signup_date, country FROM people WHERE user_id % 40 <> 9
        UNION ALL
        SELECT DATE '{1}', user_id, signup_date,
               CASE WHEN user_id % 10 = 3 THEN 'NATION_0' ELSE country END
        FROM people WHERE user_id % 50 <> 7
        UNION ALL
        SELECT DATE '{2}', user_id, signup_date,
               CASE WHEN user_id % 10 = 3 THEN 'NATION_0' WHEN user_id % 10 = 4 THEN 'NATION_1'
                    ELSE country END
        FROM people WHERE user_id % 50 <> 7
    ),
    starts AS (
        SELECT * FROM (SELECT *, lag(country) OVER (PARTITION BY user_id ORDER BY taken) AS earlier FROM snapshots)
        WHERE earlier IS NULL OR earlier <> country
    ),
    versions AS (
        SELECT user_id, signup_date, country, taken AS valid_from,
               lead(taken) OVER (PARTITION BY user_id ORDER BY taken) AS valid_to,
               lead(taken) OVER (PARTITION BY user_id ORDER BY taken) IS NULL AS is_current
        FROM starts
    )"""

_HISTORY = _VERSIONS.format("2024-01-01", "2024-02-01", "2024-03-01") + " SELECT * FROM versions"

_AS_OF = (
    _VERSIONS.format("2024-01-05", "2024-01-12", "2024-01-20")
    + """
    SELECT v.country, count(*) AS listen_events, round(avg(listen_through_rate), 6) AS avg_listen_through_rate
    FROM fact f LEFT JOIN versions v ON v.user_id = f.user_id AND v.valid_from <= f.event_date
                                    AND (v.valid_to IS NULL OR f.event_date < v.valid_to)
    WHERE listen_through_rate IS NOT NULL GROUP BY v.country"""
)

_DAMAGED = """
    , lines AS (
        SELECT DISTINCT '"' || coalesce(event_type, '') || '","' || coalesce(CAST(user_id AS VARCHAR), '') || '","'
               || coalesce(CAST(episode_id AS VARCHAR), '') || '","' || coalesce(event_timestamp_raw, '') || '","x'
               || duration || '"' AS line
        FROM log WHERE duration % 50 = 7
    )
    SELECT event_id, event_timestamp_raw, is_rejected, rejection_reason_count, rejection_reason_summary
    FROM staged WHERE duration IS NULL OR duration % 50 <> 7
    UNION ALL
    SELECT md5('4:true' || length(line) || ':' || line), line, true, 1, 'damaged_line' FROM lines"""

_OVERLONG = "s.event_type IN ('play', 'complete') AND s.duration > 3 * c.duration_seconds"
_MODELS_2 = MODELS.replace("WHERE NOT s.is_rejected", f"WHERE NOT s.is_rejected AND NOT coalesce({_OVERLONG}, FALSE)")

_RECHECKED = """
    , judged AS (
        SELECT s.*, CASE WHEN s.event_type IN ('play', 'complete') AND s.duration IS NOT NULL
                         THEN s.duration > 3 * c.duration_seconds ELSE FALSE END AS overlong
        FROM staged s LEFT JOIN catalogue c USING (episode_id)
    )"""
_REASONS = "missing_event_type missing_user_id missing_episode_id missing_timestamp malformed_timestamp missing_duration".split()

_STATEMENTS = {
    "recheck_events": f"""{_RECHECKED}
    SELECT event_id, overlong AS is_overlong_duration, is_rejected OR coalesce(overlong, FALSE) AS is_rejected,
           rejection_reason_count + CAST(coalesce(overlong, FALSE) AS INTEGER) AS rejection_reason_count,
           CASE WHEN coalesce(overlong, FALSE) THEN concat_ws(', ', nullif(rejection_reason_summary, ''), 'overlong_duration')
                ELSE rejection_reason_summary END AS rejection_reason_summary,
           CASE WHEN overlong IS NULL THEN '1' ELSE '2' END AS rejection_ruleset_version
    FROM judged""",
    "ruleset_coverage": _RECHECKED
    + _union(
        [
            f"""
    SELECT CASE WHEN overlong IS NULL THEN '1' ELSE '2' END AS rejection_ruleset_version, '{reason}' AS reason,
           count(*) AS events, count(*) FILTER ({flag}) AS failed, count(*) FILTER ({flag} IS NULL) AS not_checked
    FROM judged GROUP BY ALL"""
            for reason, flag in [*((r, f"is_{r}") for r in _REASONS), ("overlong_duration", "overlong")]
        ]
    ),
    "rejection_alarm": _ALARM,
    "listeners_in_windows": _IN_WINDOWS,
    "retention_by_days": _BY_DAYS,
    "damaged_log": _DAMAGED,
    "ltr_by_country_as_of": _AS_OF,
    "stg_users": "SELECT * FROM people",
    "stg_episodes": "SELECT * FROM shows",
    "stg_event_logs": f"SELECT {_STAGED_COLUMNS} FROM staged",
    "dim_users": """
        SELECT *, CAST(year(signup_date) AS BIGINT) AS signup_year,
               CAST(month(signup_date) AS BIGINT) AS signup_month FROM people""",
    "dim_episodes": "SELECT * FROM catalogue",
    "fct_listening_events": _FACT,
    "rejected_event_logs": f"SELECT {_STAGED_COLUMNS.replace('event_datetime, ', '').replace('is_rejected, ', '')} FROM quarantine",
    "int_user_daily_activity": "SELECT * FROM daily",
    "mart_user_engagement": "SELECT * REPLACE (round(avg_listen_through_rate, 6) AS avg_listen_through_rate) FROM engagement",
    "data_quality_summary": _SUMMARY,
    "top_completed_episodes_7d": """
        SELECT episode_id, title, count(*) AS completion_events FROM fact
        WHERE event_type = 'complete' AND date_diff('day', event_date, (SELECT max(event_date) FROM fact)) < 7
        GROUP BY ALL HAVING title IS NOT NULL ORDER BY completion_events DESC, episode_id LIMIT 10""",
    "top_completed_episodes_all": """
        SELECT episode_id, title, n AS completion_events FROM completed JOIN shows USING (episode_id)
        ORDER BY n DESC, episode_id LIMIT 10""",
    "podcast_completions_avg": _PODCASTS,
    "ltr_by_country": """
        SELECT p.country, round(avg(l.listen_through_rate), 6) AS avg_listen_through_rate
        FROM people p JOIN listens l USING (user_id) GROUP BY p.country""",
    "ltr_by_podcast": """
        SELECT podcast_id, round(avg(listen_through_rate), 6) AS avg_listen_through_rate
        FROM listens WHERE episode_id IN (SELECT episode_id FROM shows) GROUP BY podcast_id""",
    "ltr_by_length_bucket": """
        SELECT episode_length_bucket, round(avg(listen_through_rate), 6) AS avg_listen_through_rate
        FROM listens WHERE episode_id IN (SELECT episode_id FROM shows) GROUP BY episode_length_bucket""",
    "users_3plus_episodes_in_a_day": """
        SELECT count(DISTINCT user_id) FILTER (distinct_episodes > 2) AS users_3plus_episodes_in_a_day
        FROM daily""",
    "single_vs_multi_podcast": """
        SELECT CASE coalesce(distinct_podcasts_listened, 0) WHEN 0 THEN 'no_listens'
                    WHEN 1 THEN 'single_podcast' ELSE 'multi_podcast' END AS listener_type,
               count(*) AS user_count, round(avg(distinct_episodes_listened), 1) AS avg_episodes_listened
        FROM engagement GROUP BY listener_type""",
    "top_podcast_share": """
        SELECT round(avg(share), 2) AS avg_top_podcast_concentration,
               round(min(share), 2) AS min_concentration, round(max(share), 2) AS max_concentration
        FROM (SELECT CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY user_id) AS DOUBLE) AS share,
                     row_number() OVER (PARTITION BY user_id ORDER BY n DESC) AS place
              FROM (SELECT user_id, podcast_id, count(*) AS n FROM listens
                    WHERE episode_id IN (SELECT episode_id FROM shows) GROUP BY user_id, podcast_id))
        WHERE place = 1""",
    "top_podcast_per_user": """
        SELECT user_id, podcast_id, n AS listens, CAST(total AS BIGINT) AS total_listens
        FROM (SELECT user_id, podcast_id, count(*) AS n,
                     sum(count(*)) OVER (PARTITION BY user_id) AS total,
                     row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, podcast_id) AS place
              FROM listens WHERE episode_id IN (SELECT episode_id FROM shows)
              GROUP BY user_id, podcast_id)
        WHERE place = 1""",
    **{name: _union(parts) for name, parts in _CHECKS.items()},
    "check_report": _union([part for parts in _CHECKS.values() for part in parts]),
    "recorded_report": _union(
        [
            part
            for name in ("not_null", "accepted_values", "capped_null_rule", "rejected_has_reason", "reconciliation")
            for part in _CHECKS[f"check_{name}"]
        ]
    ),
    "raw_log_profile": """
        SELECT count(*) AS events, count(*) FILTER (bad) AS rejected,
               round(CAST(count(*) FILTER (bad) AS DOUBLE) / count(*), 6) AS rejected_share,
               count(*) FILTER (heard) AS listens,
               count(*) FILTER (heard AND duration > duration_seconds) AS duration_overruns,
               round(CAST(count(*) FILTER (heard AND duration > duration_seconds) AS DOUBLE)
                   / nullif(count(*) FILTER (heard), 0), 6) AS overrun_share,
               round(avg(CAST(least(duration, duration_seconds) AS DOUBLE) / nullif(duration_seconds, 0)) FILTER (heard), 6)
                   AS avg_listen_through
        FROM profiled""",
    "raw_log_profile_by_bucket": """
        SELECT episode_length_bucket,
               round(avg(CAST(least(duration, duration_seconds) AS DOUBLE) / nullif(duration_seconds, 0)), 6)
                   AS avg_listen_through,
               count(*) AS listens
        FROM profiled WHERE heard AND episode_length_bucket IS NOT NULL GROUP BY episode_length_bucket""",
    "csv_round_trip": f"""
        SELECT * REPLACE (CAST(user_id AS VARCHAR) AS user_id, CAST(episode_id AS VARCHAR) AS episode_id)
        FROM (SELECT {_STAGED_COLUMNS} FROM staged)""",
    "incremental_fact": _FACT,
    "incremental_fact_stream": _FACT,
    "incremental_daily_activity": "SELECT * FROM daily",
    "incremental_mart": "SELECT * REPLACE (round(avg_listen_through_rate, 6) AS avg_listen_through_rate) FROM engagement",
    "check_derived_tables": _union(
        [
            _one_check(
                "derived_table",
                "int_user_daily_activity",
                "SELECT count(*) FROM (SELECT event_date, count(*) AS a FROM listens GROUP BY event_date)"
                " FULL JOIN (SELECT event_date, sum(total_listen_events) AS b FROM daily GROUP BY event_date)"
                " USING (event_date) WHERE a IS DISTINCT FROM b",
            ),
            _one_check(
                "derived_table",
                "mart_user_engagement",
                "SELECT count(*) FROM engagement LEFT JOIN (SELECT user_id, count(*) AS a FROM fact GROUP BY user_id)"
                " USING (user_id) WHERE a IS DISTINCT FROM total_valid_events",
            ),
        ]
    ),
    "listen_definition_sensitivity": _union(
        [
            _busy("any_event", "TRUE"),
            _busy("play_or_complete", "is_listen_event"),
            _busy("play_only", "event_type = 'play'"),
        ]
    ),
    "top_episodes_by_distinct_listeners": """
        SELECT episode_id, title, count(DISTINCT user_id) AS distinct_listeners
        FROM fact WHERE event_type = 'complete' AND title IS NOT NULL
        GROUP BY episode_id, title ORDER BY distinct_listeners DESC, episode_id LIMIT 10""",
    "podcast_completions_min_episodes": f"SELECT * FROM ({_PODCASTS}) WHERE episode_count >= (SELECT avg(episode_count) FROM ({_PODCASTS}))",
    "ltr_weighted": """
        SELECT podcast_id, round(avg(listen_through_rate), 6) AS avg_listen_through_rate,
               round(CAST(sum(duration_capped_seconds) AS DOUBLE)
                   / CAST(nullif(sum(episode_duration_seconds), 0) AS DOUBLE), 6)
                   AS weighted_listen_through_rate
        FROM listens WHERE podcast_id IS NOT NULL GROUP BY podcast_id""",
    "rejections_by_dimension": _union(
        [
            _rejections("event_type", "event_type"),
            _rejections("event_date", "CAST(CAST(event_datetime AS DATE) AS VARCHAR)"),
            _rejections("episode", "CAST(episode_id AS VARCHAR)"),
            _rejections("country", "country", "staged LEFT JOIN people USING (user_id)"),
        ]
    ),
    "rejection_rate_drift": _DRIFT,
    "ruleset_version": f"SELECT {_STAGED_COLUMNS}, '1' AS rejection_ruleset_version FROM staged",
    "dim_podcasts": """
        SELECT podcast_id, count(*) AS episode_count, min(release_date) AS first_release_date,
               max(release_date) AS last_release_date
        FROM shows GROUP BY podcast_id""",
    "new_vs_returning_listeners": """
        SELECT episode_id, count(*) FILTER (heard = arrived) AS new_listeners,
               count(*) FILTER (heard <> arrived) AS returning_listeners
        FROM (SELECT episode_id, min(event_date) AS heard,
                     min(min(event_date)) OVER (PARTITION BY user_id) AS arrived
              FROM listens GROUP BY user_id, episode_id)
        GROUP BY episode_id""",
    "heavy_user_concentration": _HEAVY,
    "cohort_retention": """
        SELECT signup_month, months_since_signup, active_users, cohort_size,
               round(CAST(active_users AS DOUBLE) / cohort_size, 6) AS retention_rate
        FROM (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS signup_month,
                     date_diff('month', signup_date, event_date) AS months_since_signup,
                     count(DISTINCT user_id) AS active_users
              FROM listens JOIN people USING (user_id) GROUP BY ALL)
        JOIN (SELECT CAST(date_trunc('month', signup_date) AS DATE) AS signup_month, count(*) AS cohort_size
              FROM people GROUP BY ALL) USING (signup_month)""",
    "dim_users_history": _HISTORY,
    "ltr_by_region": """
        SELECT region, country, count(listen_through_rate) AS listen_events,
               round(avg(listen_through_rate), 6) AS avg_listen_through_rate
        FROM listens JOIN people USING (user_id)
        JOIN (SELECT n_name AS country, r_name AS region
              FROM nation JOIN region ON r_regionkey = n_regionkey) USING (country)
        GROUP BY ROLLUP (region, country)""",
    "feature_impact": """
        SELECT CASE user_id % 2 WHEN 0 THEN 'exposed' ELSE 'control' END AS exposure_group,
               count(*) AS listen_events, round(avg(listen_through_rate), 6) AS avg_listen_through_rate,
               round(stddev_samp(listen_through_rate), 6) AS stddev_listen_through_rate
        FROM listens GROUP BY exposure_group""",
}

ORACLE = {name: f"WITH {SOURCES},{MODELS}{statement}" for name, statement in _STATEMENTS.items()}
ORACLE["mart_under_second_rules"] = f"WITH {SOURCES},{_MODELS_2}{_STATEMENTS['mart_user_engagement']}"
