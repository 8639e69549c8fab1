"""The SQL that each registered query is compared with."""

from __future__ import annotations

from tallymill.plans.tuning import RANKS, REG_PARAMS

FLIGHTS = """flights AS (
  SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(quarter(l_shipdate) AS INT) AS quarter,
         sn.n_name AS origin, cn.n_name AS dest,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS INT) AS depdelay,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey)"""

BASE = FLIGHTS + """, base AS (
  SELECT quarter, origin, dest, depdelay, cancelled FROM flights WHERE year >= 2000)"""

RATINGS = """ratings AS (
  SELECT CAST(o_custkey AS INT) AS userId, CAST(l_partkey AS INT) AS movieId,
         CAST(max(ceil(l_quantity / 5.0) / 2.0) AS FLOAT) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""

PLANTED = """planted AS (
  SELECT DISTINCT CAST(o_custkey AS INT) AS userId, CAST(l_partkey AS INT) AS movieId,
         CAST(round(2 * (2.75 + 2.0 * cos(2 * pi() * ((o_custkey % 7) - (l_partkey % 7)) / 7.0))) / 2.0
              AS FLOAT) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = """movies AS (
  SELECT CAST(p_partkey AS INT) AS id, p_name AS title, p_type || '|' || p_brand AS genres FROM part)"""

# The most active user and their ratings.
ACTIVE = PLANTED + """, active AS (
  SELECT userId FROM planted GROUP BY userId ORDER BY count(*) DESC, userId LIMIT 1),
rated AS (SELECT * FROM planted WHERE userId = (SELECT userId FROM active))"""


def bucket(salt: str, buckets: int) -> str:
    digest = f"md5(concat_ws('-', '{salt}', userId, movieId))"
    return f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % {buckets}"


SPLIT3 = (
    f"CASE WHEN {bucket('42', 100)} < 80 THEN 'train' "
    f"WHEN {bucket('42', 100)} < 90 THEN 'validation' ELSE 'test' END"
)
SPLIT2 = f"CASE WHEN {bucket('42', 100)} < 90 THEN 'train' ELSE 'test' END"


def labelled(source: str, split: str = SPLIT3) -> str:
    """Splits of the rows, and the rows a model of the train rows can predict."""
    return f"""labelled AS (SELECT *, {split} AS split FROM {source}),
train AS (SELECT userId, movieId, rating FROM labelled WHERE split = 'train'),
test AS (SELECT userId, movieId, rating FROM labelled WHERE split = 'test'),
known AS (SELECT * FROM labelled
  WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train))"""


BASELINE = """(SELECT sqrt(avg(pow(CAST(rating AS DOUBLE) - (SELECT avg(CAST(rating AS DOUBLE)) FROM train), 2)))
  FROM test)"""


def top10(keys: str, count_name: str, where: str = "TRUE") -> str:
    order = ", ".join(f"{key} ASC NULLS LAST" for key in keys.split(", "))
    return f"""WITH {BASE}
SELECT {keys}, count(*) AS {count_name} FROM base WHERE {where}
GROUP BY {keys} ORDER BY {count_name} DESC, {order} LIMIT 10"""


def long_report(name: str, key1: str, key2: str, where: str) -> str:
    return f"""SELECT '{name}' AS report,
  row_number() OVER (ORDER BY count(*) DESC, {key1} NULLS LAST, {key2} NULLS LAST) AS position,
  CAST({key1} AS VARCHAR) AS key1, CAST({key2} AS VARCHAR) AS key2, count(*) AS n
FROM base WHERE {where} GROUP BY {key1}, {key2}"""


LONG_REPORTS = f"WITH {BASE}, every_report AS (" + "\nUNION ALL ".join(
    [
        long_report("top_departures", "origin", "NULL", "TRUE"),
        long_report("top_short_delays", "origin", "NULL", "depdelay >= 15"),
        long_report("top_long_delays", "origin", "NULL", "depdelay >= 60"),
        long_report("top_cancellations", "origin", "NULL", "cancelled = 1"),
        long_report("rank_quarter_cancellations", "quarter", "NULL", "cancelled = 1"),
        long_report("popular_flights", "origin", "dest", "TRUE"),
    ]
) + ")\n"

REPORT_FILES = LONG_REPORTS + "SELECT report, key1, key2, n FROM every_report WHERE position <= 10"

# What depends on training is checked within the query; 1 means that the check holds.
GRID = tuple(f"rank={rank}, regParam={reg}" for rank in RANKS for reg in REG_PARAMS)


def grid_rows(metric: str, split: str, value: str) -> list[str]:
    return [f"SELECT '{run}' AS run, '{metric}' AS metric, '{split}' AS split, {value} AS value" for run in GRID]


def metric_row(run: str, metric: str, split: str, value: str) -> str:
    return f"SELECT '{run}' AS run, '{metric}' AS metric, '{split}' AS split, {value} AS value"


def known_rows(split: str) -> str:
    return f"(SELECT CAST(count(*) AS DOUBLE) FROM known WHERE split = '{split}')"


_DOUBLE_ONE = "CAST(1 AS DOUBLE)"

ORACLES = {
    "scan_parquet_flights": f"""WITH {FLIGHTS}
SELECT count(*) AS flights, min(year) AS first_year, max(year) AS last_year,
       count(*) FILTER (WHERE cancelled = 1) AS cancelled FROM flights""",
    "flights_after_coalesce": f"WITH {BASE} SELECT quarter, count(*) AS flights FROM base GROUP BY quarter",
    "scan_csv_ratings": f"WITH {RATINGS} SELECT * FROM ratings",
    "scan_csv_gzip_ratings": f"WITH {RATINGS} SELECT * FROM ratings",
    "scan_csv_movies_quoted": f"""WITH {MOVIES}
SELECT id, '"' || title || '", or the ' || title || ' "cut", à la carte' AS title, genres FROM movies""",
    "report_files_readback": REPORT_FILES,
    "report_files_separate": REPORT_FILES,
    "run_metrics": f"""WITH {RATINGS}, {labelled('ratings')}
SELECT 'data' AS run, 'rows' AS metric, split, CAST(count(*) AS DOUBLE) AS value FROM labelled GROUP BY split
UNION ALL {metric_row('baseline', 'mean_rating', 'train', 'round((SELECT avg(CAST(rating AS DOUBLE)) FROM train), 6)')}
UNION ALL {metric_row('baseline', 'rmse', 'test', f'round({BASELINE}, 6)')}""",
    "flight_base": f"WITH {BASE} SELECT * FROM base",
    "user_ratings": f"WITH {ACTIVE} SELECT * FROM rated",
    "explode_user_movies": f"WITH {RATINGS} SELECT * FROM ratings",
    "stringify_array": """SELECT CAST(p_partkey AS INT) AS id, '[' || p_type || ',' || p_brand || ',' ||
  CASE WHEN p_size >= 10 THEN CAST(p_size AS VARCHAR) ELSE 'null' END || ']' AS properties FROM part""",
    "unique_id": "SELECT count(*) AS rows, count(*) AS ids, CAST(0 AS BIGINT) AS negative FROM lineitem",
    "unique_id_prepended": "SELECT count(*) AS rows, count(*) AS ids, CAST(0 AS BIGINT) AS negative FROM lineitem",
    "rated_movies_user": f"""WITH {ACTIVE}, {MOVIES}
SELECT id, title, genres FROM movies JOIN rated ON id = movieId""",
    "unrated_movies_user": f"""WITH {ACTIVE}, {MOVIES}
SELECT id AS movieId, title, genres, (SELECT userId FROM active) AS userId FROM movies
WHERE id NOT IN (SELECT movieId FROM rated)""",
    "movies_except_rated": f"""WITH {ACTIVE}, {MOVIES}
SELECT * FROM movies EXCEPT SELECT id, title, genres FROM movies JOIN rated ON id = movieId""",
    "ratings_except_planted": f"WITH {RATINGS}, {PLANTED} SELECT * FROM ratings EXCEPT SELECT * FROM planted",
    "decorated_ratings": f"""WITH {RATINGS}, {MOVIES}
SELECT movieId, title, genres, userId, rating FROM ratings JOIN movies ON movieId = id""",
    "distinct_users": f"WITH {RATINGS} SELECT DISTINCT userId FROM ratings",
    "distinct_routes": f"WITH {BASE} SELECT DISTINCT origin, dest, quarter FROM base",
    "dedupe_any_key": f"WITH {RATINGS} SELECT count(*) AS rows, count(*) AS keys FROM ratings",
    "dedupe_by_key": """SELECT o_custkey, l_partkey, l_orderkey, l_linenumber, l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
QUALIFY row_number() OVER (PARTITION BY o_custkey, l_partkey
                           ORDER BY l_quantity DESC, l_orderkey, l_linenumber) = 1""",
    "top_departures": top10("origin", "total_departures"),
    "top_short_delays": top10("origin", "total_delays", "depdelay >= 15"),
    "top_long_delays": top10("origin", "total_delays", "depdelay >= 60"),
    "top_cancellations": top10("origin", "total_cancellations", "cancelled = 1"),
    "rank_quarter_cancellations": top10("quarter", "total_cancellations", "cancelled = 1"),
    "popular_flights": top10("origin, dest", "total_flights"),
    "flight_reports_single_pass": LONG_REPORTS
    + "SELECT report, CAST(position AS INT) AS position, key1, key2, n FROM every_report WHERE position <= 10",
    "mean_rating": f"WITH {RATINGS} SELECT round(avg(CAST(rating AS DOUBLE)), 6) AS mean_rating FROM ratings",
    "table_counts": f"""WITH {RATINGS}, {MOVIES}, {FLIGHTS}
SELECT 'ratings' AS name, count(*) AS rows FROM ratings
UNION ALL SELECT 'movies', count(*) FROM movies
UNION ALL SELECT 'flights', count(*) FROM flights""",
    "baseline_rmse": f"WITH {RATINGS}, {labelled('ratings')} SELECT round({BASELINE}, 6) AS baseline_rmse",
    "baseline_improvement": f"""WITH {PLANTED}, {labelled('planted')},
means AS (SELECT movieId, avg(CAST(rating AS DOUBLE)) AS item_mean FROM train GROUP BY movieId),
errors AS (
  SELECT sqrt(avg(pow(CAST(rating AS DOUBLE) - (SELECT avg(CAST(rating AS DOUBLE)) FROM train), 2))) AS base,
         sqrt(avg(pow(CAST(rating AS DOUBLE) - item_mean, 2))) AS value
  FROM test JOIN means USING (movieId))
SELECT round(base, 6) AS baseline_rmse, round(value, 6) AS item_mean_rmse,
       round((base - value) / base * 100, 6) AS improvement FROM errors""",
    "topk_movies_per_user": f"""WITH {RATINGS}
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY rating DESC, movieId) AS INT)
  AS position FROM ratings) WHERE position <= 25""",
    "topk_beyond_group_limit": """SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_orderkey, l_linenumber) <= 1500""",
    "sample_by_fractions": f"""WITH {RATINGS}
SELECT CAST(rating AS DOUBLE) AS rating, count(*) AS rows, TRUE AS plausible FROM ratings GROUP BY rating""",
    "stratified_sample_hash": f"WITH {RATINGS} SELECT * FROM ratings WHERE {bucket('sample-42', 10000)} < 500",
    "stratified_sample_exact": f"""WITH {RATINGS}
SELECT userId, movieId, rating FROM (
  SELECT *, count(*) OVER (PARTITION BY userId) AS n,
    row_number() OVER (PARTITION BY userId ORDER BY md5(concat_ws('-', 'sample-42', userId, movieId)),
                       userId, movieId) AS place FROM ratings)
WHERE place <= ceil(CAST(0.05 AS DECIMAL(19, 10)) * n)""",
    "stratified_sample_sliced": f"""WITH {RATINGS}
SELECT userId, movieId, rating, half FROM (
  SELECT *, userId % 2 AS half, count(*) OVER (PARTITION BY userId % 2) AS n,
    row_number() OVER (PARTITION BY userId % 2 ORDER BY md5(concat_ws('-', 'sample-42', userId, movieId)),
                       userId, movieId) AS place FROM ratings)
WHERE place <= ceil(CAST(0.05 AS DECIMAL(19, 10)) * n)""",
    "sampled_ratings_file": f"WITH {RATINGS} SELECT * FROM ratings WHERE {bucket('sample-42', 10000)} < 500",
    "split3_hash": f"WITH {RATINGS} SELECT *, {SPLIT3} AS split FROM ratings",
    "split2_hash": f"WITH {RATINGS} SELECT *, {SPLIT2} AS split FROM ratings",
    "random_split3": f"WITH {RATINGS} SELECT count(*) AS rows, count(*) AS pairs FROM ratings",
    "als_predict_coverage": f"""WITH {PLANTED}, {labelled('planted')}
SELECT userId, movieId, rating FROM known WHERE split = 'test'""",
    "als_beats_baseline": f"""WITH {PLANTED}, {labelled('planted')}
SELECT round({BASELINE}, 6) AS baseline_rmse, TRUE AS halved""",
    "saved_model_predictions": f"""WITH {PLANTED}
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS different FROM planted""",
    "recommend_all_flat": f"""WITH {PLANTED}
SELECT DISTINCT userId, least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS items,
  least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS distinct_items,
  CAST(0 AS BIGINT) AS different FROM planted""",
    "recommend_all_by_model": f"""WITH {PLANTED}
SELECT DISTINCT userId, least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS items,
  CAST(0 AS BIGINT) AS different FROM planted""",
    "recommend_block_sizes": f"""WITH {PLANTED}
SELECT DISTINCT userId, least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS items,
  CAST(0 AS BIGINT) AS different FROM planted""",
    "published_recommendations": f"""WITH {PLANTED}
SELECT DISTINCT userId, least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS items,
  CAST(1 AS BIGINT) AS files FROM planted""",
    "unrated_prediction_user": f"""WITH {ACTIVE}, {MOVIES}
SELECT id AS movieId, title, genres, (SELECT userId FROM active) AS userId, TRUE AS as_predicted FROM movies
WHERE id IN (SELECT movieId FROM planted) AND id NOT IN (SELECT movieId FROM rated)""",
    "unrated_recommendation_user": f"""WITH {ACTIVE}
SELECT userId, least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS recommended,
  CAST(0 AS BIGINT) AS still_rated FROM active""",
    "paths_agree": f"WITH {PLANTED} SELECT DISTINCT userId, CAST(0 AS BIGINT) AS different FROM planted",
    "top_n_for_user": f"""WITH {ACTIVE}
SELECT userId, least(100, (SELECT count(DISTINCT movieId) FROM planted) - (SELECT count(*) FROM rated)) AS movies,
  TRUE AS none_better_left_out FROM active""",
    "recommend_unrated_all": f"""WITH {PLANTED}
SELECT userId, least(25, (SELECT count(DISTINCT movieId) FROM planted) - count(*)) AS items,
  CAST(0 AS BIGINT) AS still_rated, CAST(0 AS BIGINT) AS different FROM planted GROUP BY userId
HAVING count(*) < (SELECT count(DISTINCT movieId) FROM planted)""",
    "recommend_user_subset": f"""WITH {PLANTED}
SELECT userId, least(25, (SELECT count(DISTINCT movieId) FROM planted) - count(*)) AS items,
  CAST(0 AS BIGINT) AS still_rated, CAST(0 AS BIGINT) AS different
FROM planted JOIN customer ON userId = c_custkey WHERE c_mktsegment = 'BUILDING' GROUP BY userId
HAVING count(*) < (SELECT count(DISTINCT movieId) FROM planted)""",
    "holdout_grid_metrics": f"WITH {PLANTED}, {labelled('planted')}\n"
    + "\nUNION ALL ".join(
        grid_rows("rmse", "validation", _DOUBLE_ONE)
        + grid_rows("scored_rows", "validation", known_rows("validation"))
        + [
            metric_row("best", "rmse", "validation", _DOUBLE_ONE),
            metric_row("best", "rmse", "test", _DOUBLE_ONE),
            metric_row("best", "scored_rows", "test", known_rows("test")),
            metric_row("baseline", "rmse", "test", f"round({BASELINE}, 6)"),
            metric_row("best", "improvement_percent", "test", _DOUBLE_ONE),
        ]
    ),
    "cv_grid_metrics": f"WITH {PLANTED}, {labelled('planted', SPLIT2)}\n"
    + "\nUNION ALL ".join(
        grid_rows("mean_rmse", "folds", _DOUBLE_ONE)
        + [
            metric_row("best", "rmse", "train", _DOUBLE_ONE),
            metric_row("best", "scored_rows", "train", known_rows("train")),
            metric_row("best", "rmse", "test", _DOUBLE_ONE),
            metric_row("best", "scored_rows", "test", known_rows("test")),
            metric_row("baseline", "rmse", "test", f"round({BASELINE}, 6)"),
        ]
    ),
    "pipeline_holdout": f"""WITH {PLANTED}
SELECT CAST(0 AS BIGINT) AS wrong_unrated, count(DISTINCT userId) AS users,
  count(DISTINCT userId) * least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS recommended, TRUE AS model_beats_mean FROM planted""",
    "pipeline_cv": f"""WITH {PLANTED}
SELECT CAST(0 AS BIGINT) AS wrong_unrated, count(DISTINCT userId) AS users,
  count(DISTINCT userId) * least(25, (SELECT count(DISTINCT movieId) FROM planted)) AS recommended, TRUE AS model_beats_mean,
  TRUE AS cv_model_beats_mean FROM planted""",
}
