"""DuckDB SQL that computes each registered query independently of Spark."""

from __future__ import annotations

import re

# Every statement may use these tables.
_TABLES = r"""
ratings AS (
  SELECT o_custkey AS "userId", l_partkey AS "movieId",
         max(((l_quantity::INT % 10) + 1) / 2.0::DOUBLE) AS rating,
         max(epoch(o_orderdate)::BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
movies AS (
  SELECT p_partkey AS "movieId", p_name || ' (' || (1920 + p_partkey % 100)::VARCHAR || ')' AS title,
         p_type || '|' || replace(p_name, ' ', '|') AS genres
  FROM part),
genre_rows AS (SELECT "movieId", unnest(string_split(genres, '|')) AS genre FROM movies),
ages AS (
  SELECT "movieId", released_year, 2024 - released_year AS movie_age
  FROM (SELECT "movieId", TRY_CAST(regexp_extract(title, '\((\d+)\)', 1) AS INTEGER) AS released_year FROM movies)),
item_stats AS (
  SELECT "movieId", count(*) AS n, avg(rating) AS mean, stddev_samp(rating) AS dev FROM ratings GROUP BY 1),
user_stats AS (SELECT "userId", count(*) AS n, avg(rating) AS mean FROM ratings GROUP BY 1),
train AS (SELECT * FROM ratings WHERE ("userId" * 31 + "movieId" * 17) % 4 <> 0),
test AS (SELECT * FROM ratings WHERE ("userId" * 31 + "movieId" * 17) % 4 = 0),
train_items AS (SELECT "movieId", count(*) AS n, avg(rating) AS mean, max("timestamp") AS newest FROM train GROUP BY 1),
train_users AS (SELECT "userId", count(*) AS n, avg(rating) AS mean FROM train GROUP BY 1),
candidates AS (
  SELECT * FROM (
    SELECT u."userId", i."movieId", i.n::DOUBLE AS prediction,
           row_number() OVER (PARTITION BY u."userId" ORDER BY i.n DESC, i."movieId") AS "rank"
    FROM train_users u CROSS JOIN train_items i
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t."userId" = u."userId" AND t."movieId" = i."movieId"))
  WHERE "rank" <= 50),
recos AS (SELECT * FROM candidates WHERE "rank" <= 10),
lists AS (
  SELECT * FROM (
    SELECT "userId", "movieId", row_number() OVER (PARTITION BY "userId" ORDER BY prediction DESC, "movieId") AS "rank"
    FROM test_predictions) WHERE "rank" <= 10),
overall AS (SELECT avg(rating) AS mean FROM train),
test_predictions AS (
  SELECT t.*, u.mean + i.mean - (SELECT mean FROM overall) AS prediction
  FROM test t JOIN train_users u USING ("userId") JOIN train_items i USING ("movieId")),
candidate_predictions AS (
  SELECT c."userId", c."movieId", i.newest AS "timestamp", u.mean + i.mean - (SELECT mean FROM overall) AS prediction
  FROM candidates c JOIN train_users u USING ("userId") JOIN train_items i USING ("movieId")),
asked AS (
  SELECT DISTINCT r."movieId" AS i1, t."movieId" AS i2 FROM lists r JOIN train t USING ("userId")),
together AS (
  SELECT a."movieId" AS i1, b."movieId" AS i2, count(*) AS shared, sum(a.rating * b.rating) AS sxy
  FROM train a JOIN train b USING ("userId") GROUP BY 1, 2),
sims AS (
  SELECT t.i1, t.i2, t.shared / (sqrt(n1.n) * sqrt(n2.n)) AS sim FROM together t
  JOIN train_items n1 ON n1."movieId" = t.i1 JOIN train_items n2 ON n2."movieId" = t.i2),
vectors AS (SELECT vec_id AS "movieId", embedding::DOUBLE[] AS f FROM embeddings),
feature_sims AS (
  SELECT a."movieId" AS i1, b."movieId" AS i2, list_cosine_similarity(a.f, b.f) AS sim
  FROM vectors a CROSS JOIN vectors b),
list_pairs AS (
  SELECT a."userId", a."movieId" AS i1, b."movieId" AS i2
  FROM lists a JOIN lists b ON a."userId" = b."userId" AND a."movieId" <= b."movieId"),
intralist AS (
  SELECT p."userId", avg(coalesce(s.sim, 0)) AS mean_similarity
  FROM list_pairs p LEFT JOIN sims s ON s.i1 = p.i1 AND s.i2 = p.i2 WHERE p.i1 <> p.i2 GROUP BY 1),
intralist_features AS (
  SELECT p."userId", avg(coalesce(s.sim, 0)) AS mean_similarity
  FROM list_pairs p LEFT JOIN feature_sims s ON s.i1 = p.i1 AND s.i2 = p.i2 WHERE p.i1 <> p.i2 GROUP BY 1),
novelties AS (SELECT "movieId", -log2(n / (SELECT sum(n) FROM train_items)) AS item_novelty FROM train_items),
serendipities AS (
  SELECT r."userId", r."movieId", 1 - avg(coalesce(s.sim, 0)) AS user_item_serendipity
  FROM lists r JOIN train t USING ("userId") LEFT JOIN sims s ON s.i1 = r."movieId" AND s.i2 = t."movieId"
  GROUP BY 1, 2),
serendipities_features AS (
  SELECT r."userId", r."movieId", 1 - avg(coalesce(s.sim, 0)) AS user_item_serendipity
  FROM lists r JOIN train t USING ("userId") LEFT JOIN feature_sims s ON s.i1 = r."movieId" AND s.i2 = t."movieId"
  GROUP BY 1, 2),
user_serendipities AS (
  SELECT "userId", avg(user_item_serendipity) AS user_serendipity FROM serendipities GROUP BY 1),
rating_scores AS (
  SELECT sqrt(avg((rating - prediction) ** 2)) AS rmse, avg(abs(rating - prediction)) AS mae,
         1 - avg((rating - prediction) ** 2) / var_pop(rating) AS rsquared,
         1 - var_samp(rating - prediction) / var_samp(rating) AS exp_var
  FROM test_predictions),
user_factors AS (
  SELECT "userId", list(x ORDER BY i) AS f FROM (
    SELECT "userId", i, avg(f[i]) AS x
    FROM train JOIN vectors USING ("movieId"), unnest(range(1, len(f) + 1)) AS t(i) GROUP BY 1, 2) GROUP BY 1),
spread AS (
  SELECT -sum(p * log2(p)) AS distributional_coverage
  FROM (SELECT count(*) / (SELECT count(*) FROM lists) AS p FROM lists GROUP BY "movieId")),
coverage AS (
  SELECT (SELECT count(DISTINCT "movieId") FROM lists) / (SELECT count(*) FROM train_items) AS catalog_coverage),
reco_novelty AS (
  SELECT sum(coalesce(item_novelty, 0)) / count(*) AS novelty FROM lists LEFT JOIN novelties USING ("movieId"))
"""

_GENRE_PREFERENCES = """
prefs(profile, genre) AS (VALUES
  ('plain', 'ECONOMY'), ('plain', 'red'), ('plain', 'bolt'),
  ('repeated', 'SMALL'), ('repeated', 'small'), ('repeated', 'ring'), ('repeated', 'ring'),
  ('partly known', 'blue'), ('partly known', 'gear'), ('partly known', 'Unheard-Of'), ('unknown', 'Unheard-Of')),
pref_counts AS (
  SELECT profile, genre, count(*) AS c FROM prefs WHERE genre IN (SELECT genre FROM genre_rows) GROUP BY 1, 2),
pref_lengths AS (SELECT profile, sqrt(sum(c * c)) AS len FROM pref_counts GROUP BY 1),
movie_counts AS (SELECT "movieId", genre, count(*) AS c FROM genre_rows GROUP BY 1, 2),
movie_lengths AS (SELECT "movieId", sqrt(sum(c * c)) AS len FROM movie_counts GROUP BY 1),
dots AS (
  SELECT profile, m."movieId", sum(p.c * m.c) AS d FROM pref_counts p JOIN movie_counts m USING (genre) GROUP BY 1, 2),
cosines AS (
  SELECT l.profile, m."movieId", coalesce(d.d, 0) / (l.len * m.len) AS similarity
  FROM pref_lengths l CROSS JOIN movie_lengths m
  LEFT JOIN dots d ON d.profile = l.profile AND d."movieId" = m."movieId")
"""


def _select(body: str, extra: str = "") -> str:
    """``body`` with those of the tables that it needs, directly or through others.

    A table of ``extra`` replaces one of the same name.
    """
    tables = {}
    for text in (_TABLES, extra):
        heads = list(re.finditer(r"^([a-z_]+)(\([a-z, ]+\))? AS \(", text, re.M))
        for head, after in zip(heads, [*heads[1:], None]):
            sql = text[head.end() - 1 : after.start() if after else None].strip().rstrip(",")
            tables[head[1]] = (head[1] + (head[2] or ""), sql)
    used: dict[str, str] = {}

    def need(text: str) -> None:
        for name, (head, sql) in tables.items():
            if name not in used and re.search(rf"\b{name}\b", text) and text is not sql:
                need(sql)
                used[name] = f"{head} AS MATERIALIZED {sql}"

    need(body)
    return "WITH " + ",\n".join(used.values()) + f"\n{body}" if used else body


def _ranking_tables(predictions: str, order: str, where: str) -> str:
    """Per-user lists of ``predictions`` and their scores against the test rows."""
    return f"""
ranked AS (
  SELECT "userId", "movieId", row_number() OVER (PARTITION BY "userId" ORDER BY {order} DESC, "movieId") AS place
  FROM {predictions}),
listed AS (SELECT * FROM {where}),
relevant AS (SELECT "userId", count(*) AS n FROM test GROUP BY 1),
hits AS (
  SELECT l."userId", l.place, row_number() OVER (PARTITION BY l."userId" ORDER BY l.place) AS seen
  FROM listed l JOIN test t ON t."userId" = l."userId" AND t."movieId" = l."movieId"),
per_user AS (
  SELECT "userId", count(*) FILTER (place <= 10) AS hits, sum(1 / ln(place + 1)) FILTER (place <= 10) AS dcg,
         sum(seen / place) AS gains, sum(seen / place) FILTER (place <= 10) AS gains_at_k
  FROM hits GROUP BY 1),
ranking_scores AS (
  SELECT avg(coalesce(hits, 0) / 10) AS precision_at_k, avg(coalesce(hits, 0) / n) AS recall_at_k,
         avg(coalesce(dcg, 0) / list_sum([1 / ln(i + 1) FOR i IN range(1, least(n, 10) + 1)])) AS ndcg_at_k,
         avg(coalesce(gains, 0) / n) AS map, avg(coalesce(gains_at_k, 0) / least(n, 10)) AS map_at_k
  FROM (SELECT DISTINCT "userId" FROM listed) JOIN relevant USING ("userId") LEFT JOIN per_user USING ("userId"))
"""


def _ranking(predictions: str, order: str, where: str = "ranked WHERE place <= 10") -> str:
    return _select(
        """SELECT round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k,
       round(ndcg_at_k, 6) AS ndcg_at_k, round(map, 6) AS map, round(map_at_k, 6) AS map_at_k FROM ranking_scores""",
        _ranking_tables(predictions, order, where),
    )


def _relevant(order: str, where: str, keep: str) -> str:
    return _select(f"""
SELECT "userId", "movieId", "rank" FROM (
  SELECT "userId", "movieId", row_number() OVER (PARTITION BY "userId" ORDER BY {order} DESC, "movieId") AS "rank"
  FROM test_predictions WHERE {where}) WHERE {keep}""")


def _popular(metric: str, name: str) -> str:
    return _select(f"""
SELECT DISTINCT m."movieId", title, genres, {metric} AS {name}
FROM movies m JOIN item_stats s USING ("movieId") WHERE s.n >= 20 AND s.dev IS NOT NULL""")


def _five_numbers(source: str, column: str = "n") -> str:
    names = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}
    quantiles = ", ".join(f"quantile_disc({column}, {share}) AS {name}" for name, share in names.items())
    logs = ", ".join(f"round(ln({name}), 6) AS ln_{name}" for name in names)
    return _select(f"""
SELECT {", ".join(names) if column == "n" else ", ".join(f"round({name}, 6) AS {name}" for name in names)}, round(mean, 6) AS mean, {logs}
FROM (SELECT {quantiles}, avg({column}) AS mean FROM (SELECT n, mean AS average FROM {source}))""")


def _pearson(entity: str, other: str) -> str:
    """Top 50 correlated partners of each entity as table ``neighbors``."""
    return f"""
lengths AS (SELECT count(DISTINCT "{other}") AS n FROM ratings),
sums AS (SELECT "{entity}" AS e, sum(rating) AS s, sum(rating * rating) AS q FROM ratings GROUP BY 1),
products AS (
  SELECT a."{entity}" AS e, b."{entity}" AS neighbor, sum(a.rating * b.rating) AS sxy
  FROM ratings a JOIN ratings b ON a."{other}" = b."{other}" AND a."{entity}" <> b."{entity}" GROUP BY 1, 2),
correlations AS (
  SELECT p.e, p.neighbor, (n * sxy - x.s * y.s) / sqrt((n * x.q - x.s * x.s) * (n * y.q - y.s * y.s)) AS r
  FROM products p JOIN sums x ON x.e = p.e JOIN sums y ON y.e = p.neighbor, lengths
  WHERE (n * x.q - x.s * x.s) * (n * y.q - y.s * y.s) > 0),
neighbors AS (
  SELECT * FROM (
    SELECT e, neighbor, r, row_number() OVER (PARTITION BY e ORDER BY r DESC, neighbor) AS "rank" FROM correlations)
  WHERE "rank" <= 50)
"""


# All partners of each held-out item, dense; without a common user the correlation is that of the sums.
_COMPLETE = """
lengths AS (SELECT count(DISTINCT "userId") AS n FROM test),
sums AS (
  SELECT e, s, v, round(s / sqrt(v), 12) AS u FROM (
    SELECT "movieId" AS e, sum(rating) AS s, any_value(n) * sum(rating * rating) - sum(rating) ** 2 AS v,
           1e-12 * any_value(n) * sum(rating * rating) AS least
    FROM test, lengths GROUP BY 1) WHERE v > least),
products AS (
  SELECT a."movieId" AS e, b."movieId" AS neighbor, sum(a.rating * b.rating) AS sxy
  FROM test a JOIN test b ON a."userId" = b."userId" AND a."movieId" <> b."movieId" GROUP BY 1, 2),
correlations AS (
  SELECT x.e, y.e AS neighbor, CASE WHEN sxy IS NULL THEN -x.u * y.u ELSE (n * sxy - x.s * y.s) / sqrt(x.v * y.v) END AS r
  FROM sums x CROSS JOIN sums y CROSS JOIN lengths LEFT JOIN products p ON p.e = x.e AND p.neighbor = y.e WHERE x.e <> y.e),
nearest AS (
  SELECT * FROM (
    SELECT e, neighbor, r, row_number() OVER (PARTITION BY e ORDER BY r DESC, neighbor) AS "rank" FROM correlations)
  WHERE "rank" <= 100)
"""


_RECOMMENDED = """
weighted AS (
  SELECT n.e AS "userId", t."movieId", round(sum(t.rating * n.r) / sum(n.r), 9) AS predicted_rating
  FROM neighbors n JOIN ratings t ON t."userId" = n.neighbor GROUP BY 1, 2 HAVING sum(n.r) <> 0),
unseen AS (
  SELECT w.*, row_number() OVER (PARTITION BY "userId" ORDER BY predicted_rating DESC, "movieId") AS "rank"
  FROM weighted w
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r."userId" = w."userId" AND r."movieId" = w."movieId"))
"""


_RATINGS = _select('SELECT "userId", "movieId", round(rating, 6) AS rating, "timestamp" FROM ratings')


def _rejected(kind: str, sep: str) -> str:
    """The bad lines that the written files hold, and why they are bad."""
    lines = {
        "'u' || k || '~1~3.5~100'": "no valid userId",
        "k || '~2~four~later'": "no valid rating, timestamp",
        "k || '~3~3.5'": "no valid timestamp",
        "k || '~4~3.5~100~more'": "wrong number of fields",
        "k || '~5~~100'": "no valid rating",
    }
    ratings = [f"SELECT 'ratings.{kind}' AS file, {line} AS line, '{why}' AS reason FROM (SELECT n_nationkey::VARCHAR AS k FROM nation)" for line, why in lines.items()]
    movies = [
        f"SELECT 'movies.{kind}', r_name || '~A Title (1999)~Drama', 'no valid movieId' FROM region",
        f"SELECT 'movies.{kind}', r_regionkey::VARCHAR || '~No Genre (1999)', 'no valid genres' FROM region",
    ]
    return " UNION ALL ".join([*ratings, *movies]).replace("~", sep)


# Queries that take another path to the same result.
_SAME = {
    "cooccurrence_similarity_long_histories": "cooccurrence_similarity",
    "intralist_similarity_long_lists": "intralist_similarity",
    "user_item_serendipity_long_lists": "user_item_serendipity",
    "pearson_neighbors_large_entities": "pearson_neighbors",
    "seen_overlap_bitmaps": "seen_overlap",
    "preprocess_ratings_laid_out": "preprocess_ratings",
    "rating_metrics_laid_out": "rating_metrics",
    "catalog_coverage_bitmaps": "catalog_coverage",
}


def statements() -> dict[str, str]:
    found = _statements()
    found["report_json"] = f"SELECT metric, score FROM (UNPIVOT ({found['evaluation_report']}) ON * INTO NAME metric VALUE score)"
    return found | {name: found[same] for name, same in _SAME.items()}


def _statements() -> dict[str, str]:
    return {
        "ratings_view": _select('SELECT "userId", "movieId", round(rating, 6) AS rating, "timestamp" FROM ratings'),
        "movies_view": _select("SELECT * FROM movies"),
        "read_csv_ratings": _RATINGS,
        "read_dat_ratings": _RATINGS,
        # Ids are found to be integers, as all of them are small.
        "read_inferred_ratings": _RATINGS,
        "read_csv_movies": _select(
            """SELECT "movieId", replace(title, ' (', ', The "Best" (') AS title, genres FROM movies"""
        ),
        "read_dat_movies": _select("SELECT * FROM movies"),
        "rejected_lines": " UNION ALL ".join(_rejected(kind, sep) for kind, sep in (("csv", ","), ("dat", "::"))),
        "dataset_sizes": _select("""
SELECT (SELECT count(*) FROM ratings) AS number_of_ratings, (SELECT count(*) FROM user_stats) AS number_of_users,
       (SELECT count(*) FROM item_stats) AS number_of_rated_movies, (SELECT count(*) FROM movies) AS number_of_movies"""),
        "rating_timespan": _select("""
SELECT round(d, 6) AS timespan_in_days, round(d / 365.25, 6) AS timespan_in_years
FROM (SELECT (max("timestamp") - min("timestamp")) / 86400 AS d FROM ratings)"""),
        "five_number_items": _five_numbers('item_stats JOIN movies USING ("movieId")'),
        "five_number_users": _five_numbers("user_stats"),
        "five_number_means": _five_numbers("item_stats", "average"),
        "genre_distribution": _select("SELECT genre, count(*) AS number_of_movies FROM genre_rows GROUP BY 1"),
        "genre_count": _select(
            "SELECT count(DISTINCT genre) AS n_genres FROM genre_rows WHERE genre <> '(no genres listed)'"
        ),
        "genre_rating": _select(
            'SELECT genre, round(avg(mean), 6) AS rating FROM genre_rows JOIN item_stats USING ("movieId") GROUP BY 1'
        ),
        "ratings_vs_age": _select("""
SELECT "movieId", title, n AS number_of_rating_per_movie, movie_age
FROM movies JOIN item_stats USING ("movieId") JOIN ages USING ("movieId") WHERE movie_age < 200"""),
        "genre_trends": _select("""
SELECT released_year, genre, count(*) AS number_of_ratings
FROM ratings JOIN movies USING ("movieId") JOIN ages USING ("movieId") JOIN genre_rows USING ("movieId")
WHERE movie_age < 200 AND genres <> '(no genres listed)' GROUP BY 1, 2"""),
        "user_genre_profile": _select("""
SELECT "userId", genre, count(*) AS number_of_movies FROM ratings JOIN genre_rows USING ("movieId") GROUP BY 1, 2"""),
        "ratings_per_item": _select("""
SELECT "movieId", n AS number_of_rating_per_movie, round(mean, 6) AS average_rating_per_movie,
       round(dev, 6) AS standard_deviation_rating_per_movie FROM item_stats"""),
        "ratings_per_user": _select("""
SELECT "userId", n AS number_of_rating_per_user, round(mean, 6) AS average_rating_per_user FROM user_stats"""),
        "movie_age": _select("SELECT * FROM ages"),
        "preprocess_ratings": _select("""
SELECT r."userId", r."movieId", round(rating - u.mean, 6) AS rating, "timestamp",
       i.n AS number_of_rating_per_movie, round(i.mean, 6) AS average_rating_per_movie,
       round(i.dev, 6) AS standard_deviation_rating_per_movie, u.n AS number_of_rating_per_user,
       round(u.mean, 6) AS average_rating_per_user, released_year, movie_age
FROM ratings r JOIN item_stats i USING ("movieId") JOIN user_stats u USING ("userId") JOIN ages a USING ("movieId")
WHERE i.n >= 20 AND u.n >= 30 AND movie_age <= 100"""),
        "train_test_split": _select("""
SELECT *, 'train' AS part FROM train UNION ALL SELECT *, 'test' AS part FROM test"""),
        "popular_by_count": _popular("s.n", "number_of_rating_per_movie"),
        "popular_by_mean": _popular("round(s.mean, 6)", "average_rating_per_movie"),
        "popular_by_stddev": _popular("round(s.dev, 6)", "standard_deviation_rating_per_movie"),
        "genre_catalog": _select("SELECT DISTINCT genre FROM genre_rows"),
        "genre_recommend": _select(
            """
SELECT profile, "movieId", title, genres, round(similarity, 6) AS similarity, "rank" FROM (
  SELECT c.*, title, genres, row_number() OVER (PARTITION BY profile ORDER BY similarity DESC, "movieId") AS "rank"
  FROM cosines c JOIN movies USING ("movieId")) WHERE "rank" <= 10""",
            _GENRE_PREFERENCES,
        ),
        "unseen_candidates": _select("SELECT * FROM candidates"),
        "recommend_popular": _select("SELECT * FROM recos"),
        "predict_by_means": _select("""
SELECT "userId", "movieId", round(rating, 6) AS rating, "timestamp", round(prediction, 6) AS prediction
FROM test_predictions"""),
        "rating_metrics": _select("""
SELECT round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(rsquared, 6) AS rsquared, round(exp_var, 6) AS exp_var
FROM rating_scores"""),
        "relevant_top_k": _relevant("prediction", "true", '"rank" <= 10'),
        "relevant_by_threshold": _relevant("prediction", "prediction >= 3.0", "true"),
        "relevant_by_timestamp": _relevant('"timestamp"', "true", '"rank" <= 10'),
        "ranking_metrics": _ranking("candidate_predictions", "prediction"),
        "ranking_metrics_by_threshold": _ranking(
            "(SELECT * FROM candidate_predictions WHERE prediction >= 3.0)", "prediction", "ranked"
        ),
        "ranking_metrics_by_timestamp": _ranking("candidate_predictions", '"timestamp"'),
        "seen_overlap": _select("""
SELECT count(*) AS overlap FROM (SELECT DISTINCT "userId", "movieId" FROM ratings) JOIN train USING ("userId", "movieId")"""),
        "item_pairs": _select("SELECT * FROM list_pairs"),
        "rating_tiles": _select("""
SELECT "userId" // 64 AS row_tile, "movieId" // 64 AS col_tile, CASE WHEN count(*) >= 1024 THEN 'dense' ELSE 'sparse' END AS kind,
       count(*)::INTEGER AS cells, round(sum(rating), 6) AS total
FROM ratings GROUP BY 1, 2"""),
        "rating_matrix_dense": _select("""
SELECT "userId", col_tile, array_to_string([coalesce(m[p], 0.0::DOUBLE)::VARCHAR FOR p IN range(64)], ' ') AS row_values FROM (
  SELECT "userId", "movieId" // 64 AS col_tile, map_from_entries(list(("movieId" % 64, rating))) AS m FROM ratings GROUP BY 1, 2)"""),
        "tile_column_totals": _select("""
SELECT "movieId", count(*) AS n, round(sum(rating), 6) AS total, round(sum(rating * rating), 6) AS squares FROM ratings GROUP BY 1"""),
        "tile_centred_cells": _select("""
SELECT "userId", "movieId", round(rating - mean, 6) AS rating FROM ratings JOIN item_stats USING ("movieId")"""),
        "cooccurrence_similarity": _select("""
SELECT i1, i2, round(coalesce(sim, 0), 6) AS sim FROM asked LEFT JOIN sims USING (i1, i2)"""),
        "feature_similarity": _select("SELECT i1, i2, round(sim, 6) AS sim FROM asked JOIN feature_sims USING (i1, i2)"),
        "feature_neighbors": _select("""
SELECT i1 AS "movieId", i2 AS neighbor, round(sim, 6) AS sim, "rank" FROM (
  SELECT i1, i2, round(sim, 9) AS sim, row_number() OVER (PARTITION BY i1 ORDER BY round(sim, 9) DESC, i2) AS "rank"
  FROM feature_sims WHERE i1 <> i2) WHERE "rank" <= 10"""),
        "intralist_similarity": _select('SELECT "userId", round(mean_similarity, 6) AS mean_similarity FROM intralist'),
        "intralist_similarity_by_features": _select(
            'SELECT "userId", round(mean_similarity, 6) AS mean_similarity FROM intralist_features'
        ),
        "user_diversity": _select('SELECT "userId", round(1 - mean_similarity, 6) AS user_diversity FROM intralist'),
        "diversity": _select("SELECT round(avg(1 - mean_similarity), 6) AS diversity FROM intralist"),
        "item_novelty": _select('SELECT "movieId", round(item_novelty, 6) AS item_novelty FROM novelties'),
        "novelty": _select("SELECT round(novelty, 6) AS novelty FROM reco_novelty"),
        "user_item_serendipity": _select("""
SELECT "userId", "movieId", round(user_item_serendipity, 6) AS user_item_serendipity FROM serendipities"""),
        "user_item_serendipity_by_relevance": _select("""
SELECT s."userId", s."movieId", round(user_item_serendipity / "rank", 6) AS user_item_serendipity
FROM serendipities s JOIN lists l ON l."userId" = s."userId" AND l."movieId" = s."movieId" """),
        "user_item_serendipity_by_features": _select("""
SELECT "userId", "movieId", round(user_item_serendipity, 6) AS user_item_serendipity FROM serendipities_features"""),
        "user_serendipity": _select('SELECT "userId", round(user_serendipity, 6) AS user_serendipity FROM user_serendipities'),
        "serendipity": _select("SELECT round(avg(user_serendipity), 6) AS serendipity FROM user_serendipities"),
        "catalog_coverage": _select("SELECT round(catalog_coverage, 6) AS catalog_coverage FROM coverage"),
        "distributional_coverage": _select(
            "SELECT round(distributional_coverage, 6) AS distributional_coverage FROM spread"
        ),
        "rating_matrix": _select(
            'SELECT "userId", "movieId", round(avg(rating), 6) AS rating FROM ratings GROUP BY 1, 2'
        ),
        "item_pearson": _select(
            """
SELECT i1, i2, round(CASE WHEN v1 * v2 > 0 THEN (n * coalesce(sxy, 0) - s1 * s2) / sqrt(v1 * v2) END, 6) AS r
FROM (SELECT a.i1, a.i2, t.sxy, x.s AS s1, y.s AS s2, n, n * x.q - x.s * x.s AS v1, n * y.q - y.s * y.s AS v2
      FROM asked a LEFT JOIN together t ON t.i1 = a.i1 AND t.i2 = a.i2
      JOIN train_sums x ON x.e = a.i1 JOIN train_sums y ON y.e = a.i2, (SELECT count(*) AS n FROM train_users))""",
            'train_sums AS (SELECT "movieId" AS e, sum(rating) AS s, sum(rating * rating) AS q FROM train GROUP BY 1)',
        ),
        "pearson_neighbors": _select(
            'SELECT e AS "movieId", neighbor, round(r, 6) AS r, "rank" FROM neighbors', _pearson("movieId", "userId")
        ),
        "pearson_neighbors_complete": _select(
            'SELECT e AS "movieId", neighbor, round(r, 6) AS r, "rank" FROM nearest', _COMPLETE
        ),
        "user_pearson": _select(
            'SELECT e AS "userId", neighbor, round(r, 6) AS r, "rank" FROM neighbors', _pearson("userId", "movieId")
        ),
        "pearson_recommend": _select(
            """
SELECT "userId", "movieId", round(predicted_rating, 6) AS predicted_rating, "rank" FROM unseen WHERE "rank" <= 10""",
            _pearson("userId", "movieId") + "," + _RECOMMENDED,
        ),
        "factor_predict": _select("""
SELECT "userId", "movieId", round(rating, 6) AS rating, "timestamp",
       round(list_dot_product(u.f, v.f)::FLOAT::DOUBLE, 6) AS prediction
FROM test JOIN user_factors u USING ("userId") JOIN vectors v USING ("movieId")"""),
        "factor_topk_unseen": _select("""
SELECT "userId", "movieId", round(prediction, 6) AS prediction, "rank" FROM (
  SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY prediction DESC, "movieId") AS "rank" FROM (
    SELECT u."userId", v."movieId", list_dot_product(u.f, v.f)::FLOAT::DOUBLE AS prediction
    FROM user_factors u CROSS JOIN vectors v
    WHERE v."movieId" IN (SELECT "movieId" FROM train_items)
      AND NOT EXISTS (SELECT 1 FROM train t WHERE t."userId" = u."userId" AND t."movieId" = v."movieId")))
WHERE "rank" <= 10"""),
        "evaluation_report": _select(
            """
SELECT round(rmse, 6) AS rmse, round(mae, 6) AS mae, round(rsquared, 6) AS rsquared, round(exp_var, 6) AS exp_var,
       round(precision_at_k, 6) AS precision_at_k, round(recall_at_k, 6) AS recall_at_k,
       round(ndcg_at_k, 6) AS ndcg_at_k, round(map, 6) AS map, round(map_at_k, 6) AS map_at_k,
       round(distributional_coverage, 6) AS distributional_coverage, round(catalog_coverage, 6) AS catalog_coverage,
       round((SELECT avg(user_serendipity) FROM user_serendipities), 6) AS serendipity, round(novelty, 6) AS novelty,
       round((SELECT avg(1 - mean_similarity) FROM intralist), 6) AS diversity
FROM rating_scores, ranking_scores, spread, coverage, reco_novelty""",
            _ranking_tables("recos", "prediction", "ranked WHERE place <= 10")
            + ',\nlists AS (SELECT "userId", "movieId", "rank" FROM recos)',
        ),
    }
