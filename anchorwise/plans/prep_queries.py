"""Registered cleaning, anchor and prediction-feature queries, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import VENUE_SPEC, clean_key, clean_name, conform, normalize_result, parse_date
from ..operators import anchors as A
from ..operators import features as FE
from ..operators import reports as R
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import oracle_features as OF
from .views_sql import with_views

TRAIN_CUTOFF, TEST_START, TEST_END = "2022-07-01", "2022-07-01", "2022-08-01"
SAMPLE_N = 1000


def _raw_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates rendered the ways raw files carry them: yyyyMMdd, ISO, slashes, and an invalid day."""
    return read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), raw_date().alias("raw_date"))


def raw_date() -> Column:
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    return (F.when(k % 4 == 0, F.date_format(d, "yyyyMMdd")).when(k % 4 == 1, F.date_format(d, "yyyy-MM-dd"))
           .when(k % 4 == 2, F.date_format(d, "yyyy/MM/dd"))
           .otherwise(F.when(k % 3 == 0, F.lit("20240132")).otherwise(F.date_format(d, "yyyyMMdd"))))


def clean_dates(spark, sf):
    r = _raw_dates(spark, sf)
    p = parse_date(F.col("raw_date"))
    return r.select("order_id", "raw_date", p.alias("parsed_date"), F.year(p).alias("year"),
                    F.date_sub(p, 1).alias("day_before"), p.isNotNull().alias("valid"))


def conform_columns(spark, sf):
    """Venue stats under alias names (one column present under two aliases, one absent) -> canonical."""
    v = fx.venue_stats(spark, sf)
    aliased = v.select(
        F.col("venue_id").alias("ground_id"),
        F.col("total_matches_venue").alias("matches_played"),
        F.when(F.col("venue_id") % 2 == 0, F.col("highest_score_venue")).alias("highest_score"),
        F.col("highest_score_venue").alias("max_score"),
        F.col("lowest_score_venue").alias("min_score"),
    )
    c = conform(aliased, VENUE_SPEC)
    return c.select(*VENUE_SPEC.keys())


def clean_result_labels(spark, sf):
    ms = fx.matchstat(spark, sf)
    return ms.select("team_id", "match_id", F.col("result").alias("raw_result"),
                     normalize_result(F.col("result")).alias("result"))


def clean_profile_keys(spark, sf):
    p = fx.profiles(spark, sf)
    out = p.select(clean_key(F.col("player_id")).alias("player_id"), clean_name(F.col("name")).alias("name"),
                   F.trim(F.col("role")).alias("role"), F.upper(F.col("role")).alias("role_upper"))
    return out.where(F.col("player_id").isNotNull())


def dataset_profile(spark, sf):
    return R.dataset_profile(fx.innings(spark, sf))


def training_anchors(spark, sf):
    return A.training_anchors(fx.innings(spark, sf), TRAIN_CUTOFF)


def test_anchors(spark, sf):
    return A.test_anchors(fx.innings(spark, sf), TEST_START, TEST_END)


def sample_anchors(spark, sf):
    return A.sample_anchors(A.training_anchors(fx.innings(spark, sf), TRAIN_CUTOFF), SAMPLE_N)


def prediction_anchors(spark, sf):
    return A.prediction_anchors(fx.requests(spark, sf))


def opponent_squads(spark, sf):
    return A.opponent_squads(fx.requests(spark, sf), {
        "opponent_squad": lambda squad: F.array_join(squad.cast("array<string>"), ","), "opponent_count": F.size})


def prediction_features(spark, sf):
    """P10 -> M21 -> P11: request anchors, all 30 features, invalid anchors replaced by the default row."""
    ds = fx.load_datasets(spark, sf)
    anc = A.prediction_anchors(fx.requests(spark, sf))
    f = FE.build_features(anc, ds.innings, ds.deliveries, ds.matchstat, ds.venue_stats,
                          keep=["request_id", "player_id", "team_no"], with_prior_venue=False)
    f = FE.replace_invalid_with_defaults(f)
    return f.select("request_id", "player_id", "team_no", *FE.FEATURES)


def venue_crosswalk(spark, sf):
    """J15 + S9: a second id system for grounds (names from nation/region), joined both ways with anti-join flags."""
    return crosswalk_joined(spark, sf, crosswalk_table(spark, sf))


def crosswalk_table(spark: SparkSession, sf: str) -> DataFrame:
    n, r = read_table(spark, sf, "nation"), read_table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        (F.col("n_nationkey") * 7 + 3).cast("long").alias("ground_id_howstat"),
        F.col("n_name").alias("ground_name_howstat"),
        F.col("n_nationkey").cast("long").alias("ground_id_espn"),
        F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")).alias("ground_name_espn"),
        F.concat(F.lit(" "), F.col("r_name")).alias("City"),
    )


def crosswalk_joined(spark: SparkSession, sf: str, cw: DataFrame) -> DataFrame:
    grounds = fx.innings(spark, sf).select(F.col("ground_id").alias("venue_id")).distinct()
    vs = fx.venue_stats(spark, sf).select("venue_id", F.lit(True).alias("in_venue_stats"))
    j = grounds.join(cw, grounds.venue_id == cw.ground_id_espn, "left").join(vs, "venue_id", "left")
    return j.select("venue_id", "ground_id_howstat", "ground_name_espn", F.trim(F.col("City")).alias("city"),
                    F.col("ground_id_espn").isNotNull().alias("in_crosswalk"),
                    F.coalesce(F.col("in_venue_stats"), F.lit(False)).alias("in_venue_stats"))


QUERIES = {
    "clean_dates": clean_dates,
    "conform_columns": conform_columns,
    "clean_result_labels": clean_result_labels,
    "clean_profile_keys": clean_profile_keys,
    "dataset_profile": dataset_profile,
    "training_anchors": training_anchors,
    "test_anchors": test_anchors,
    "sample_anchors": sample_anchors,
    "prediction_anchors": prediction_anchors,
    "opponent_squads": opponent_squads,
    "prediction_features": prediction_features,
    "venue_crosswalk": venue_crosswalk,
}


def _pred_features_sql() -> str:
    anchors = """a AS (SELECT DISTINCT request_id AS match_id, player_id, CAST(cutoff_date AS DATE) + 1 AS match_date,
       venue_id, CAST(NULL AS BIGINT) AS opposition_id, CAST(cutoff_date AS DATE) AS cutoff FROM requests)"""
    ctes = [anchors, OF.RECENT, OF.ARCHETYPE, OF.BALL, OF.OPPOSITION, OF.VENUE]
    defaults = {f"runs_match_{i}_ago": "CAST(20 AS DOUBLE)" for i in (1, 2, 3)}
    defaults.update({f"wickets_match_{i}_ago": "CAST(0 AS DOUBLE)" for i in (1, 2, 3)})
    defaults.update({f"was_out_match_{i}_ago": "1" for i in (1, 2, 3)})
    defaults.update({"data_availability": "0", "max_fantasy_score_current_year": "CAST(50 AS DOUBLE)",
                     "min_fantasy_score_current_year": "CAST(5 AS DOUBLE)"})
    for k, v in FE.DEFAULTS.items():
        if k in FE.FEATURES and k not in defaults:
            defaults[k] = str(v)
    vx = """vx AS (SELECT a.match_id, a.player_id,
   CAST((SELECT COUNT(*) FROM innings i WHERE i.player_id = a.player_id AND i.ground_id = a.venue_id) AS INTEGER)
     AS player_career_matches_at_venue FROM a)"""
    cols = []
    for f in FE.FEATURES:
        cast = "" if f.startswith(("runs_", "wickets_", "max_", "min_")) else "INTEGER"
        expr = f"CASE WHEN (bb.ball_valid AND vn.venue_valid) THEN {f} ELSE {defaults[f]} END"
        cols.append(f"CAST({expr} AS {cast}) AS {f}" if cast else f"{expr} AS {f}")
    body = with_views("innings", "deliveries", "matchstat", "venue_stats", "requests",
                      extra=",\n".join(ctes + [vx]))
    return body + f"""SELECT r.request_id, r.player_id, r.team_no, {', '.join(cols)}
FROM requests r JOIN a ON a.match_id = r.request_id AND a.player_id = r.player_id
JOIN rf ON rf.match_id = a.match_id AND rf.player_id = a.player_id
JOIN ar ON ar.match_id = a.match_id AND ar.player_id = a.player_id
JOIN bb ON bb.match_id = a.match_id AND bb.player_id = a.player_id
JOIN op ON op.match_id = a.match_id AND op.player_id = a.player_id
JOIN vn ON vn.match_id = a.match_id AND vn.player_id = a.player_id
JOIN vx ON vx.match_id = a.match_id AND vx.player_id = a.player_id"""


def oracles() -> dict[str, str]:
    raw = """rd AS (SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 4 = 0 THEN STRFTIME(o_orderdate, '%Y%m%d')
   WHEN o_orderkey % 4 = 1 THEN STRFTIME(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 4 = 2 THEN STRFTIME(o_orderdate, '%Y/%m/%d')
   WHEN o_orderkey % 3 = 0 THEN '20240132' ELSE STRFTIME(o_orderdate, '%Y%m%d') END AS raw_date FROM orders),
pd AS (SELECT order_id, raw_date, CAST(CASE WHEN REGEXP_FULL_MATCH(TRIM(raw_date), '[0-9]{8}')
   THEN TRY_STRPTIME(TRIM(raw_date), '%Y%m%d')
   ELSE COALESCE(TRY_STRPTIME(TRIM(raw_date), '%Y-%m-%d'), TRY_STRPTIME(TRIM(raw_date), '%Y/%m/%d')) END AS DATE) AS parsed_date
   FROM rd)"""
    anchors_cols = """SELECT match_id, player_id, match_date, team_id, fantasy_points, CAST(match_date - 1 AS DATE) AS cutoff_date,
  ground_id AS venue_id, opposition_id FROM innings"""
    return {
        "clean_dates": with_views(extra=raw) + """SELECT order_id, raw_date, parsed_date, CAST(YEAR(parsed_date) AS INTEGER) AS year,
  CAST(parsed_date - 1 AS DATE) AS day_before, parsed_date IS NOT NULL AS valid FROM pd""",
        "conform_columns": with_views("venue_stats") + """SELECT CAST(venue_id AS BIGINT) AS venue_id,
  CAST(160 AS DOUBLE) AS average_runs_venue, CAST(8.0 AS DOUBLE) AS runs_per_over_venue,
  CAST(total_matches_venue AS BIGINT) AS total_matches_venue,
  COALESCE(CASE WHEN venue_id % 2 = 0 THEN highest_score_venue END, highest_score_venue) AS highest_score_venue,
  lowest_score_venue, CAST(800 AS BIGINT) AS total_boundaries_venue FROM venue_stats""",
        "clean_result_labels": with_views("matchstat") + """SELECT team_id, match_id, result AS raw_result,
  CASE LOWER(result) WHEN 'win' THEN 'won' WHEN 'won' THEN 'won' WHEN 'w' THEN 'won' WHEN 'victory' THEN 'won'
  WHEN 'loss' THEN 'lost' WHEN 'lost' THEN 'lost' WHEN 'l' THEN 'lost' WHEN 'defeat' THEN 'lost' ELSE 'unknown' END AS result
FROM matchstat""",
        "clean_profile_keys": with_views("profiles") + r"""SELECT CAST(TRUNC(TRY_CAST(TRIM(player_id) AS DOUBLE)) AS BIGINT) AS player_id,
  REGEXP_REPLACE(TRIM(name), '\s+', ' ', 'g') AS name, TRIM(role) AS role, UPPER(role) AS role_upper
FROM profiles WHERE TRIM(player_id) <> 'nan' AND TRY_CAST(TRIM(player_id) AS DOUBLE) IS NOT NULL""",
        "dataset_profile": with_views("innings") + """SELECT CAST(YEAR(match_date) AS INTEGER) AS year, COUNT(*) AS n_rows,
  COUNT(DISTINCT player_id) AS n_players, COUNT(DISTINCT match_id) AS n_matches, MIN(match_date) AS first_date,
  MAX(match_date) AS last_date, COUNT(CASE WHEN fantasy_points IS NULL THEN 1 END) AS null_points,
  COUNT(CASE WHEN runs_batting IS NULL THEN 1 END) AS null_runs, '' AS missing_expected_columns
FROM innings GROUP BY CAST(YEAR(match_date) AS INTEGER)""",
        "training_anchors": with_views("innings") + anchors_cols + f"""
  WHERE fantasy_points IS NOT NULL AND match_date IS NOT NULL AND match_date < DATE '{TRAIN_CUTOFF}'""",
        "test_anchors": with_views("innings") + anchors_cols + f"""
  WHERE match_date >= DATE '{TEST_START}' AND match_date < DATE '{TEST_END}' AND fantasy_points IS NOT NULL""",
        "sample_anchors": with_views("innings") + anchors_cols + f"""
  WHERE fantasy_points IS NOT NULL AND match_date IS NOT NULL AND match_date < DATE '{TRAIN_CUTOFF}'
  ORDER BY MD5(CONCAT_WS(':', match_id, player_id, '42')), match_id, player_id LIMIT {SAMPLE_N}""",
        "prediction_anchors": with_views("requests") + """SELECT request_id, player_id, team_no, CAST(cutoff_date AS DATE) AS cutoff_date,
  CAST(cutoff_date AS DATE) + 1 AS match_date, venue_id, CAST(NULL AS BIGINT) AS opposition_id FROM requests""",
        "opponent_squads": with_views("requests", extra="""sq AS (SELECT request_id, team_no,
   LIST(player_id ORDER BY player_id) AS squad FROM requests GROUP BY request_id, team_no)""") + """SELECT r.request_id,
  r.player_id, r.team_no, ARRAY_TO_STRING(COALESCE(s.squad, []), ',') AS opponent_squad,
  CAST(LEN(COALESCE(s.squad, [])) AS INTEGER) AS opponent_count
FROM requests r LEFT JOIN sq s ON s.request_id = r.request_id AND s.team_no = 3 - r.team_no""",
        "prediction_features": _pred_features_sql(),
        "venue_crosswalk": with_views("innings", "venue_stats", extra="""cw AS (SELECT CAST(n_nationkey * 7 + 3 AS BIGINT)
   AS ground_id_howstat, CAST(n_nationkey AS BIGINT) AS ground_id_espn, n_name || ', ' || r_name AS ground_name_espn,
   ' ' || r_name AS City FROM nation JOIN region ON n_regionkey = r_regionkey)""") + """SELECT g.venue_id,
  cw.ground_id_howstat, cw.ground_name_espn, TRIM(cw.City) AS city, cw.ground_id_espn IS NOT NULL AS in_crosswalk,
  v.venue_id IS NOT NULL AS in_venue_stats
FROM (SELECT DISTINCT ground_id AS venue_id FROM innings) g LEFT JOIN cw ON cw.ground_id_espn = g.venue_id
LEFT JOIN venue_stats v ON v.venue_id = g.venue_id""",
    }
