"""The 30 point-in-time features per anchor.

Input anchors carry ``player_id, cutoff_date, venue_id, opposition_id`` plus any
key columns; history is every fact with ``match_date < cutoff_date``.

Plan shape (see ``explain``):
* player features: ONE exchange of facts + anchors + carry rows on (player,
  month bucket); the windows sort inside it. History from earlier buckets is
  computed on small per-(player, bucket) tables and enters the same pass as
  carry rows, so the anchors are not joined again afterwards;
* team features: innings pre-aggregated to (team, day) before any window; of a
  day's raw rows only the last 20 are listed, so no task collects a team-day;
* deliveries are summarised per player-day and joined to the facts before the
  pass, so the summary of the last match arrives with its record;
* lookups (a team's states by day, the venue dimension) are broadcast behind a
  measured size, else salted (``lookup``): the anchors are not shuffled again
  after the pass. Venue means are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import asof
from .lookup import latest_before, left_lookup
from .tasks import task_count
from ..functions.cleaning import normalize_result

# Fixed values that must equal the reference's for the same results:
# defaults used when a feature has no data, and the feature order.
DEFAULTS = {
    "runs_match_ago": 20.0,
    "wickets_match_ago": 0.0,
    "was_out_match_ago": 1,
    "max_fantasy_score_current_year": 50.0,
    "min_fantasy_score_current_year": 5.0,
    "scores_over_60_count_current_year": 0,
    "scores_under_15_count_current_year": 0,
    "total_matches_current_year": 0,
    "powerplay_boundaries_last_match": 2,
    "death_over_runs_last_match": 15,
    "middle_over_dots_last_match": 8,
    "total_balls_faced_last_match": 20,
    "total_boundaries_last_match": 3,
    "opposition_runs_conceded_last_match": 160,
    "opposition_wickets_taken_last_match": 6,
    "opposition_total_bowlers_used_recent": 5,
    "opposition_matches_won_last_5": 2,
    "venue_total_matches": 50,
    "venue_highest_score": 200,
    "venue_lowest_score": 120,
    "venue_total_boundaries": 800,
    "high_scoring_venue": 0,
    "player_career_matches_at_venue": 0,
}
FEATURES = [
    "runs_match_1_ago", "runs_match_2_ago", "runs_match_3_ago",
    "wickets_match_1_ago", "wickets_match_2_ago", "wickets_match_3_ago",
    "was_out_match_1_ago", "was_out_match_2_ago", "was_out_match_3_ago",
    "data_availability", "max_fantasy_score_current_year", "min_fantasy_score_current_year",
    "scores_over_60_count_current_year", "scores_under_15_count_current_year",
    "total_matches_current_year", "powerplay_boundaries_last_match",
    "death_over_runs_last_match", "middle_over_dots_last_match",
    "total_balls_faced_last_match", "total_boundaries_last_match",
    "opposition_runs_conceded_last_match", "opposition_wickets_taken_last_match",
    "opposition_total_bowlers_used_recent", "opposition_matches_won_last_5",
    "venue_total_matches", "venue_highest_score", "venue_lowest_score",
    "venue_total_boundaries", "high_scoring_venue", "player_career_matches_at_venue",
]
# Thresholds of the feature definitions (parameters, reference values).
RECENT_K = 3
SEASON_SWITCH_MAX = 2          # <= 2 matches this season -> archetype from last season
HIGH_SCORE, LOW_SCORE = 60, 15
POWERPLAY_LAST_OVER, DEATH_FIRST_OVER = 6, 16
BOWLER_ROWS, BOWLER_CAP, RESULT_ROWS = 20, 8, 5
HIGH_SCORING_VENUE = 200
# Upper estimates of the size in memory of a team's state and a venue's row, for the checks of what is broadcast.
STATE_BYTES, VENUE_BYTES = 128, 128

PASS_ROWS = 200_000  # rows of a task of the as-of pass

PARTS = ("season", "venue")

_BEFORE_ORDER = ["_t", "_kind", "_tb"]


def _facts(innings: DataFrame, deliveries: DataFrame | None = None) -> DataFrame:
    """The dated innings; with ``deliveries``, each record carries its day's ball-phase summary (``balls_of_day``)."""
    out = F.col("out")
    was_out = F.when(out.isNotNull() & (out.cast("string") != ""), 1).otherwise(0)
    dated = innings.where(F.col("match_date").isNotNull())
    summary = []
    if deliveries is not None:
        dated = dated.join(delivery_summary(deliveries), ["player_id", "match_date"], "left")
        summary = [F.col("_day_balls").alias("balls_of_day")]
    return dated.select(
        "player_id",
        F.year("match_date").alias("_yr"),
        F.col("match_date").alias("_t"),
        F.col("match_id").alias("_tb"),
        F.col("ground_id").alias("_g"),
        F.col("fantasy_points").alias("_fp"),
        F.struct(
            F.col("match_date").alias("d"),
            F.col("runs_batting").cast("double").alias("runs"),
            F.col("wickets_taken").cast("double").alias("wkts"),
            was_out.alias("out"),
            F.col("fours").cast("double").alias("fours"),
            F.col("sixes").cast("double").alias("sixes"),
            F.col("balls_faced").cast("double").alias("balls"),
            *summary,
        ).alias("_rec"),
    )


def _bucket(d: Column, bucket: str) -> Column:
    """Window bucket of a day; buckets nest inside seasons (calendar years)."""
    if bucket == "season":
        return F.year(d)
    if bucket == "month":
        return F.year(d) * 12 + F.month(d) - 1
    raise ValueError(f"bucket must be 'season' or 'month', not {bucket!r}")


def player_history(innings: DataFrame, anchors: DataFrame, k: int = RECENT_K, bucket: str = "month",
                   parts: Collection[str] = PARTS, deliveries: DataFrame | None = None) -> DataFrame:
    """Per anchor: last-k records, history count, season aggregates, venue counts.

    ``parts`` names what is wanted besides the last k and the count: the ``_cur_*`` and ``_prev_*`` columns ("season")
    and the ``_venue_*`` columns ("venue"). ``deliveries`` puts each day's ball-phase summary in its records (A2).

    Adds ``_hist`` (ascending array of the last k records), ``_n`` (facts
    before the cutoff) and, by ``parts``, ``_cur_*`` (this season before the cutoff), ``_prev_*``
    (whole previous season), ``_venue_prior`` and ``_venue_career``.

    Facts, anchors and carry rows are stacked and shuffled ONCE on
    (player, bucket); a bucket is a month by default, so even a player holding
    a large share of all rows is spread over one window partition per month.
    Everything before the anchor's bucket is computed on small per-(player,
    bucket) tables from the facts alone (the last k records as a per-group
    top-k limited before its shuffle; counts and season-to-date aggregates,
    which merge across buckets) and enters the same pass as *carry rows*
    keyed like the anchors' window partitions: the anchors pick them up from
    the window frame, so the large anchor table is never joined again.
    """
    if unknown := set(parts) - set(PARTS):
        raise ValueError(f"parts must be among {PARTS}, not {sorted(unknown)}")
    seasons, venues = "season" in parts, "venue" in parts
    facts = _facts(innings, deliveries).withColumn("_b", _bucket(F.col("_t"), bucket))
    anc = anchors.select(
        "*",
        F.year("cutoff_date").alias("_yr"),
        _bucket(F.col("cutoff_date"), bucket).alias("_b"),
        F.col("cutoff_date").alias("_t"),
        F.col("venue_id").alias("_g"),
    )
    rows = (facts.withColumn("_kind", F.lit(asof.FACT))
            .unionByName(anc.withColumn("_kind", F.lit(asof.ANCHOR)), allowMissingColumns=True)
            .unionByName(_player_carry(innings, facts, anc, k, bucket, seasons).withColumn("_kind", F.lit(asof.CARRY)),
                         allowMissingColumns=True))
    if venues:
        rows = rows.unionByName(_venue_carry(innings, anc, bucket).withColumn("_kind", F.lit(asof.CARRY)), allowMissingColumns=True)

    # ---- the one pass: facts + anchors + carry rows, shuffled once on (player, bucket); each task holds several sorts of
    # these wide rows, so the tasks are counted in rows: at most three an anchor (itself and two carry rows)
    part = ["player_id", "_b"]
    spark = innings.sparkSession
    tasks = task_count(spark, innings.count() + 3 * anchors.count(), PASS_ROWS)
    if tasks > 1:  # else Spark deals the few rows by the same key itself
        rows = rows.repartition(tasks, *part)
    u = rows.withColumn("_ord", asof.fact_ordinal(part, _BEFORE_ORDER))
    # at an anchor, ordinals <= its own are exactly the facts before it (and the carry rows, whose
    # ordinal is 0): the aggregates and carry picks share the ordinal ordering and its sort
    wb = Window.partitionBy(*part).orderBy("_ord").rangeBetween(Window.unboundedPreceding, 0)
    wg = asof.strictly_before(["player_id", "_b", "_g"], _BEFORE_ORDER)
    fp = F.col("_fp")
    in_bucket = [
        F.count("_rec").over(wb).alias("_bk_rows"),
        F.count(fp).over(wb).alias("_bk_pts"),
        F.max(fp).over(wb).alias("_bk_max"),
        F.min(fp).over(wb).alias("_bk_min"),
        F.count(F.when(fp > HIGH_SCORE, 1)).over(wb).alias("_bk_over"),
        F.count(F.when(fp < LOW_SCORE, 1)).over(wb).alias("_bk_under"),
    ] if seasons else []
    at_venue = [F.count("_rec").over(wg).alias("_venue_in_bucket"),
                F.first("_vcy", ignorenulls=True).over(wg).alias("_vcy")] if venues else []
    u = u.select(
        *[c for c in u.columns if c not in ("_cy", "_vcy")],
        asof.last_k_by_ordinal("_rec", part, k).alias("_in_hist"),
        F.first("_cy", ignorenulls=True).over(wb).alias("_cy"),
        *in_bucket, *at_venue,
    )
    a = u.where(F.col("_kind") == asof.ANCHOR).drop("_kind", "_rec", "_fp", "_tb")
    a = a.select("*", "_cy.*", *(["_vcy.*"] if venues else [])).drop("_cy", "_vcy")

    empty = F.array().cast(a.schema["_in_hist"].dataType)
    hist = asof.last_k(F.concat(F.coalesce("_carry_tail", empty), F.col("_in_hist")), k)
    out = [hist.alias("_hist"), (F.coalesce(F.col("_carry_n"), F.lit(0)) + F.col("_ord")).alias("_n")]
    if seasons:
        cs = F.when(F.col("_carry_season.yr") == F.col("_yr"), F.col("_carry_season"))  # same season only
        out += [
            (F.coalesce(cs["rows"], F.lit(0)) + F.col("_bk_rows")).alias("_cur_rows"),
            (F.coalesce(cs["pts"], F.lit(0)) + F.col("_bk_pts")).alias("_cur_pts"),
            F.greatest(cs["mx"], F.col("_bk_max")).alias("_cur_max"),
            F.least(cs["mn"], F.col("_bk_min")).alias("_cur_min"),
            (F.coalesce(cs["over"], F.lit(0)) + F.col("_bk_over")).alias("_cur_over"),
            (F.coalesce(cs["under"], F.lit(0)) + F.col("_bk_under")).alias("_cur_under"),
        ]
    if venues:
        out.append((F.coalesce(F.col("_venue_prior_buckets"), F.lit(0)) + F.col("_venue_in_bucket")).alias("_venue_prior"))
    return a.select(
        *[c for c in a.columns if not c.startswith(("_carry", "_bk_")) and c not in ("_in_hist", "_venue_prior_buckets",
                                                                                    "_venue_in_bucket")],
        *out,
    )


def _player_carry(innings: DataFrame, facts: DataFrame, anc: DataFrame, k: int, bucket: str, seasons: bool) -> DataFrame:
    """Carry rows (player, bucket, ``_cy``): all that the buckets before an anchor's say, from per-(player, bucket)
    tables made of partial aggregates and a per-group top-k of the facts."""
    fp = F.col("_fp")
    points = _facts(innings).withColumn("_b", _bucket(F.col("_t"), bucket))  # without the ball-phase summaries
    by = ["player_id", "_b", *(["_yr"] if seasons else [])]  # buckets nest in years
    stats = points.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *([
        F.count(fp).alias("pts"),
        F.max(fp).alias("mx"),
        F.min(fp).alias("mn"),
        F.count(F.when(fp > HIGH_SCORE, 1)).alias("over"),
        F.count(F.when(fp < LOW_SCORE, 1)).alias("under"),
    ] if seasons else []))
    wlast = Window.partitionBy("player_id", "_b").orderBy(F.col("_t").desc(), F.col("_tb").desc())
    tails = facts.withColumn("_rn", F.row_number().over(wlast)).where(F.col("_rn") <= k).groupBy("player_id", "_b").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_t", "_tb", "_rec"))), lambda x: x["_rec"]).alias("tail"))
    buckets = stats.join(tails, ["player_id", "_b"])
    ws = Window.partitionBy("player_id").orderBy("_b")
    wsy = Window.partitionBy("player_id", "_yr").orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    to_date = [F.struct(  # season to date, through this bucket
        F.col("_yr").alias("yr"),
        F.sum("rows").over(wsy).alias("rows"),
        F.sum("pts").over(wsy).alias("pts"),
        F.max("mx").over(wsy).alias("mx"),
        F.min("mn").over(wsy).alias("mn"),
        F.sum("over").over(wsy).alias("over"),
        F.sum("under").over(wsy).alias("under"),
    ).alias("_carry_season")] if seasons else []
    cum = buckets.select(
        "player_id",
        "_b",
        asof.last_k(F.flatten(F.collect_list("tail").over(ws.rowsBetween(-(k - 1), 0))), k).alias("_carry_tail"),
        F.sum("rows").over(ws.rowsBetween(Window.unboundedPreceding, 0)).alias("_carry_n"),
        *to_date,
    )
    keys = anc.select(*by).distinct()
    names = [c for c in cum.columns if c.startswith("_carry")]
    carry = asof.carry_pick(cum.withColumnsRenamed({c: f"_in{c}" for c in names}), keys.drop("_yr"), ["player_id"], "_b",
                            {c: F.last(f"_in{c}", ignorenulls=True) for c in names})
    if seasons:
        season = stats.groupBy("player_id", "_yr").agg(
            F.sum("rows").alias("_prev_rows"), F.sum("pts").alias("_prev_pts"), F.max("mx").alias("_prev_max"),
            F.min("mn").alias("_prev_min"), F.sum("over").alias("_prev_over"), F.sum("under").alias("_prev_under"))
        prev = season.withColumn("_yr", F.col("_yr") + 1)
        carry = carry.join(keys, ["player_id", "_b"]).join(prev, ["player_id", "_yr"], "left")
        names += [c for c in prev.columns if c.startswith("_prev")]
    return carry.select("player_id", "_b", F.struct(*names).alias("_cy"))


def _venue_carry(innings: DataFrame, anc: DataFrame, bucket: str) -> DataFrame:
    """Carry rows (player, ground, bucket, ``_vcy``): counts of earlier buckets, and all rows for the career count
    (which, like the reference's, also counts rows whose date did not parse: bucket null)."""
    vb = innings.where(F.col("ground_id").isNotNull()).groupBy(
        "player_id", F.col("ground_id").alias("_g"), _bucket(F.col("match_date"), bucket).alias("_b")).agg(
        F.count(F.lit(1)).alias("n"))
    vkeys = anc.where(F.col("_g").isNotNull()).select("player_id", "_g", "_b").distinct()
    wv = Window.partitionBy("player_id", "_g")
    return asof.stack(vb, vkeys).select(
        "player_id", "_g", "_b", "_kind",
        F.struct(
            F.sum(F.when(F.col("_b").isNotNull(), F.col("n"))).over(
                wv.orderBy("_b", "_kind").rowsBetween(Window.unboundedPreceding, -1)).alias("_venue_prior_buckets"),
            F.sum("n").over(wv).alias("_venue_career"),
        ).alias("_vcy"),
    ).where(F.col("_kind") == asof.ANCHOR).drop("_kind")


def recent_form_columns(k: int = RECENT_K) -> list[Column]:
    """Features 1-10 from ``_hist``/``_n`` (W1, W2, W4). Q4's season switch never changes them."""
    n = F.col("_n")
    cols = []
    for field, name, default in (
        ("runs", "runs_match_{}_ago", DEFAULTS["runs_match_ago"]),
        ("wkts", "wickets_match_{}_ago", DEFAULTS["wickets_match_ago"]),
        ("out", "was_out_match_{}_ago", DEFAULTS["was_out_match_ago"]),
    ):
        for i in range(1, k + 1):
            v = asof.kth_latest(F.col("_hist"), i)[field]
            cols.append(F.when(n >= i, v).otherwise(F.lit(default)).alias(name.format(i)))
    cols.append(F.least(n, F.lit(k)).cast("int").alias("data_availability"))
    return cols


def archetype_columns() -> list[Column]:
    """Features 11-15 with the season switch."""
    early = F.col("_cur_rows") <= SEASON_SWITCH_MAX

    def pick(cur: str, prev: str, count: bool = True) -> Column:
        p = F.coalesce(F.col(prev), F.lit(0)) if count else F.col(prev)
        return F.when(early, p).otherwise(F.col(cur))

    rows = pick("_cur_rows", "_prev_rows")
    pts = pick("_cur_pts", "_prev_pts")
    mx, mn = pick("_cur_max", "_prev_max", False), pick("_cur_min", "_prev_min", False)
    over, under = pick("_cur_over", "_prev_over"), pick("_cur_under", "_prev_under")
    real = pts > 0
    return [
        F.when(real, mx).otherwise(F.lit(DEFAULTS["max_fantasy_score_current_year"])).alias("max_fantasy_score_current_year"),
        F.when(real, mn).otherwise(F.lit(DEFAULTS["min_fantasy_score_current_year"])).alias("min_fantasy_score_current_year"),
        F.when(real, over).otherwise(F.lit(0)).cast("int").alias("scores_over_60_count_current_year"),
        F.when(real, under).otherwise(F.lit(0)).cast("int").alias("scores_under_15_count_current_year"),
        F.when(real, pts).otherwise(rows).cast("int").alias("total_matches_current_year"),
        F.when(rows == 0, "used_default").when(~real, "used_default_no_fp").otherwise("used_real_data").alias("src_archetype"),
    ]


def delivery_summary(deliveries: DataFrame) -> DataFrame:
    """Ball-phase aggregates per (batter, day) (A2); partial aggregation before the shuffle."""
    over, runs = F.col("over"), F.col("batsman_runs")
    boundary = runs.isin(4, 6)
    return deliveries.groupBy(F.col("batter_id").alias("player_id"), "match_date").agg(F.struct(
        F.count(F.lit(1)).alias("balls"),
        F.count(F.when((over <= POWERPLAY_LAST_OVER) & boundary, 1)).alias("powerplay"),
        F.coalesce(F.sum(F.when(over >= DEATH_FIRST_OVER, runs)), F.lit(0)).alias("death"),
        F.count(F.when((over >= POWERPLAY_LAST_OVER + 1) & (over <= DEATH_FIRST_OVER - 1) & (runs == 0), 1)).alias("dots"),
        F.count(F.when(boundary, 1)).alias("boundaries"),
    ).alias("_day_balls"))


def with_ball_phase(a: DataFrame) -> DataFrame:
    """Features 16-20 from the last match before the cutoff (J2, Q7-Q10), a projection of ``_hist``.

    The records carry ball-phase summaries if ``player_history`` was given the deliveries; else the defaults apply."""
    a = a.withColumn("_last", asof.kth_latest(F.col("_hist"), 1))
    names = ["powerplay_boundaries_last_match", "death_over_runs_last_match", "middle_over_dots_last_match",
             "total_balls_faced_last_match", "total_boundaries_last_match"]
    if "balls_of_day" not in a.schema["_last"].dataType.names:
        cols = [F.lit(DEFAULTS[n]).alias(n) for n in names]
        return a.select("*", *cols, F.lit("used_default_no_delivery_data").alias("src_ball"), F.lit(True).alias("_ball_ok"))
    has_hist = F.col("_n") > 0
    day = F.col("_last.balls_of_day")
    real = day.isNotNull()
    fours, sixes, runs, balls = (F.col(f"_last.{c}") for c in ("fours", "sixes", "runs", "balls"))
    fs = fours + sixes
    proxy = [
        F.least(fs.cast("int"), F.lit(6)),
        F.least((runs * F.lit(0.3)).cast("int"), F.lit(40)),
        F.greatest(F.lit(0), (balls * F.lit(0.4)).cast("int")),
        balls.cast("int"),
        fs.cast("int"),
    ]
    actual = [day[c] for c in ("powerplay", "death", "dots", "balls", "boundaries")]
    proxy_ok = fours.isNotNull() & sixes.isNotNull() & runs.isNotNull() & balls.isNotNull()
    cols = [
        F.when(~has_hist, F.lit(DEFAULTS[n])).when(real, r).otherwise(p).cast("int").alias(n)
        for n, r, p in zip(names, actual, proxy)
    ]
    src = (F.when(~has_hist, "used_default_no_delivery_data").when(real, "used_real_delivery_data")
           .otherwise("used_proxy_from_innings_data"))
    ok = ~has_hist | real | proxy_ok
    return a.select("*", *cols, src.alias("src_ball"), ok.alias("_ball_ok"))


def team_timeline(innings: DataFrame, matchstat: DataFrame | None) -> DataFrame:
    """Per team: ``_states``, ascending by day: the team's last bowling day and wins as known at the end of ``d``
    (A3-A5, W5, Q12-Q15). One row a team and one state a day on which it played, so the calendar bounds a row."""
    bowl = F.col("innings_bowling").isNotNull()
    real_team = F.col("match_date").isNotNull() & F.col("team_id").isNotNull() & (F.col("team_id") != 0)
    rows = innings.where(real_team)
    day = rows.groupBy("team_id", "match_date").agg(
        F.sum(F.when(bowl, F.col("runs_conceded"))).alias("rc"),
        F.sum(F.when(bowl, F.col("wickets_taken"))).alias("wk"),
        F.count(F.when(bowl, 1)).alias("nb"),
    )
    # only a day's last BOWLER_ROWS rows can be among the team's last BOWLER_ROWS: the rank filter bounds every list
    # and runs before the shuffle too (WindowGroupLimit), so no task collects a whole team-day
    wd = Window.partitionBy("team_id", "match_date").orderBy(F.desc("match_id"), F.desc("player_id"), F.desc("b"))
    tail = rows.select("team_id", "match_date", "match_id", "player_id", bowl.alias("b")).withColumn(
        "_r", F.row_number().over(wd)).where(F.col("_r") <= BOWLER_ROWS)
    tail = tail.groupBy("team_id", "match_date").agg(
        F.array_sort(F.collect_list(F.struct("match_id", "player_id", "b"))).alias("day_rows"))
    day = day.join(tail, ["team_id", "match_date"])
    wt = Window.partitionBy("team_id").orderBy("match_date").rowsBetween(-(BOWLER_ROWS - 1), 0)
    recent = asof.last_k(F.flatten(F.collect_list("day_rows").over(wt)), BOWLER_ROWS)
    bowlers = F.size(F.array_distinct(F.transform(F.filter(recent, lambda r: r["b"]), lambda r: r["player_id"])))
    days = day.select("team_id", F.col("match_date").alias("_t"),
                      F.struct("rc", "wk", "nb", bowlers.alias("bowlers")).alias("last_day"),
                      F.lit(None).cast("long").alias("wins5"))
    if matchstat is not None:
        wr = Window.partitionBy("team_id").orderBy("_t", "match_id").rowsBetween(-(RESULT_ROWS - 1), 0)
        ms = matchstat.where(real_team).select(
            "team_id", "match_id", F.col("match_date").alias("_t"),
            (normalize_result(F.col("result")) == "won").cast("int").alias("won"))
        ms = ms.select("team_id", "_t", "match_id", F.sum("won").over(wr).alias("wins5"))
        ms = ms.groupBy("team_id", "_t").agg(F.max_by("wins5", F.when(F.col("wins5").isNotNull(), F.col("match_id"))).alias("wins5"))
        days = days.unionByName(ms, allowMissingColumns=True).groupBy("team_id", "_t").agg(
            F.first("last_day", ignorenulls=True).alias("last_day"), F.first("wins5", ignorenulls=True).alias("wins5"))
    known = Window.partitionBy("team_id").orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    states = days.select("team_id", F.struct(
        F.col("_t").alias("d"), F.last("last_day", ignorenulls=True).over(known).alias("last_day"),
        F.last("wins5", ignorenulls=True).over(known).alias("wins5")).alias("s"))
    return states.groupBy("team_id").agg(F.array_sort(F.collect_list("s"), _by_day).alias("_states"))


def _by_day(a: Column, b: Column) -> Column:
    return F.when(a["d"] < b["d"], -1).when(a["d"] > b["d"], 1).otherwise(0)


def _with_team_state(a: DataFrame, innings: DataFrame, matchstat: DataFrame | None,
                     broadcast_bytes: int | None = None) -> DataFrame:
    """Adds ``_opp_last`` and ``_opp_wins``, the opposition's state before the cutoff (J3, J4). Whether the timeline is
    broadcast depends on a count of its states."""
    played = innings.select("team_id", "match_date")
    if matchstat is not None:
        played = played.unionByName(matchstat.select("team_id", "match_date"))
    t = team_timeline(innings, matchstat).withColumnRenamed("team_id", "opposition_id")
    a = left_lookup(a, t, "opposition_id", played.distinct().count() * STATE_BYTES, ["player_id", "cutoff_date"], broadcast_bytes)
    before = latest_before(F.col("_states"), "d", F.col("cutoff_date")).alias("_opp")
    a = a.select(*[c for c in a.columns if c != "_states"], before)
    return a.select(*[c for c in a.columns if c != "_opp"], F.col("_opp.last_day").alias("_opp_last"),
                    F.col("_opp.wins5").alias("_opp_wins"))


def team_context(innings: DataFrame, matchstat: DataFrame | None, keys: DataFrame) -> DataFrame:
    """Per distinct (opposition_id, cutoff_date) with a known state: ``_opp_last`` and ``_opp_wins``."""
    k = keys.select("opposition_id", "cutoff_date").where("opposition_id <> 0").distinct().withColumn("player_id", F.lit(0))
    return _with_team_state(k, innings, matchstat).select("opposition_id", "cutoff_date", "_opp_last", "_opp_wins")


def with_opposition(a: DataFrame, innings: DataFrame, matchstat: DataFrame | None,
                    broadcast_bytes: int | None = None) -> DataFrame:
    """Features 21-24; ``broadcast_bytes`` limits the team timeline that is broadcast (see ``lookup``)."""
    a = _with_team_state(a, innings, matchstat, broadcast_bytes)
    known = F.col("_opp_last").isNotNull()
    has_bowling = F.col("_opp_last.nb") > 0
    wins = (F.coalesce(F.col("_opp_wins"), F.lit(0)) if matchstat is not None
            else F.lit(DEFAULTS["opposition_matches_won_last_5"]))
    src = (F.when(F.coalesce(F.col("opposition_id"), F.lit(0)) == 0, "used_default_no_opposition_data")
           .when(~known, "used_default_no_opposition_matches").otherwise("used_real_data"))
    return a.select(
        "*",
        F.when(known & has_bowling, F.coalesce(F.col("_opp_last.rc"), F.lit(0.0)).cast("int"))
        .otherwise(F.lit(DEFAULTS["opposition_runs_conceded_last_match"])).alias("opposition_runs_conceded_last_match"),
        F.when(known & has_bowling, F.coalesce(F.col("_opp_last.wk"), F.lit(0)).cast("int"))
        .otherwise(F.lit(DEFAULTS["opposition_wickets_taken_last_match"])).alias("opposition_wickets_taken_last_match"),
        F.when(known, F.least(F.col("_opp_last.bowlers"), F.lit(BOWLER_CAP)))
        .otherwise(F.lit(DEFAULTS["opposition_total_bowlers_used_recent"])).cast("int").alias("opposition_total_bowlers_used_recent"),
        F.when(known, wins).otherwise(F.lit(DEFAULTS["opposition_matches_won_last_5"])).cast("int")
        .alias("opposition_matches_won_last_5"),
        src.alias("src_opposition"),
    )


def with_venue(a: DataFrame, venue_stats: DataFrame | None) -> DataFrame:
    """Features 25-29: venue lookup, unknown venue -> truncated means, high-scoring flag."""
    names = ["venue_total_matches", "venue_highest_score", "venue_lowest_score", "venue_total_boundaries"]
    if venue_stats is None:
        return a.select("*", *[F.lit(DEFAULTS[n]).alias(n) for n in names],
                        F.lit(0).alias("high_scoring_venue"), F.lit("used_default_no_venue_data").alias("src_venue"),
                        F.lit(True).alias("_venue_ok"))
    src_cols = ["total_matches_venue", "highest_score_venue", "lowest_score_venue", "total_boundaries_venue"]
    # deduplicate the dimension on its key (first row by a deterministic order)
    w = Window.partitionBy("venue_id").orderBy(*[F.col(c).asc_nulls_last() for c in src_cols])
    vs = venue_stats.select("venue_id", *src_cols).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    # dimension-wide means (J6): scalar subqueries (one partial-aggregated value each), no join
    means = {c: venue_stats.select(F.avg(c)).scalar() for c in src_cols}
    v = vs.select(F.col("venue_id"), F.lit(True).alias("_vhit"), *[F.col(c).alias(f"_v_{c}") for c in src_cols])
    a = left_lookup(a, v, "venue_id", venue_stats.count() * VENUE_BYTES, ["player_id", "cutoff_date"]).select("*", *[means[c].alias(f"_avg_{c}") for c in src_cols])
    hit = F.col("_vhit").isNotNull()
    cols = [F.when(hit, F.col(f"_v_{c}")).otherwise(F.col(f"_avg_{c}")).cast("int").alias(n) for n, c in zip(names, src_cols)]
    ok = F.lit(True)
    for c in src_cols:
        ok = ok & F.when(hit, F.col(f"_v_{c}").isNotNull()).otherwise(F.col(f"_avg_{c}").isNotNull())
    high = F.when(hit & (F.col("_v_highest_score_venue") > HIGH_SCORING_VENUE), 1).otherwise(0)
    src = F.when(hit, "used_real_venue_data").otherwise("used_venue_average")
    return a.select("*", *cols, high.alias("high_scoring_venue"), src.alias("src_venue"), ok.alias("_venue_ok"))


def build_features(
    anchors: DataFrame,
    innings: DataFrame,
    deliveries: DataFrame | None = None,
    matchstat: DataFrame | None = None,
    venue_stats: DataFrame | None = None,
    keep: list[str] | None = None,
    with_prior_venue: bool = True,
) -> DataFrame:
    """All 30 features + ``is_valid`` + provenance per anchor.

    ``keep``: anchor columns to carry through (default: all anchor columns).
    ``is_valid`` is False where the reference would fail on a null stat (Q11).
    """
    keep = keep if keep is not None else list(anchors.columns)
    a = player_history(innings, anchors, deliveries=deliveries)
    a = a.select("*", *recent_form_columns(), *archetype_columns())
    a = with_ball_phase(a)
    a = with_opposition(a, innings, matchstat)
    a = with_venue(a, venue_stats)
    extra = [F.col("_venue_prior").cast("int").alias("prior_matches_at_venue")] if with_prior_venue else []
    return a.select(
        *keep,
        *[c for c in FEATURES if c != "player_career_matches_at_venue"],
        F.coalesce(F.col("_venue_career"), F.lit(0)).cast("int").alias("player_career_matches_at_venue"),
        *extra,
        (F.col("_ball_ok") & F.col("_venue_ok")).alias("is_valid"),
        F.concat(F.lit("available_matches_"), F.col("data_availability").cast("string")).alias("src_recent"),
        "src_archetype", "src_ball", "src_opposition", "src_venue",
    )


def default_feature_row() -> list[Column]:
    """The default feature values of an unseen player (M3), in feature order."""
    vals = {
        **{f"runs_match_{i}_ago": DEFAULTS["runs_match_ago"] for i in (1, 2, 3)},
        **{f"wickets_match_{i}_ago": DEFAULTS["wickets_match_ago"] for i in (1, 2, 3)},
        **{f"was_out_match_{i}_ago": DEFAULTS["was_out_match_ago"] for i in (1, 2, 3)},
        "data_availability": 0,
    }
    vals.update({k: v for k, v in DEFAULTS.items() if k in FEATURES})
    return [F.lit(vals[n]).alias(n) for n in FEATURES]


def replace_invalid_with_defaults(features: DataFrame) -> DataFrame:
    """Prediction path of Q11: an anchor whose features fail becomes the default row."""
    ok = F.col("is_valid")
    cols = []
    for name, dflt in zip(FEATURES, default_feature_row()):
        dtype = features.schema[name].dataType
        cols.append(F.when(ok, F.col(name)).otherwise(dflt.cast(dtype)).alias(name))
    others = [c for c in features.columns if c not in FEATURES]
    return features.select(*others, *cols)
