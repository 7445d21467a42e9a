"""Analyses over the star schema: standings, gaps, conversion, tyres, circuits, sectors, reliability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from starq.plans.warehouse import CONTEXT_DIMENSIONS


def _with_event(fact: DataFrame, dim_grand_prix: DataFrame, *columns: str) -> DataFrame:
    return fact.join(dim_grand_prix.select("grand_prix_id", *columns), "grand_prix_id")


def points_gap(results: DataFrame, dim_grand_prix: DataFrame) -> DataFrame:
    """Cumulative race points per season, team and round, and the gap to the leader.

    A round without a row of a team carries its total forward. Points are summed
    per round first, so the windows run over rounds, not over rows.
    """
    races = _with_event(results.where(F.col("session_type") == "R"), dim_grand_prix, "season_year", "round_number")
    per_round = races.groupBy("season_year", "round_number", "team_id").agg(F.sum("points").alias("points"))
    rounds = per_round.select("season_year", "round_number").distinct()
    teams = per_round.select("season_year", "team_id").distinct()
    grid = rounds.join(teams, "season_year")
    running = (
        Window.partitionBy("season_year", "team_id").orderBy("round_number")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = grid.join(per_round, ["season_year", "round_number", "team_id"], "left").withColumn(
        "cumulative_points", F.coalesce(F.sum("points").over(running), F.lit(0.0))
    )
    leader = F.max("cumulative_points").over(Window.partitionBy("season_year", "round_number"))
    return total.select(
        "season_year", "round_number", "team_id", "cumulative_points", (leader - F.col("cumulative_points")).alias("gap_to_leader")
    )


def standings(results: DataFrame, dim_grand_prix: DataFrame) -> DataFrame:
    race, first = F.col("session_type") == "R", F.col("position") == 1
    table = _with_event(results, dim_grand_prix, "season_year").groupBy("season_year", "team_id").agg(
        F.coalesce(F.sum(F.when(race, F.col("points"))), F.lit(0.0)).alias("points"),
        F.count_if(race & first).alias("wins"),
        F.count_if((F.col("session_type") == "Q") & first).alias("poles"),
    )
    place = F.rank().over(Window.partitionBy("season_year").orderBy(F.desc("points")))
    return table.withColumn("place", place.cast("bigint"))


def qualifying_to_race(results: DataFrame, teams: Sequence[str] | None = None) -> DataFrame:
    """How qualifying places turn into race places, per team."""
    keys = ["grand_prix_id", "driver_id", "team_id"]

    def best(kind: str, name: str) -> DataFrame:
        # One place per driver and event: the best one.
        rows = results.where((F.col("session_type") == kind) & F.col("position").isNotNull())
        if teams is not None:
            rows = rows.where(F.col("team_id").isin(*teams))
        return rows.groupBy(*keys).agg(F.min("position").alias(name))

    both = best("Q", "q").join(best("R", "r"), keys)
    return both.groupBy("team_id").agg(
        F.count("*").alias("starts"),
        F.avg((F.col("r") <= F.col("q")).cast("double")).alias("conversion"),
        F.avg(F.col("q") - F.col("r")).alias("mean_places_gained"),
        F.stddev_samp("r").alias("race_consistency"),
        F.stddev_samp("q").alias("qualifying_consistency"),
    )


def best_position_gap(results: DataFrame, team_a: str, team_b: str) -> DataFrame:
    """Per event and session type: difference between the best places of two teams."""

    def best(team: str) -> Column:
        return F.min(F.when(F.col("team_id") == team, F.col("position")))

    return (
        results.where(F.col("team_id").isin(team_a, team_b))
        .groupBy("grand_prix_id", "session_type")
        .agg(best(team_a).alias("best_a"), best(team_b).alias("best_b"))
        .withColumn("gap", F.col("best_a") - F.col("best_b"))
    )


def tyre_performance(laps: DataFrame, dim_tyre: DataFrame) -> DataFrame:
    return (
        laps.join(dim_tyre, "tyre_context_key")
        .groupBy("compound", "starting_tyre_set_status", "tyre_life_class", "team_id")
        .agg(
            F.count("lap_time_ms").alias("timed_laps"), F.avg("lap_time_ms").alias("avg_lap_ms"),
            F.min("lap_time_ms").alias("min_lap_ms"), F.max("lap_time_ms").alias("max_lap_ms"),
            *[F.avg(f"sector{i}_time_ms").alias(f"avg_sector{i}_ms") for i in (1, 2, 3)],
            F.max("speed_st").alias("max_speed_st"),
        )
    )


def _gap_to_best(per_team: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Relative distance of each team's mean to the best team of its group.

    `per_team` is already one row per group and team."""
    best = per_team.groupBy(*group).agg(F.min(value).alias("_best"))
    return per_team.join(best, list(group)).withColumn("relative_gap", (F.col(value) - F.col("_best")) / F.col("_best"))


def gap_by_circuit(laps: DataFrame, dim_grand_prix: DataFrame) -> DataFrame:
    """Mean relative gap of a team to the event's best team, by circuit category."""
    per_team = laps.where(F.col("lap_time_ms").isNotNull()).groupBy("grand_prix_id", "team_id").agg(
        F.avg("lap_time_ms").alias("mean_ms")
    )
    gaps = _gap_to_best(per_team, ["grand_prix_id"], "mean_ms")
    return _with_event(gaps, dim_grand_prix, "global_circuit_category").groupBy("global_circuit_category", "team_id").agg(
        F.avg("relative_gap").alias("mean_relative_gap"), F.count("*").alias("events")
    )


def gap_by_sector(laps: DataFrame, dim_grand_prix: DataFrame) -> DataFrame:
    """The same per sector, by the category of the sector."""
    names = ["sector1", "sector2", "sector3"]
    means = laps.groupBy("grand_prix_id", "team_id").agg(*[F.avg(f"{n}_time_ms").alias(n) for n in names])
    long = means.unpivot(["grand_prix_id", "team_id"], names, "sector", "mean_ms").where(F.col("mean_ms").isNotNull())
    gaps = _gap_to_best(long, ["grand_prix_id", "sector"], "mean_ms")
    categories = [f"{n}_category" for n in names]
    kinds = (
        dim_grand_prix.select("grand_prix_id", *categories)
        .unpivot("grand_prix_id", categories, "sector", "sector_category")
        .withColumn("sector", F.regexp_replace("sector", "_category$", ""))
    )
    return gaps.join(kinds, ["grand_prix_id", "sector"]).groupBy("sector_category", "team_id").agg(
        F.avg("relative_gap").alias("mean_relative_gap"), F.count("*").alias("sectors")
    )


def season_change(results: DataFrame, dim_grand_prix: DataFrame, first: int, second: int) -> DataFrame:
    """Mean place and points of a team in two seasons, qualifying and race apart."""
    rows = _with_event(results, dim_grand_prix, "season_year")

    def mean(column: str, year: int) -> Column:
        return F.avg(F.when(F.col("season_year") == year, F.col(column)))

    both = rows.groupBy("team_id", "session_type").agg(
        mean("position", first).alias("position_first"), mean("position", second).alias("position_second"),
        mean("points", first).alias("points_first"), mean("points", second).alias("points_second"),
    )
    return both.withColumn("position_change", F.col("position_second") - F.col("position_first")).withColumn(
        "points_change", F.col("points_second") - F.col("points_first")
    )


def reliability(results: DataFrame, dim_outcome: DataFrame, dim_grand_prix: DataFrame) -> DataFrame:
    """Share of each outcome among a team's race results of a season."""
    races = results.where(F.col("session_type") == "R").join(dim_outcome, "result_outcome_key")
    counted = _with_event(races, dim_grand_prix, "season_year").groupBy(
        "season_year", "team_id", "result_status_category"
    ).agg(F.count("*").alias("results"))
    whole = F.sum("results").over(Window.partitionBy("season_year", "team_id"))
    return counted.withColumn("share", F.col("results") / whole)


# Which aggregates a measure allows.
_TIMES = ("lap_time_ms", "sector1_time_ms", "sector2_time_ms", "sector3_time_ms", "q1_ms", "q2_ms", "q3_ms", "gap_to_leader_ms")
_SPEEDS = ("speed_i1", "speed_i2", "speed_fl", "speed_st")
MEASURES = {
    **{m: ("avg", "min", "max") for m in (*_TIMES, *_SPEEDS)},
    **{m: ("avg", "min", "max", "sum") for m in ("points", "laps")},
    **{m: ("min", "max") for m in ("position", "grid_position", "lap_number")},
}


def measures(*wanted: tuple[str, str]) -> list[Column]:
    """Aggregate expressions for (measure, aggregate) pairs; refuses meaningless ones."""
    functions = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum}
    out = []
    for measure, aggregate in wanted:
        if aggregate not in MEASURES.get(measure, ()):
            raise ValueError(f"{aggregate}({measure}) is not allowed; allowed: {MEASURES.get(measure, ())}")
        out.append(functions[aggregate](measure).alias(f"{aggregate}_{measure}"))
    return out


def without_issues(fact: DataFrame, quality: DataFrame, name: str, flags: Sequence[str]) -> DataFrame:
    """Fact rows whose quality dimension shows none of the flags."""
    key = CONTEXT_DIMENSIONS[name][0]
    good = quality
    for f in flags:
        good = good.where(~F.col(f))
    return fact.join(good.select(key), key, "left_semi")


def analysis_scope(
    laps: DataFrame, dim_weather: DataFrame, dim_tyre: DataFrame, teams: Sequence[str] | None = None,
    compounds: Sequence[str] = ("SOFT", "MEDIUM", "HARD"),
) -> DataFrame:
    """Race laps on dry tyres in dry weather, optionally of chosen teams."""
    scope = laps.where(F.col("session_type") == "R")
    if teams is not None:
        scope = scope.where(F.col("team_id").isin(*teams))
    dry = dim_weather.where(~F.col("rain_flag")).select("lap_weather_context_key")
    tyres = dim_tyre.where(F.col("compound").isin(*compounds)).select("tyre_context_key")
    return scope.join(dry, "lap_weather_context_key", "left_semi").join(tyres, "tyre_context_key", "left_semi")
