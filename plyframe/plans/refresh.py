"""Full refresh: landing folder to checked tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plyframe.plans.checks import Watch, watched
from plyframe.plans.game_moves import prepare_moves
from plyframe.plans.games import build_games
from plyframe.plans.player_games import prepare_games
from plyframe.plans.staging import stage_games
from plyframe.session import configure
from plyframe.sources import contract, landing, tables, versions


def refresh(
    spark: SparkSession,
    root: str,
    out: str,
    username: str,
    load_id: float,
    buckets: int | None = None,
    checks: bool = True,
) -> dict[str, str]:
    """Rebuild every table from the player's archives; returns table name -> path.

    Each stage is written to a fresh folder below ``out``, its checks are taken in the same pass and decided before the next reads it, so a lost
    executor costs one stage at most.  Only when all have passed is the run committed, as one version of all
    tables, by a single atomic move; a run that fails or dies anywhere leaves the former version as it was, and readers that
    open ``versions.version(spark, out)`` never see tables of two runs.  The catalog's views of the plain names follow
    one by one.  Former versions stay until ``versions.expire``.
    Games and moves are bucketed alike by ``game_uuid``: the mart groups and joins them without a shuffle.
    """
    configure(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    run = uuid.uuid4().hex
    former = versions.version(spark, out)
    raw_name = f"{tables.RAW_SCHEMA}.player_games"
    paths = {name: f"{out}/{name.rsplit('.', 1)[-1]}/{run}" for name in (raw_name, "prep_player_games", "prep_game_moves", "games")}
    fresh = {name: f"{name}_{run}" for name in paths}

    def passing(name: str, table: DataFrame, unique: bool = True) -> tuple[DataFrame, Watch | None]:
        return watched(name, table, unique) if checks else (table, None)

    def sound(watch: Watch | None, table: DataFrame) -> DataFrame:
        if watch:
            watch.require_sound(table)
        return table

    try:
        records = landing.read_games(spark, root, username)
        checked = contract.with_problems(records, contract.RECORD, contract.text_rule())
        raw = contract.with_lineage(contract.flatten(contract.require_valid(checked)), load_id)
        tables.replace_table(raw, fresh[raw_name], paths[raw_name])

        # Staged rows are checked on their way into the games; their key is the games' key.
        name, staged = "prep_player_games", stage_games(spark.table(fresh[raw_name]))
        passed, of_staged = passing("stg_player_games", staged, unique=False)
        games, of_games = passing(name, prepare_games(passed, username, buckets))
        tables.replace_bucketed(games, fresh[name], "game_uuid", buckets, paths[name])
        sound(of_staged, staged)
        games = sound(of_games, spark.table(fresh[name]))

        name = "prep_game_moves"
        moves, of_moves = passing(name, prepare_moves(games))
        tables.replace_bucketed(moves, fresh[name], "game_uuid", buckets, paths[name])
        moves = sound(of_moves, spark.table(fresh[name]))

        mart, of_mart = passing("games", build_games(games, moves))
        tables.replace_table(mart, fresh["games"], paths["games"], ["time_class"])
        sound(of_mart, spark.table(fresh["games"]))
    except Exception:
        for name in fresh.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    entries = {name: {"path": paths[name], "table": fresh[name]} for name in paths}
    versions.commit(spark, out, run, entries, former.number if former else None)
    for name in paths:
        tables.show_as(spark, fresh[name], name)
    tables.publish_view(stage_games(spark.table(raw_name)), "stg_player_games")
    return paths
