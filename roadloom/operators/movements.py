"""Turn movements at intersections: arms, approaches, pairs, rules and reviews."""

from __future__ import annotations

import cmath
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import circular_difference, signed_delta
from .groups import fold_groups


def arm_cluster(approaches: DataFrame, tolerance: float = 40.0) -> DataFrame:
    """Adds `arm`, a number per intersection: approaches by ascending angle and id join
    the arm whose circular mean is nearest and within `tolerance` degrees (of equally near
    ones the first), else found one. Where an arm's angles cancel out, its first one stands
    for the mean. The result depends on that order, so an intersection's few approaches are
    folded together."""

    def fold(rows: list) -> list[tuple]:
        sums: list[complex] = []
        firsts: list[complex] = []
        out = []
        for row in rows:
            unit = cmath.rect(1, math.radians(row.angle))
            means = [s if max(abs(s.real), abs(s.imag)) > 1e-9 else f for s, f in zip(sums, firsts)]
            gaps = [round(abs(math.degrees(cmath.phase(unit / m))), 9) for m in means]
            arm = gaps.index(min(gaps)) if gaps and min(gaps) <= tolerance else len(sums)
            if arm == len(sums):
                sums.append(0j)
                firsts.append(unit)
            sums[arm] += unit
            out.append((row.intersection_id, row.approach_id, arm))
        return out

    rows = approaches.select("intersection_id", "approach_id", F.col("angle").cast("double").alias("angle"))
    got = fold_groups(rows, ["intersection_id"], ["angle", "approach_id"], fold, "intersection_id bigint, approach_id bigint, arm int")
    return approaches.join(got, ["intersection_id", "approach_id"])


def lateral_rank(approaches: DataFrame) -> DataFrame:
    """Left-to-right rank within arm and side, from 0, by position along the left axis."""
    a = F.radians("travel_deg")
    left = -F.col("x") * F.sin(a) + F.col("y") * F.cos(a)
    w = Window.partitionBy("intersection_id", "arm", "side").orderBy(F.desc(F.round(left, 6)), "approach_id")
    return approaches.withColumn("lateral_rank", F.row_number().over(w) - 1)


def approach_defaults(approaches: DataFrame) -> DataFrame:
    """Leftmost entry of an arm is core; an arm's only exit is its standard exit."""
    n = F.count("*").over(Window.partitionBy("intersection_id", "arm", "side"))
    core = F.when(F.col("side") == "entry", F.col("lateral_rank") == 0)
    role = F.when((F.col("side") == "exit") & (n == 1), "core_standard_exit").when(F.col("side") == "exit", "unknown")
    return approaches.withColumns({"is_core": core, "exit_role": role})


def movement_pairs(approaches: DataFrame) -> DataFrame:
    """Each entry with each exit of its intersection: relation of the arms, turn and
    number of parallel corridors crossed (2 stands for 2 or more)."""
    cols = ["approach_id", "arm", "travel_deg", "arm_deg", "lateral_rank"]
    entry = approaches.where("side = 'entry'").select("intersection_id", *[F.col(c).alias(f"s_{c}") for c in cols], F.col("is_core").alias("s_core"), F.col("profile").alias("s_profile"))
    leave = approaches.where("side = 'exit'").select("intersection_id", *[F.col(c).alias(f"t_{c}") for c in cols], F.col("exit_role").alias("t_role"))
    rows = entry.join(leave, "intersection_id")
    relation = F.when(F.col("s_arm") == F.col("t_arm"), "same").when(circular_difference(F.col("s_arm_deg"), F.col("t_arm_deg")) >= 150, "opposite").otherwise("adjacent")
    delta = signed_delta(F.col("s_travel_deg"), F.col("t_travel_deg"))
    turn = F.when(relation == "same", "uturn").when((relation == "opposite") | (F.abs(delta) < 15), "through").when(delta > 0, "left").otherwise("right")
    return rows.withColumns({"relation": relation, "turn": turn, "crossed": F.least(F.lit(2), F.abs(F.col("s_lateral_rank") - F.col("t_lateral_rank")))})


def movement_rules(same_zone: Column | None = None) -> Column:
    """Decision (status, confidence, reasons) of a movement, the first rule that applies.
    NULL stands for unknown. Columns: turn, crossed, t_role, s_core, s_profile."""
    same_zone = F.lit(True) if same_zone is None else same_zone
    unsure = F.coalesce(F.col("t_role") == "unknown", F.lit(True))
    turn, profile = F.col("turn"), F.coalesce(F.col("s_profile"), F.lit(""))

    def say(status: str, confidence: Column | str, *reasons: str, mark: bool = False) -> Column:
        why = F.array(*[F.lit(r) for r in reasons])
        if mark:
            why = F.when(unsure, F.concat(why, F.array(F.lit("UNKNOWN_TARGET_STANDARD_EXIT")))).otherwise(why)
        level = F.lit(confidence) if isinstance(confidence, str) else confidence
        return F.struct(F.lit(status).alias("status"), level.alias("confidence"), why.alias("reasons"))

    lower = F.when(unsure, "medium").otherwise("high")
    turning = turn.isin("left", "uturn")
    service, paired = profile == "left_uturn_service", profile == "paired_mainline_no_left_uturn"
    rules = [
        (same_zone == F.lit(False), say("forbidden", "high", "NOT_SAME_CONTROL_ZONE")),
        (same_zone.isNull(), say("unknown", "low", "UNKNOWN_CONTROL_ZONE")),
        (F.col("t_role").isin("auxiliary_parallel_exit", "access_exit"), say("forbidden", "high", "NON_STANDARD_EXIT_LEG")),
        (F.col("crossed") >= 2, say("forbidden", "high", "MULTI_PARALLEL_CROSS_FORBIDDEN")),
        (F.col("crossed").isNull(), say("unknown", "low", "UNKNOWN_PARALLEL_CROSS_COUNT")),
        (turn.isNull(), say("unknown", "low", "UNKNOWN_TURN_SENSE")),
        (service & turning & unsure, say("unknown", "medium", "UNKNOWN_TARGET_STANDARD_EXIT")),
        (service & turning, say("allowed", "high", "PROFILE_LEFT_UTURN_SERVICE_ALLOWED")),
        (service & (turn == "through"), say("forbidden", "high", "PROFILE_LEFT_UTURN_SERVICE_FORBID_THROUGH")),
        (service, say("forbidden", "high", "PROFILE_LEFT_UTURN_SERVICE_FORBID_RIGHT")),
        (paired & (turn == "left"), say("forbidden", "high", "PROFILE_PAIRED_MAINLINE_FORBID_LEFT")),
        (paired & (turn == "uturn"), say("forbidden", "high", "PROFILE_PAIRED_MAINLINE_FORBID_UTURN")),
        (F.col("crossed") == 1, say("unknown", lower, "SINGLE_PARALLEL_CROSS_DEFAULT_UNKNOWN", mark=True)),
        (turn == "right", say("allowed", lower, "DEFAULT_RIGHT_ALLOWED", mark=True)),
        (turn == "through", say("allowed", lower, "DEFAULT_THROUGH_ALLOWED", mark=True)),
        (unsure, say("unknown", "medium", "UNKNOWN_TARGET_STANDARD_EXIT")),
        ((turn == "left") & F.col("s_core"), say("allowed", "high", "DEFAULT_CORE_LEFT_ALLOWED")),
        (turn == "left", say("unknown", "medium", "DEFAULT_NONCORE_LEFT_UNKNOWN")),
    ]
    out = F.when(*rules[0])
    for condition, decision in rules[1:]:
        out = out.when(condition, decision)
    return out.otherwise(say("unknown", "medium", "DEFAULT_UTURN_UNKNOWN"))


def movement_matrix(decided: DataFrame, by: list[str], row: str = "turn", statuses: tuple[str, ...] = ("allowed", "forbidden", "unknown")) -> DataFrame:
    """Counts of decisions by status, one column for each."""
    return decided.groupBy(*by, row).agg(*[F.count_if(F.col("status") == s).alias(s) for s in statuses])


def movement_cells(decided: DataFrame, by: list[str], entry: str, exit: str) -> DataFrame:
    """(by..., entry, cells, n): the status of each exit from an entry, as 'exit=status' in the order of exits."""
    cells = F.array_sort(F.collect_list(F.struct(exit, "status")))
    got = decided.groupBy(*by, entry).agg(cells.alias("l"), F.count("*").alias("n"))
    return got.select(*by, entry, F.array_join(F.transform("l", lambda x: F.concat(x[exit].cast("string"), F.lit("="), x.status)), ",").alias("cells"), "n")


def run_diff(before: DataFrame, after: DataFrame, key: list[str], compare: list[str]) -> DataFrame:
    """Rows whose presence or compared values differ between two runs."""
    a = before.select(*key, F.struct(*compare).alias("was"), F.lit(True).alias("in_a"))
    b = after.select(*key, F.struct(*compare).alias("now"), F.lit(True).alias("in_b"))
    rows = a.join(b, key, "full_outer")
    change = F.when(F.col("in_b").isNull(), "removed").when(F.col("in_a").isNull(), "added").when(~F.col("was").eqNullSafe(F.col("now")), "changed")
    return rows.withColumn("change", change).where("change IS NOT NULL").select(*key, "change")


def manual_override_join(approaches: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(approaches with profile, overrides that fit none). An override's key is an
    approach id, `road:side` or a road id; the most exact one wins."""
    keys = [F.col("approach_id").cast("string"), F.concat_ws(":", F.col("road_id").cast("string"), "side"), F.col("road_id").cast("string")]
    out = approaches
    for i, key in enumerate(keys):
        own = overrides.select(F.col("key").alias(f"k{i}"), F.col("profile").alias(f"p{i}"))
        out = out.withColumn(f"k{i}", key).join(own, f"k{i}", "left")
    used = out.select(F.explode(F.array("k0", "k1", "k2")).alias("key")).distinct()
    missing = overrides.join(used, "key", "left_anti")
    return out.withColumn("profile", F.coalesce("p0", "p1", "p2")).drop("k0", "k1", "k2", "p0", "p1", "p2"), missing


def review_lists(decided: DataFrame) -> DataFrame:
    """Movements to look at, one row for each reason to."""
    kinds = F.filter(
        F.array(
            F.when(F.col("status") == "unknown", "unknown_status"),
            F.when(F.coalesce(F.col("t_role"), F.lit("unknown")) == "unknown", "target_role_unknown"),
            F.when(F.col("s_profile").isNull() & F.col("turn").isin("left", "uturn"), "profile_gap"),
        ),
        lambda k: k.isNotNull(),
    )
    return decided.withColumn("review_kind", F.explode(kinds))
