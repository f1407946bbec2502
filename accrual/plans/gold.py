"""Trials and sites to site histories and the per-trial feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from accrual.functions.text import is_usable_facility
from accrual.operators.joins import hot_keys_of_counts, salted_lookup
from accrual.operators.order_stats import running_totals
from accrual.operators.values import input_bytes
from accrual.plans.silver import VELOCITY_CAP
from accrual.schemas import GOLD_TRIAL_FEATURES
from accrual.session import durable
from accrual.sources.bucketed import BucketedTable
from accrual.sources.tables import refresh_table

GEO = ["country", "city", "zip"]
DESCRIPTION = ["facility_name", "state", "latitude", "longitude"]
VELOCITY_SCALE = 10_000
# Bytes of the compressed inputs for each task, and the most tasks; beyond that the size is not known.
TASK_BYTES = 16 << 20
MOST_TASKS = 1 << 20


def plausible_trials(trials: DataFrame) -> DataFrame:
    """Trials with a velocity from 0 to under the cap."""
    return trials.filter((F.col("trial_velocity") >= 0) & (F.col("trial_velocity") < VELOCITY_CAP))


def usable_sites(sites: DataFrame) -> DataFrame:
    """Site rows with a real facility name."""
    return sites.filter(is_usable_facility("facility_name"))


def with_geo_key(sites: DataFrame) -> DataFrame:
    return sites.dropna(subset=GEO)


def by_trial(sites: DataFrame, trials: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``sites`` dealt out by trial, in as many tasks as the inputs of both frames fill.

    A task that joins sites with trials and folds them holds its share in memory, which grows with the
    input where the number of shuffle partitions is fixed. Inputs of unknown size are left alone.
    """
    tasks = (input_bytes(sites) + input_bytes(trials)) // task_bytes
    if int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")) < tasks <= MOST_TASKS:
        return sites.repartition(tasks, "nct_id")
    return sites


def sites_with_velocity(
    sites: DataFrame, trials: DataFrame, orphans: str = "zero"
) -> DataFrame:
    """Site rows with their trial's velocity and start date.

    A site whose trial is unknown counts with velocity 0 (``orphans="zero"``) or not at all
    (``"drop"``). A trial has about a thousand sites at most, so its key is never hot.
    """
    if orphans not in ("zero", "drop"):
        raise ValueError(f"orphans must be 'zero' or 'drop', not {orphans!r}")
    joined = sites.join(
        trials.select("nct_id", "trial_velocity", "start_date"),
        "nct_id",
        "left" if orphans == "zero" else "inner",
    )
    return joined.withColumn("trial_velocity", F.coalesce("trial_velocity", F.lit(0.0)))


def site_history(
    sites: DataFrame, trials: DataFrame, distinct_trials: bool = False, **join_options
) -> DataFrame:
    """Per (country, city, zip): facility, state and coordinates, trials, mean velocity, last year.

    ``sites`` are usable site rows. Each site row counts, so a trial listing a place twice counts
    twice; ``distinct_trials`` counts it once. Where a place is described in several ways, each
    descriptive column takes its smallest value, which does not depend on input order.

    Rows are first folded per described place, with numeric buffers only, so this step is a hash
    aggregation whose partial half shrinks the input before it moves and whose shuffle key splits
    a busy place by its descriptions. The text minima then work on the folded rows.
    """
    keyed = with_geo_key(sites)
    if distinct_trials:
        keyed = keyed.groupBy("nct_id", *GEO).agg(*[F.min(c).alias(c) for c in DESCRIPTION])
    rows = sites_with_velocity(keyed, plausible_trials(trials), **join_options)
    described = rows.groupBy(*GEO, *DESCRIPTION).agg(
        F.count("nct_id").alias("_trials"),
        F.count("*").alias("_rows"),
        F.sum("trial_velocity").alias("_velocity"),
        F.max("start_date").alias("_last_start"),
    )
    return described.groupBy(*GEO).agg(
        *[F.min(name).alias(name) for name in DESCRIPTION],
        F.sum("_trials").alias("n_trials"),
        (F.sum("_velocity") / F.sum("_rows")).alias("avg_velocity"),
        F.year(F.max("_last_start")).alias("last_year"),
    )


def site_condition_history(sites: DataFrame) -> DataFrame:
    """Per (country, city, zip, condition id): number of site rows listing the condition."""
    return (
        with_geo_key(sites)
        .select("nct_id", *GEO, F.explode("mesh_conditions_ids").alias("mesh_condition_id"))
        .groupBy(*GEO, "mesh_condition_id")
        .agg(F.count("nct_id").alias("n_trials_for_condition"))
    )


def trial_site_stats(sites: DataFrame, history: DataFrame) -> DataFrame:
    """Per trial: number of usable sites and the mean experience and velocity of its places.

    One pass over the sites gives both the count and the means: sites without a geo key find no
    history, so they count in ``n_sites`` and leave the means alone. ``history`` is the stored
    table; its own counts say which places are hot, and those are joined salted.
    """
    joined = salted_lookup(
        sites.select("nct_id", *GEO),
        history.select(*GEO, "n_trials", "avg_velocity"),
        GEO,
        hot_keys_of_counts(history, GEO, "n_trials"),
        spread_by=["nct_id"],
    )
    return joined.groupBy("nct_id").agg(
        F.count("*").alias("n_sites"),
        F.avg("n_trials").alias("avg_site_exp"),
        F.avg("avg_velocity").alias("avg_site_vel"),
    )


def trial_features(trials: DataFrame, stats: DataFrame) -> DataFrame:
    """The model's input: one row per trial that has sites with a history."""
    complete = stats.filter(
        (F.col("n_sites") > 0)
        & F.col("avg_site_exp").isNotNull()
        & F.col("avg_site_vel").isNotNull()
    )
    return (
        plausible_trials(trials)
        .join(complete, "nct_id")
        .withColumnsRenamed(
            {"enrollment_duration_months": "duration_months", "trial_velocity": "target_velocity"}
        )
        .to(StructType.fromDDL(GOLD_TRIAL_FEATURES))
    )


def leave_one_out_stats(sites: DataFrame, trials: DataFrame) -> DataFrame:
    """Per trial: the site means with the trial's own site rows taken out of each place.

    A place's totals minus the trial's own share, so a trial's velocity never feeds its own
    feature. A place that only this trial used has no history left and does not enter the means;
    both are NULL when no place has any.
    """
    rows = sites_with_velocity(by_trial(with_geo_key(sites), trials), plausible_trials(trials))
    # Read as fact and below the place totals: built once.
    own = durable(
        rows.groupBy("nct_id", *GEO).agg(
            F.count("*").alias("own_n"), F.sum("trial_velocity").alias("own_velocity")
        )
    )
    place = own.groupBy(*GEO).agg(
        F.sum("own_n").alias("all_n"),
        F.sum("own_velocity").alias("all_velocity"),
        F.count("*").alias("_own_rows"),
    )
    hot = hot_keys_of_counts(place, GEO, "_own_rows")
    joined = salted_lookup(own, place.drop("_own_rows"), GEO, hot, spread_by=["nct_id"])
    others = F.col("all_n") - F.col("own_n")
    mean_of_others = F.when(
        others > 0, (F.col("all_velocity") - F.col("own_velocity")) / others
    )
    weight = F.when(others > 0, F.col("own_n"))
    return joined.groupBy("nct_id").agg(
        F.try_divide(F.sum(others * weight), F.sum(weight).cast("double")).alias("avg_site_exp"),
        F.try_divide(F.sum(mean_of_others * weight), F.sum(weight).cast("double")).alias(
            "avg_site_vel"
        ),
    )


def as_of_stats(
    sites: DataFrame, trials: DataFrame, velocity_scale: int = VELOCITY_SCALE
) -> DataFrame:
    """Per trial: site means over the trials completed before this one started.

    Completions and questions ("what was known at this place on this day?") run through one
    ordered pass per place, range-partitioned so that a place of any size spans many tasks.
    Velocities are summed as whole parts of ``1 / velocity_scale``, exactly; the default fits the
    four decimals of the silver layer, and finer values are rounded to the scale.
    """
    keyed = with_geo_key(sites).select("nct_id", *GEO)
    rows = keyed.join(
        plausible_trials(trials).select(
            "nct_id", "trial_velocity", "start_date", "primary_completion_date"
        ),
        "nct_id",
    )
    parts = F.round(F.col("trial_velocity") * velocity_scale).cast("bigint")
    names = ("day", "nct_id", "asked", "done", "done_velocity")
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def event(*fields: Column) -> Column:
        return F.struct(*[field.alias(name) for name, field in zip(names, fields, strict=True)])

    # A completion counts from the next day on. Both kinds come from one pass over the joined rows.
    known = event(F.date_add("primary_completion_date", 1), F.lit(""), none, one, parts)
    question = event(F.col("start_date"), F.col("nct_id"), one, none, none)
    events = rows.select(*GEO, F.inline(F.array(known, question)))
    both = events.groupBy(*GEO, "day", "nct_id").agg(
        *[F.sum(name).alias(name) for name in names[2:]]
    )
    # The empty id sorts first: a day's completions precede its questions.
    seen = running_totals(
        both,
        GEO,
        [F.col("day"), F.col("nct_id")],
        {"seen": F.col("done"), "seen_velocity": F.col("done_velocity")},
    ).filter((F.col("asked") > 0) & (F.col("seen") > 0))
    mean = F.col("seen_velocity") / F.lit(float(velocity_scale)) / F.col("seen")
    return seen.groupBy("nct_id").agg(
        (F.sum(F.col("seen") * F.col("asked")) / F.sum("asked")).alias("avg_site_exp"),
        (F.sum(mean * F.col("asked")) / F.sum("asked")).alias("avg_site_vel"),
    )


def write_bucketed_gold(
    trials: DataFrame, sites: DataFrame, folder: str, prefix: str, buckets: int = 200
) -> DataFrame:
    """The gold layer over tables bucketed by trial; returns the features, which join without an exchange.

    Trials and sites are written bucketed and sorted by ``nct_id`` under names that begin with
    ``prefix``, and so are the site means per trial. Each pays one shuffle when it is written; the join
    of sites with their trials and that of trials with their means then move nothing.
    """

    def bucketed(name: str) -> BucketedTable:
        return BucketedTable(f"{prefix}{name}", f"{folder}/bucketed/{name}", ("nct_id",), buckets)

    trials = bucketed("trials").write(trials)
    usable = usable_sites(bucketed("trial_sites").write(sites))
    refresh_table(site_history(usable, trials), f"{folder}/site_history")
    history = trials.sparkSession.read.parquet(f"{folder}/site_history")
    stats = bucketed("trial_site_stats").write(trial_site_stats(usable, history))
    return trial_features(trials, stats)


def write_gold(trials: DataFrame, sites: DataFrame, folder: str) -> None:
    """Write the gold layer below ``folder``: both histories, then the features that read them."""
    spark = trials.sparkSession
    usable = usable_sites(sites)
    refresh_table(site_history(usable, trials), f"{folder}/site_history")
    refresh_table(site_condition_history(usable), f"{folder}/site_conditions_history")
    history = spark.read.parquet(f"{folder}/site_history")
    stats = trial_site_stats(usable, history)
    refresh_table(trial_features(trials, stats), f"{folder}/trial_features")

