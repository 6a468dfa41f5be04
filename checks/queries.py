"""One query per operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from checks import tables as t
from meterweave.operators import (
    calendar, changepoint, clusters, coincidence, demand, events, features, gaps, groups, patterns, pooled, profiles, quality,
    resolution, shapes, summary, validation, weather,
)
from meterweave.sources import readings as sources, sinks
from meterweave.session import checkpoint_dir, partitions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOLERANCE = 20
THRESHOLDS = [50.0, 100.0, 500.0]
PERCENTILES = [0.99, 0.95]
TOPS = [10, 25, 50]
BANDS = [32, 50, 65, 80, 90]
HOLIDAYS = ["2024-01-01", "2024-01-15"]
# Moves exact decimal half-way points off the rounding edge, where engines differ.
OFF_EDGE = 0.00000003


def settled(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison between engines; lists of dates or numbers as text."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c + OFF_EDGE, digits)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DateType):
            c = F.concat_ws(",", c.cast("array<string>"))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.DoubleType):
            millionths = F.transform(c, lambda v: F.round((v + OFF_EDGE) * 1_000_000).cast("long"))
            c = F.concat_ws(",", millionths.cast("array<string>"))
        out.append(c.alias(f.name))
    return df.select(*out)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # The default of 200 partitions is for clusters; on one machine go by its cores.
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions(spark)))
        return settled(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


# Sources and sinks


@query
def read_readings(spark, sf_dir):
    columns = T.StructType(
        [T.StructField("user_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("value", T.DoubleType())]
    )
    return sources.read_readings(spark, f"{sf_dir}/events.parquet", "parquet", columns)


@query
def canonicalize(spark, sf_dir):
    return sources.canonicalize(t.raw_texts(spark, sf_dir), t.MAPPING, "yyyy-MM-dd HH:mm:ss")


#: Source files by channel, each with its own way to write times.
WAYS = {"click": "yyyy-MM-dd HH:mm:ss", "view": "M/d/yyyy H:mm", "purchase": "d/M/yyyy H:mm", "signup": "d.M.yyyy H:mm"}


def _many_ways(spark, sf_dir):
    """Raw readings; errors have month-first times of the first twelve days only, which days-first reads as well."""
    at = t.interval_end(60)
    texts = F.coalesce(*[F.when(F.col("event_type") == c, F.date_format(at, p)) for c, p in WAYS.items()])
    early = F.when(F.day(at) <= 12, F.date_format(at, "M/d/yyyy H:mm"))
    return t.table(spark, sf_dir, "events").select(
        F.coalesce(texts, F.when(F.col("event_type") == "error", early)).alias("timestamp"), t.meter_name("user_id").alias("meter_id"),
        F.col("value").cast("string").alias("demand_kw"), F.col("event_id").alias("line"), F.col("event_type").alias("channel"),
    )


@query
def timestamp_patterns(spark, sf_dir):
    found = sources.timestamp_patterns(_many_ways(spark, sf_dir), F.col("channel"))
    return found.withColumn("ambiguous_with", F.array_join("ambiguous_with", "; "))


@query
def canonicalize_auto(spark, sf_dir):
    return sources.canonicalize(_many_ways(spark, sf_dir), pattern="auto", file=F.col("channel"))


@query
def read_weather(spark, sf_dir):
    # Source names and text values, as a weather station's file has them.
    raw = t.weather(spark, sf_dir).select(
        F.when(F.hour("timestamp") != 3, F.date_format("timestamp", "MM/dd/yy HH:mm")).alias("DATE"),
        F.when(F.col("temperature_f") > 70, F.lit("M")).otherwise(F.col("temperature_f").cast("string")).alias("TEMP"),
    )
    return sources.weather_table(raw, {"timestamp": "DATE", "temperature_f": "TEMP"}, "MM/dd/yy HH:mm")


@query
def write_outputs(spark, sf_dir):
    folder = f"{checkpoint_dir(spark)}/outputs-{sf_dir.strip('/').split('/')[-1]}"
    paths = sinks.write_outputs({"daily_features": t.features(spark, sf_dir)}, folder)
    written = spark.read.parquet(paths["daily_features"])
    return written.select("entity_id", "date", "daily_energy_kwh", "is_complete_day")


def _features_csv(spark, sf_dir, per_entity):
    """Daily features written as CSV, those of some entities once more, and read back."""
    folder = f"{checkpoint_dir(spark)}/csv-{per_entity}-{sf_dir.strip('/').split('/')[-1]}"
    table = t.features(spark, sf_dir).select("entity_id", "date", "daily_energy_kwh", "is_complete_day")
    paths = sinks.write_outputs({"daily_features": table}, folder, "csv", per_entity)
    if per_entity:
        sinks.write_outputs({"daily_features": table.where("entity_id like 'm1%'")}, folder, "csv", per_entity)
    columns = "date date, daily_energy_kwh double, is_complete_day boolean"
    columns = f"{columns}, entity_id string" if per_entity else f"entity_id string, {columns}"
    return spark.read.schema(columns).option("header", True).csv(paths["daily_features"])


@query
def write_outputs_csv(spark, sf_dir):
    return _features_csv(spark, sf_dir, False)


@query
def write_outputs_per_entity(spark, sf_dir):
    return _features_csv(spark, sf_dir, True)


# Validation, duplicates, resolution, calendar


def _canonical_text(spark, sf_dir):
    return sources.map_columns(t.raw_texts(spark, sf_dir), t.MAPPING)


@query
def validate_readings(spark, sf_dir):
    return validation.validate_readings(
        _canonical_text(spark, sf_dir), {"negative_demand": "warning"}, "yyyy-MM-dd HH:mm:ss"
    )


@query
def dedupe_readings(spark, sf_dir):
    return validation.dedupe_readings(canonicalize(spark, sf_dir), ordinal="line")


@query
def finding_gate(spark, sf_dir):
    return validation.fatal_findings(validate_readings(spark, sf_dir), strict=True)


@query
def detect_resolution(spark, sf_dir):
    return resolution.detect_resolution(canonicalize(spark, sf_dir))


@query
def overall_resolution(spark, sf_dir):
    return resolution.overall_resolution(detect_resolution(spark, sf_dir))


@query
def calendar_features(spark, sf_dir):
    return calendar.calendar_features(
        t.readings(spark, sf_dir).select("meter_id", "timestamp"), HOLIDAYS
    )


@query
def interval_energy(spark, sf_dir):
    return calendar.interval_energy(t.observations(spark, sf_dir), 60).select(
        "meter_id", "timestamp", "analysis_demand_kw", "energy_kwh"
    )


@query
def group_tree_check(spark, sf_dir):
    customer, supplier = t.table(spark, sf_dir, "customer"), t.table(spark, sf_dir, "supplier")
    nation, region = t.table(spark, sf_dir, "nation"), t.table(spark, sf_dir, "region")
    listed = t.meters(spark, sf_dir).unionByName(t.excluded(spark, sf_dir))
    listed = listed.unionByName(customer.where("c_acctbal > 9900").select(F.lit(None).cast("string").alias("meter_id")))
    named = nation.select(F.col("n_name").alias("name")).unionByName(region.select(F.col("r_name").alias("name")))
    named = named.unionByName(region.select(F.when(F.col("r_name") == "ASIA", "World").alias("name")))
    # A meter named as a nation, and a group named as the portfolio.
    listed = listed.unionByName(nation.where("n_name > 'U'").select(F.col("n_name").alias("meter_id")))
    named = named.unionByName(region.where("r_name = 'EUROPE'").select(F.lit("Portfolio").alias("name")))
    strangers = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("group_name"), F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("meter_id")
    )
    in_groups = t.group_members(spark, sf_dir).unionByName(strangers)
    back = nation.join(region, nation.n_nationkey == region.r_regionkey).select(
        F.col("n_name").alias("parent"), F.col("r_name").alias("child")
    )
    lost = region.select("r_name", F.concat(F.lit("AREA_"), F.col("r_regionkey").cast("string")))
    own = region.where("r_name = 'ASIA'").select(F.lit("World"), F.lit("World"))
    edges = t.group_children(spark, sf_dir).unionByName(back).union(lost).union(own)
    return groups.group_tree_check(listed, named, in_groups, edges)


# Gaps and data quality


@query
def regular_grid(spark, sf_dir):
    return gaps.regular_grid(t.readings(spark, sf_dir), 60).select("meter_id", "timestamp")


QUALITY_COLUMNS = [
    "meter_id", "timestamp", "observed_demand_kw", "interpolated_demand_kw", "analysis_demand_kw", "is_observed",
    "is_interpolated", "data_quality_flag",
]


@query
def fill_gaps(spark, sf_dir):
    return t.observations(spark, sf_dir).select(*QUALITY_COLUMNS)


@query
def fill_gaps_quarter_hours(spark, sf_dir):
    return gaps.fill_gaps(t.feeders(spark, sf_dir), 15, limit=2).select(*QUALITY_COLUMNS)


@query
def fill_gaps_ffill_bfill(spark, sf_dir):
    filled = gaps.fill_gaps(t.feeders(spark, sf_dir), 15, limit=1, forward=True, backward=True)
    return filled.select(*QUALITY_COLUMNS)


@query
def fill_temperature(spark, sf_dir):
    return t.observations(spark, sf_dir).select("meter_id", "timestamp", "temperature_f")


@query
def gap_runs(spark, sf_dir):
    return gaps.gap_runs(t.observations(spark, sf_dir))


@query
def quality_summary(spark, sf_dir):
    return quality.quality_summary(t.observations(spark, sf_dir))


@query
def quality_detail(spark, sf_dir):
    return quality.quality_detail(t.observations(spark, sf_dir))


@query
def quality_flag_counts(spark, sf_dir):
    return quality.quality_flag_counts(t.observations(spark, sf_dir))


# Temperature


def _quarter_hour_stamps(spark, sf_dir):
    """Readings off the weather's full hours; some have a temperature of their own."""
    rows = t.feeders(spark, sf_dir)
    return rows.withColumn("temperature_f", F.when(F.col("demand_kw") > 100, F.lit(1.0)))


@query
def asof_temperature(spark, sf_dir):
    return weather.asof_temperature(
        t.feeders(spark, sf_dir).select("meter_id", "timestamp"), t.weather(spark, sf_dir), TOLERANCE
    )


@query
def asof_temperature_unlimited(spark, sf_dir):
    return weather.asof_temperature(t.feeders(spark, sf_dir).select("meter_id", "timestamp"), t.weather(spark, sf_dir))


@query
def merge_temperature(spark, sf_dir):
    return weather.merge_temperature(
        _quarter_hour_stamps(spark, sf_dir), t.weather(spark, sf_dir), TOLERANCE
    )


@query
def merge_temperature_override(spark, sf_dir):
    return weather.merge_temperature(
        _quarter_hour_stamps(spark, sf_dir), t.weather(spark, sf_dir), TOLERANCE, override=True
    )


# Entities


@query
def resolve_groups(spark, sf_dir):
    return groups.resolve_groups(t.group_members(spark, sf_dir), t.group_children(spark, sf_dir))


@query
def portfolio_members(spark, sf_dir):
    return groups.portfolio_members(t.meters(spark, sf_dir), t.excluded(spark, sf_dir))


@query
def entity_load(spark, sf_dir):
    return t.load(spark, sf_dir).select("entity_id", "timestamp", "demand_kw", "n_meters_reporting")


# Daily profiles and features


@query
def daily_profiles(spark, sf_dir):
    return t.daily(spark, sf_dir).drop("timestamp")


@query
def normalized_profiles(spark, sf_dir):
    return profiles.normalized_profiles(t.daily(spark, sf_dir)).select(
        "entity_id", "timestamp", "normalized_demand"
    )


@query
def daily_features(spark, sf_dir):
    return t.features(spark, sf_dir)


@query
def day_coverage(spark, sf_dir):
    return profiles.day_coverage(t.load(spark, sf_dir), t.members(spark, sf_dir), 60)


@query
def segment_features(spark, sf_dir):
    return features.segment_features(t.daily(spark, sf_dir))


@query
def daily_temperature(spark, sf_dir):
    return features.daily_temperature(t.observations(spark, sf_dir))


@query
def entity_temperature(spark, sf_dir):
    """Groups and the portfolio by their representative meter, meters by themselves."""
    return features.entity_temperature(t.observations(spark, sf_dir), t.members(spark, sf_dir))


@query
def temperature_bands(spark, sf_dir):
    return features.temperature_bands(
        t.observations(spark, sf_dir).select("meter_id", "timestamp", "temperature_f"), BANDS
    )


@query
def weekday_daily_means(spark, sf_dir):
    return features.weekday_daily_means(t.observations(spark, sf_dir))


# Change points


def _points(spark, sf_dir):
    """Settled, because a mean a hair above a whole degree has another breakpoint grid."""
    return settled(weekday_daily_means(spark, sf_dir))


@query
def cp_2p(spark, sf_dir):
    return changepoint.fit_2p(_points(spark, sf_dir))


@query
def cp_3p_cooling(spark, sf_dir):
    return changepoint.fit_3p_cooling(_points(spark, sf_dir))


@query
def cp_3p_heating(spark, sf_dir):
    return changepoint.fit_3p_heating(_points(spark, sf_dir))


@query
def cp_4p(spark, sf_dir):
    return changepoint.fit_4p(_points(spark, sf_dir))


@query
def cp_5p(spark, sf_dir):
    return changepoint.fit_5p(_points(spark, sf_dir))


@query
def cp_select(spark, sf_dir):
    return changepoint.select_model(_points(spark, sf_dir)).select(
        "meter_id", "model", "n_points", "r_squared", "adjusted_r_squared", "success", "is_selected"
    )


# Demand classes, ramps, extrema, events, shapes


@query
def class_threshold(spark, sf_dir):
    return demand.class_threshold(t.load(spark, sf_dir), THRESHOLDS).select(
        "entity_id", "timestamp", "meets_threshold_50", "meets_threshold_100", "meets_threshold_500"
    )


@query
def class_percentile(spark, sf_dir):
    return demand.class_percentile(t.load(spark, sf_dir), PERCENTILES).select(
        "entity_id", "timestamp", "top_pct_99", "top_pct_95"
    )


@query
def class_percentile_coarse(spark, sf_dir):
    """The same from a sketch of 50 marks, which narrows the search little."""
    return demand.class_percentile(t.load(spark, sf_dir), PERCENTILES, accuracy=50).select(
        "entity_id", "timestamp", "top_pct_99", "top_pct_95"
    )


@query
def class_rank(spark, sf_dir):
    return demand.class_rank(t.load(spark, sf_dir), TOPS).select(
        "entity_id", "timestamp", "top_rank_10", "top_rank_25", "top_rank_50"
    )


@query
def ramps(spark, sf_dir):
    return demand.ramps(t.load(spark, sf_dir)).select(
        "entity_id", "timestamp", "ramp_kw", "ramp_up_kw", "ramp_down_kw"
    )


@query
def local_extrema(spark, sf_dir):
    return demand.local_extrema(t.load(spark, sf_dir)).select("entity_id", "timestamp", "is_peak", "is_valley")


@query
def peak_events(spark, sf_dir):
    return events.peak_events(t.load(spark, sf_dir), demand.meets(THRESHOLDS[0]), 1, "threshold_50")


@query
def event_duration_class(spark, sf_dir):
    return events.event_duration_class(peak_events(spark, sf_dir), 2.0).select(
        "event_id", "duration_hours", "duration_class"
    )


def _shapes(spark, sf_dir):
    daily = profiles.daily_profiles(t.load(spark, sf_dir), 60)
    return shapes.day_shapes(demand.local_extrema(daily), profiles.daily_features(daily, 60))


@query
def day_shape_flags(spark, sf_dir):
    return _shapes(spark, sf_dir).select("entity_id", "date", *shapes.FLAGS)


@query
def day_shape_primary(spark, sf_dir):
    return _shapes(spark, sf_dir).select("entity_id", "date", "primary_shape")


# Clusters


def _vectors(spark, sf_dir):
    return clusters.day_vectors(t.daily(spark, sf_dir))


@query
def day_vectors(spark, sf_dir):
    return _vectors(spark, sf_dir)


@query
def cluster_days(spark, sf_dir):
    return clusters.cluster_days(_vectors(spark, sf_dir), n_clusters=2).drop("vector")


@query
def cluster_auto_k(spark, sf_dir):
    return clusters.cluster_choice(clusters.cluster_days(_vectors(spark, sf_dir)))


def _days_apart(spark, sf_dir):
    """Normalized days, every second one of a series far above the others: any right k-means finds these two groups."""
    order = Window.partitionBy("entity_id", "kind").orderBy("date")
    days = _vectors(spark, sf_dir).where("kind = 'normalized'").withColumn("raised", (F.row_number().over(order) + 1) % 2)
    return days.withColumn("vector", F.transform("vector", lambda v: v + 100.0 * F.col("raised"))).drop("raised")


@query
def cluster_days_apart(spark, sf_dir):
    return clusters.cluster_days(_days_apart(spark, sf_dir), n_clusters=2).drop("vector")


@query
def cluster_days_apart_blocks(spark, sf_dir):
    return clusters.cluster_days(_days_apart(spark, sf_dir), n_clusters=2, block_days=5).drop("vector")


@query
def cluster_auto_k_apart(spark, sf_dir):
    return clusters.cluster_choice(clusters.cluster_days(_days_apart(spark, sf_dir)))


@query
def cluster_auto_k_apart_blocks(spark, sf_dir):
    return clusters.cluster_choice(clusters.cluster_days(_days_apart(spark, sf_dir), block_days=5))


def _days_far_apart(spark, sf_dir):
    """Days of both kinds, every second one of a series four times the largest value of its kind above the others."""
    days = _vectors(spark, sf_dir)
    largest = days.groupBy("kind").agg(F.max(F.array_max("vector")).alias("largest"))
    order = Window.partitionBy("entity_id", "kind").orderBy("date")
    raised = days.withColumn("raised", (F.row_number().over(order) + 1) % 2).join(largest, "kind")
    moved = F.transform("vector", lambda v: v + 4.0 * F.col("largest") * F.col("raised"))
    return raised.withColumn("vector", moved).drop("raised", "largest")


@query
def cluster_days_pooled(spark, sf_dir):
    return pooled.cluster_days_pooled(_days_far_apart(spark, sf_dir), n_clusters=2).drop("vector")


@query
def cluster_auto_k_pooled(spark, sf_dir):
    return pooled.pooled_choice(pooled.cluster_days_pooled(_days_far_apart(spark, sf_dir), max_k=4))


@query
def silhouette_pooled(spark, sf_dir):
    """For the days as they are, of all series together: those that peak before noon and the others."""
    labels = t.features(spark, sf_dir).select(
        "entity_id", "date", F.when(F.col("peak_minute") < 720, 0).otherwise(1).alias("cluster_id")
    )
    return pooled.pooled_silhouette(_vectors(spark, sf_dir).join(labels, ["entity_id", "date"]))


@query
def silhouette_given_labels(spark, sf_dir):
    """For days that peak before noon and the others."""
    labels = t.features(spark, sf_dir).select(
        "entity_id", "date", F.when(F.col("peak_minute") < 720, 0).otherwise(1).alias("cluster_id")
    )
    return clusters.silhouette(_vectors(spark, sf_dir).join(labels, ["entity_id", "date"])).drop("k")


@query
def cluster_single(spark, sf_dir):
    """One cluster per series: the centroid is the mean day."""
    return clusters.cluster_summary(clusters.cluster_days(_vectors(spark, sf_dir), n_clusters=1))


@query
def cluster_summary(spark, sf_dir):
    """Summary for given labels: days that peak before noon and the others."""
    labels = t.features(spark, sf_dir).select(
        "entity_id", "date", F.when(F.col("peak_minute") < 720, 0).otherwise(1).alias("cluster_id")
    )
    return clusters.cluster_summary(_vectors(spark, sf_dir).join(labels, ["entity_id", "date"]))


# Patterns, coincidence, summary


@query
def recurring_peak_timing(spark, sf_dir):
    return patterns.recurring_peak_timing(t.features(spark, sf_dir))


@query
def recurring_shapes(spark, sf_dir):
    return patterns.recurring_shapes(_shapes(spark, sf_dir))


@query
def outlier_days(spark, sf_dir):
    return patterns.outlier_days(t.features(spark, sf_dir))


@query
def peak_contribution(spark, sf_dir):
    return coincidence.peak_contribution(t.observations(spark, sf_dir), t.joint_members(spark, sf_dir), 10)


@query
def interval_coincidence(spark, sf_dir):
    return coincidence.interval_coincidence(t.observations(spark, sf_dir), t.joint_members(spark, sf_dir), 0.5)


@query
def diversity_factor(spark, sf_dir):
    return coincidence.diversity_factor(t.observations(spark, sf_dir), t.joint_members(spark, sf_dir))


@query
def stage_summary(spark, sf_dir):
    load = t.load(spark, sf_dir)
    daily = profiles.daily_profiles(load, 60)
    found = profiles.daily_features(daily, 60)
    shaped = shapes.day_shapes(demand.local_extrema(daily), found)
    return summary.stage_summary(
        found,
        t.observations(spark, sf_dir),
        events.peak_events(load, demand.meets(THRESHOLDS[0]), 1, "threshold_50"),
        shaped,
        [patterns.recurring_peak_timing(found), patterns.recurring_shapes(shaped), patterns.outlier_days(found)],
    )
